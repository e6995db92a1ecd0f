"""Mixing sources to target weights by a splitting tree (operator 7).

Only DataFrame and SQL functions. Each source is cut into hashed blocks. Its
target in words fixes how many whole passes and which further blocks (in a
permuted order, the last one cut inside) the mix takes: exact block quotas. A
binary tree over the output shards splits each source's quota: at a node, the
number that goes left is drawn from the hypergeometric law of its slots, by an
urn that is emptied draw by draw, so the leaf quotas follow the multivariate
law and add up to the quota exactly. Each shard then takes its own run of the
permuted blocks (disjoint) and orders rows by a hash inside (local shuffle).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import materialize
from martlet.operators.index import with_row_index

# Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
#: Sources whose running sums go over one window.
_CHUNK = 4096
WORD = r"[^\x20\x09-\x0D]+"


def _unit(*parts) -> Column:
    """A uniform number in (0, 1) hashed from ``parts``."""
    bits = F.shiftrightunsigned(F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts]), 12)
    return (bits.cast("double") + 0.5) / F.lit(float(2**52))


def _running(rows: DataFrame, at: str, columns: list[str]) -> DataFrame:
    """``rows`` with the sum of each of ``columns`` over smaller ``at`` (gapless from 0) as ``<column>_before``.

    Sums go over chunks of ``_CHUNK`` rows and over one row per chunk, so no window spans all rows.
    """
    chunked = rows.withColumn("chunk", F.floor(F.col(at) / _CHUNK))
    inside = Window.partitionBy("chunk").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunked.groupBy("chunk").agg(*[F.sum(c).alias(c) for c in columns]).select(
        "chunk", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_chunk") for c in columns])
    return chunked.join(chunks, "chunk").select(*rows.columns, *[
        (F.col(f"{c}_chunk") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"{c}_before") for c in columns])


def targets(sizes: DataFrame, weights=WEIGHTS, most: float = MOST_PASSES) -> DataFrame:
    """Target words per source from ``sizes(source, source_size)``: shares by weight,
    none above ``most`` times its source, the excess shared again by weight.

    Sharing the excess until none is above has one fixed point, found directly:
    sources fill up in the order of ``cap / weight``, so the ones before the
    first that is not filled take their cap and the rest share what is left. There may
    be any number of sources: ranks come from range partitions, running sums from
    chunks, and two rows of totals reach the driver.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    named = sizes.withColumn("name", F.struct(F.col("source").isNull().alias("none"), F.col("source").alias("source")))
    ranked = (with_row_index(named, "name", "rank").drop("name")
              .withColumn("weight", w).withColumn("cap", F.lit(float(most)) * F.col("source_size")))
    filling = materialize(_running(
        with_row_index(ranked.withColumn("fill", F.struct((F.col("cap") / F.col("weight")).alias("fill"), F.col("rank").alias("rank"))), "fill", "place").drop("fill"),
        "place", ["cap", "weight"]), "mix-filling")
    total, weight = filling.agg(F.sum("source_size"), F.sum("weight")).first()
    filling = filling.withColumn("level", (F.lit(total) - F.col("cap_before")) / (F.lit(weight) - F.col("weight_before")))
    # The level at the first source that is not filled holds for all from there on.
    first = filling.where(F.col("level") * F.col("weight") < F.col("cap")).agg(F.min(F.struct("place", "level"))).first()[0]
    target = F.col("cap")
    if first is not None:
        target = F.when(F.col("place") >= first["place"], F.lit(first["level"]) * F.col("weight")).otherwise(target)
    return filling.select("source", "source_size", "rank", "weight", target.alias("target"))


def hypergeometric(left: Column, total: Column, drawn: Column, *seed) -> Column:
    """How many of ``drawn`` slots out of ``total`` lie among the first ``left``:
    an urn emptied draw by draw with hashed uniforms. Cost: ``drawn`` steps."""
    steps = F.when(drawn > 0, F.sequence(F.lit(1).cast("long"), drawn)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(
        steps, F.lit(0).cast("long"),
        lambda got, i: got + (_unit(*seed, i) * (total - i + 1) < left - got).cast("long"))


def shard_quotas(quotas: DataFrame, shards: int, slots: Column, seed: int) -> DataFrame:
    """Split ``quotas(source, quota)`` over ``shards`` (a power of two) by the tree:
    rows (source, shard, quota). Every shard has the same number of ``slots``."""
    nodes = quotas.select("source", F.lit(0).alias("node"), "quota", slots.alias("slots"))
    for depth in range(int(math.log2(shards))):
        half = F.lit(shards >> (depth + 1)).cast("long") * F.col("slots")
        left = hypergeometric(half, half * 2, F.col("quota"), F.lit(seed), F.lit(depth), F.col("node"), F.hash("source"))
        nodes = (nodes.withColumn("l", left)
                 .select("source", "slots", F.posexplode(F.array(F.col("l"), F.col("quota") - F.col("l"))).alias("side", "q"), "node")
                 .select("source", (F.col("node") * 2 + F.col("side")).alias("node"), F.col("q").alias("quota"), "slots"))
    return nodes.select("source", F.col("node").alias("shard"), "quota")


def mix(docs: DataFrame, weights=WEIGHTS, most: float = MOST_PASSES, blocks: int = 512, shards: int = 8,
        seed: int = 7) -> DataFrame:
    """How often, and into which output shards, the mix takes each row of
    ``docs(doc_id, text, source)``.

    Returns doc_id, size (words), source_size, target, taken (size times copies),
    copies, shards (the output shard of each copy), source. A null text has no
    words; a null source is a source of its own, ranked last; a source without
    words has target 0 and gives nothing; repeated rows count each; an empty
    table gives no rows; other columns are not read. The same input gives the
    same mix. A source comes within half its longest document of its target.
    Texts of any length are counted whole; rows that share a doc_id, or have none,
    are rows of their own.

    A source of any size is cut into ``blocks`` blocks by a hash of doc_id and text;
    block sums are partial aggregates, running sums go over at most ``blocks`` rows per
    source, and single rows are ordered only in the one block that the target cuts.
    """
    return _mix(materialize(_sized(docs, blocks, seed), "mix-rows"), weights, most, shards, seed)


def _sized(docs: DataFrame, blocks: int, seed: int, *more: Column) -> DataFrame:
    """What the mix needs to know of every row: doc_id, source, text_hash, size and block, and ``more``."""
    text = F.xxhash64("text", F.lit(seed + 3))
    return docs.select(
        "doc_id", "source", text.alias("text_hash"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.pmod(F.xxhash64("doc_id", text, F.lit(seed)), F.lit(blocks)).cast("int").alias("block"), *more)


def _mix(rows: DataFrame, weights, most: float, shards: int, seed: int, also: tuple[str, ...] = ()) -> DataFrame:
    """``mix`` of rows that ``_sized`` gives, written; columns named in ``also`` go along."""
    by_block = rows.groupBy("source", "block").agg(F.sum("size").alias("words"))
    sized = by_block.groupBy("source").agg(F.sum("words").alias("source_size"), F.count(F.lit(1)).alias("n_blocks"))
    goal = (targets(sized.drop("n_blocks"), weights, most).alias("t")
            .join(sized.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source")))
            .select("t.source", "t.source_size", "t.target", "s.n_blocks",
                    F.when(F.col("t.source_size") > 0, F.floor(F.col("t.target") / F.col("t.source_size")))
                    .otherwise(0).alias("passes"))
            .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")))
    order = Window.partitionBy("source").orderBy("draw", "block")
    cut = materialize(
        by_block.alias("b").join(goal.alias("g"), F.col("b.source").eqNullSafe(F.col("g.source")))
        .select("g.*", "b.block", "b.words", F.xxhash64("b.block", F.hash("b.source"), F.lit(seed + 1)).alias("draw"))
        .withColumn("block_order", (F.row_number().over(order) - 1).cast("long"))
        .withColumn("room", F.col("rest") - F.coalesce(
            F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))), "mix-blocks")

    # Quota of a source in blocks: its whole passes, and the blocks that the rest reaches.
    slots = F.ceil(F.col("n_blocks") * (F.col("passes") + 1) / shards)
    quota = (cut.groupBy("source", "n_blocks", "passes").agg(F.sum((F.col("room") > 0).cast("long")).alias("reached"))
             .withColumn("quota", F.col("n_blocks") * F.col("passes") + F.col("reached")).withColumn("slots", slots))
    # The last index of each shard's run of drawn blocks: an array of ``shards`` numbers per source.
    runs = (shard_quotas(quota, shards, F.col("slots"), seed)
            .groupBy("source").agg(F.sort_array(F.collect_list(F.struct("shard", "quota"))).alias("q"))
            .select("source", F.transform("q", lambda _, i: F.aggregate(
                F.slice("q", F.lit(1), i + 1), F.lit(0).cast("long"), lambda a, x: a + x["quota"])).alias("ends")))
    placed = cut.alias("c").join(runs.alias("u"), F.col("c.source").eqNullSafe(F.col("u.source"))).select(
        "c.source", "c.source_size", "c.target", "c.passes", "c.n_blocks", "c.block", "c.block_order", "c.words",
        "c.room", "u.ends")

    joined = rows.alias("r").join(
        placed.alias("c"), F.col("r.source").eqNullSafe(F.col("c.source")) & (F.col("r.block") == F.col("c.block"))
    ).select("r.doc_id", "r.text_hash", "r.size", *[f"r.{c}" for c in also], "c.*")
    cut_inside = (F.col("room") > 0) & (F.col("room") < F.col("words"))
    inside = Window.partitionBy("source", "block").orderBy(F.xxhash64("doc_id", "text_hash", F.lit(seed + 2)), "doc_id", "size")
    whole = joined.where(~cut_inside).withColumn(
        "more", ((F.col("room") > 0) & (F.col("room") >= F.col("words"))).cast("int"))
    part = (joined.where(cut_inside)
            .withColumn("done", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("more", (F.coalesce("done", F.lit(0)) + F.col("size") / 2 <= F.col("room")).cast("int")).drop("done"))
    drawn = F.when(F.col("copies") > 0, F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("copies") - 1),
        lambda p: F.size(F.filter("ends", lambda e: e <= p * F.col("n_blocks") + F.col("block_order"))))
    ).otherwise(F.array().cast("array<int>"))
    return whole.unionByName(part).withColumn("copies", F.col("passes") + F.col("more")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"),
        F.col("copies").cast("int").alias("copies"), drawn.alias("shards"), "source", *also)


def mixed_documents(docs: DataFrame, weights=WEIGHTS, most: float = MOST_PASSES, blocks: int = 512, shards: int = 8,
                    seed: int = 7) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, in a hashed order
    inside each partition, with the columns of ``docs``. Every row is taken as often
    as ``mix`` says of it, whatever it shares with others.

    Rows meet their copies by 128 bits of doc_id, source and text, in the one shuffle
    that texts take part in. Rows equal in all three lie in one block, so the mix takes the
    first of them once more than the rest, or all equally often; they are numbered there.
    """
    key = [F.col("doc_id").isNull(), F.col("source").isNull(), "doc_id", "source", "text"]
    keys = [F.xxhash64(*key).alias("k1"), F.xxhash64(F.lit(seed), *reversed(key)).alias("k2")]
    picks = _mix(materialize(_sized(docs, blocks, seed, *keys), "mix-rows"), weights, most, shards, seed, ("k1", "k2"))
    found = F.struct("copies", "shards")
    alike = (picks.groupBy("k1", "k2").agg(F.max(found).alias("often"), F.min(found).alias("seldom"), F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n"))
             .where("copies > 0")
             .select("k1", "k2", "often.shards", F.col("seldom.shards").alias("fewer"), (F.col("copies") - F.col("n") * F.col("seldom.copies")).alias("more")))
    numbered = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *keys).withColumn(
        "place", F.row_number().over(Window.partitionBy("k1", "k2").orderBy(F.lit(0))))
    drawn = F.when(F.col("place") <= F.col("more"), F.col("shards")).otherwise(F.col("fewer"))
    taken = numbered.join(alike, ["k1", "k2"]).select("row", F.posexplode(drawn).alias("copy", "shard"))
    return (taken.sortWithinPartitions("shard", F.xxhash64("row.doc_id", "row.text", "copy", F.lit(seed + 3)))
            .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))
