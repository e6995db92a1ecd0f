"""Sharding by a hierarchical weighted hash tree (operator 5).

Regions hold racks and racks hold shards, each child with a weight that is the
sum of the weights below it. A row descends level by level: each child draws
``-ln(u) / weight`` with ``u`` hashed from the key, the level and the child, and
the smallest draw wins. The draws of different children are independent, so a
child whose weight changes wins or loses rows only against its siblings, and
rows move only into or out of the subtree that changed. A new shard comes as a
region of its own: it takes rows from the other regions and nothing else moves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import materialize

LAW = "key"


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def topology(shards: int, racks_per_region: int = 2, shards_per_rack: int = 2) -> list[Leaf]:
    """``shards`` equal shards, filling racks and regions in order."""
    out = []
    for n in range(shards):
        rack = n // shards_per_rack
        out.append(Leaf(f"region{rack // racks_per_region}", f"rack{rack}", n))
    return out


def add_shard(leaves: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One more shard, in a region of its own so that rows move only into it."""
    n = max((leaf.shard for leaf in leaves), default=-1) + 1
    return [*leaves, Leaf(f"region+{n}", f"rack+{n}", n, weight)]


def _draw(key: Column, level: str, child: str, weight: float) -> Column:
    # 52 hashed bits, centred in their cell: never 0 and never 1.
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), F.lit(child)), 12)
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(2**52))) / F.lit(float(weight))


def _descend(key: Column, leaves: list[Leaf], levels: list[str]) -> Column:
    level, rest = levels[0], levels[1:]
    children: dict = {}
    for leaf in leaves:
        if leaf.weight > 0:
            children.setdefault(getattr(leaf, level), []).append(leaf)

    def below(group: list[Leaf]) -> Column:
        return _descend(key, group, rest) if rest else F.lit(group[0].shard)

    if len(children) == 1:
        return below(next(iter(children.values())))
    draws = [(_draw(key, level, str(name), sum(x.weight for x in group)), below(group))
             for name, group in children.items()]
    least = F.least(*[d for d, _ in draws])
    chosen = draws[-1][1]
    for draw, shard in reversed(draws[:-1]):
        chosen = F.when(draw == least, shard).otherwise(chosen)
    return chosen


def shard_of(key: Column, leaves: list[Leaf]) -> Column:
    """The shard (int) of ``key`` under the tree of ``leaves``; ``key`` may be null."""
    if not any(leaf.weight > 0 for leaf in leaves):
        raise ValueError("no shard with a positive weight")
    # Hashing skips nulls, so a null key draws by level and child alone: one shard.
    return _descend(key, leaves, ["region", "rack", "shard"]).cast("int")


def place(docs: DataFrame, shards: int = 8, cells: int = 512, key: str = "doc_id", chunk: int = 4096) -> DataFrame:
    """Shard, slot and next shard of every row of ``docs(doc_id, text)``.

    Returns doc_id, size (UTF-8 bytes of the text plus 1; a null text has none),
    text_crc32, law, shard, slot (gapless from 0 in each shard), grown_shard (the
    shard once one more has been added). Equal keys go to one shard; a null key is
    placed like any other value; repeated rows get slots of their own; texts of any
    length are hashed whole; an empty table gives no rows; other columns are not read.

    Slots need no global sort: a shard is cut into ``cells`` cells by a hash of key and
    text, whose row counts (``shards * cells`` rows) give each cell its first slot.
    Inside a cell the different (key, text) are numbered, rows that are equal in both as
    one with their number: they take a run of slots, handed out ``chunk`` at a time. So
    neither a key nor a row that comes very often meets in one task.
    """
    leaves = topology(shards)
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    equal = materialize(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("rows")).select(
        "doc_id", "size", "text_crc32", "rows",
        shard_of(F.col("doc_id"), leaves).alias("shard"),
        shard_of(F.col("doc_id"), add_shard(leaves)).alias("grown_shard"),
        F.pmod(F.xxhash64("doc_id", "text_crc32", "size", F.lit("cell")), F.lit(cells)).cast("int").alias("cell")), "shard-rows")
    counts = equal.groupBy("shard", "cell").agg(F.sum("rows").alias("n"))
    # One row per cell, shards * cells of them at most: a proven bound for the broadcast.
    first = counts.select("shard", "cell", (F.sum("n").over(
        Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))
    inside = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    runs = (equal.withColumn("within", F.sum("rows").over(inside)).join(F.broadcast(first), ["shard", "cell"])
            .withColumn("from", F.coalesce("before", F.lit(0)) + F.coalesce("within", F.lit(0)))
            .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(rows - 1) div {chunk}")))))
    last = F.least(F.col("rows"), (F.col("part") + 1) * chunk) - 1
    return (runs.repartition("doc_id", "text_crc32", "part")
            .withColumn("slot", F.explode(F.sequence(F.col("from") + F.col("part") * chunk, F.col("from") + last)))
            .select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", "grown_shard"))
