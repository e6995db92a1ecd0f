"""Merkle manifest of a table by bitmap ranks and slot arrays (operator 11).

A leaf's place in its group is a rank query, no sort: the ids of a group are set as
bits in 64-bit words, of which the ones without a bit are not stored. Partial
aggregates build the words in every task and the shuffle merges them by OR. Above
the words stand directories of popcounts, each of which covers 65,536 entries of the
one below, so that a word's base rank is a sum of bounded prefix sums, and the rank
of an id is the base plus the number of bits below its own in its word. Ids that
come more than once carry their surplus in the word; rows of one id are ranked the
same way by the first 64 bits of their leaf.

Nodes then go to arrays of ``3**7`` slots, keyed by group and array number and put
in place by their slot, and seven levels are reduced inside each array. A few such
rounds reach the subroots, and the same rounds over them the root. On the way down
every array hands its nodes the siblings above them, and the last round folds each
leaf, or its tampered version, up to the root.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import materialize
from martlet.operators.index import with_row_index
from martlet.session import scratch

#: Children of a node, and levels that one array of slots reduces.
RUN, LEVELS = 3, 7
SLOTS = RUN**LEVELS

_WORD_BITS, _DIGIT = 6, 16
#: Word number of a null id, below those of all ids.
_NULL_WORD = -(1 << (63 - _WORD_BITS)) - 1
_NODE = "tree string, block long, low int, high int, nodes long, digest binary, id long, other binary"


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 in hexadecimal of the columns one after another: ``-`` if null, else the
    UTF-8 byte count of the value as text, a colon and the value."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(c) for c in columns]), 256)


def ranks(keys: DataFrame, group: list[str], key: str) -> DataFrame:
    """``keys`` with ``before``, the sum of ``n`` over smaller keys of the group, and ``total``, over all.

    ``key`` is a long, unique in its group; a null one comes first. ``group`` has no nulls.
    """
    word = F.coalesce(F.shiftright(key, _WORD_BITS), F.lit(_NULL_WORD))
    bit = F.coalesce(F.col(key).bitwiseAND(F.lit(63)), F.lit(0)).cast("int")
    placed = keys.withColumn("word", word).withColumn("bit", bit)
    words = materialize(placed.groupBy(*group, "word").agg(
        F.expr("bit_or(shiftleft(1L, bit))").alias("bits"), F.sum("n").alias("size"),
        F.collect_list(F.when(F.col("n") > 1, F.struct("bit", (F.col("n") - 1).alias("more")))).alias("surplus")), "manifest-words")
    # Directories from the words upwards; each entry holds the size of up to 65,536 below it.
    levels = [words.select(*group, F.col("word").alias("entry"), "size")]
    for _ in range((64 - _WORD_BITS) // _DIGIT):
        levels.append(levels[-1].groupBy(*group, F.shiftright("entry", _DIGIT).alias("entry")).agg(F.sum("size").alias("size")))
    top = Window.partitionBy(*group)
    base = levels[-1].select(*group, "entry", F.coalesce(F.sum("size").over(
        top.orderBy("entry").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"), F.sum("size").over(top).alias("total"))
    for level in reversed(levels[:-1]):
        level = level.withColumn("parent", F.shiftright("entry", _DIGIT))
        earlier = Window.partitionBy(*group, "parent").orderBy("entry").rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumn("within", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        base = (level.join(base.withColumnRenamed("entry", "parent"), [*group, "parent"])
                .select(*group, "entry", (F.col("base") + F.col("within")).alias("base"), "total"))
    index = words.join(base.withColumnRenamed("entry", "word"), [*group, "word"]).select(*group, "word", "bits", "surplus", "base", "total")
    below = F.expr("bit_count(bits & ~shiftleft(-1L, bit))")
    more = F.expr("aggregate(filter(surplus, x -> x.bit < bit), 0L, (s, x) -> s + x.more)")
    return placed.join(index, [*group, "word"]).select(
        *[placed[c] for c in keys.columns], (F.col("base") + below + more).alias("before"), "total")


def _placed(leaves: DataFrame) -> DataFrame:
    """Distinct leaves with the first of their ``n`` places in their tree, and the tree's number of leaves."""
    ids = leaves.groupBy("tree", "id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
    ids = materialize(ranks(materialize(ids, "manifest-ids"), ["tree"], "id"), "manifest-ranks")
    u, i = leaves.alias("u"), ids.alias("i")
    placed = u.join(i, (F.col("u.tree") == F.col("i.tree")) & F.col("u.id").eqNullSafe(F.col("i.id"))).select(
        "u.*", F.col("i.before").alias("first"), F.col("i.total").alias("nodes"), "i.texts")
    # Rows of one id with different contents: by their leaf, whose first 64 bits rank as a signed long.
    head = F.conv(F.hex(F.substring("leaf", 1, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    several = materialize(placed.where("texts > 1").withColumn("head", head), "manifest-several")
    heads = ranks(several.groupBy("tree", "first", "head").agg(F.sum("n").alias("n")), ["tree", "first"], "head")
    tie = Window.partitionBy("tree", "first", "head").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)  # leaves that agree in 64 bits
    within = (several.withColumn("tie", F.coalesce(F.sum("n").over(tie), F.lit(0)))
              .join(heads.select("tree", "first", "head", "before"), ["tree", "first", "head"])
              .withColumn("first", F.col("first") + F.col("before") + F.col("tie")))
    columns = [*leaves.columns, "first", "nodes"]
    return placed.where("texts = 1").select(*columns).unionByName(within.select(*columns))


def _steps(nodes: int) -> int:
    """Levels from ``nodes`` nodes to one."""
    steps = 0
    while nodes > 1:
        nodes, steps = -(-nodes // RUN), steps + 1
    return steps


def _reduced(slots: list[str], nodes: int) -> list[list[str]]:
    """The levels of one array, of a tree with ``nodes`` nodes at its lowest."""
    levels = [slots]
    for _ in range(min(LEVELS, _steps(nodes))):
        below = levels[-1]
        levels.append([sha256("".join(below[k:k + RUN]).encode()).hexdigest() for k in range(0, len(below), RUN)])
    return levels


def _slots(table: pa.Table) -> list[str]:
    """The array of a group of rows: each digest in all slots from ``low`` to ``high``."""
    low, high = table.column("low").to_pylist(), table.column("high").to_pylist()
    slots = [""] * (max(high) + 1)
    for digest, a, b in zip(table.column("digest").to_pylist(), low, high):
        slots[a:b + 1] = [digest.hex()] * (b - a + 1)
    return slots


def _siblings(levels: list[list[str]], slot: int) -> list[tuple[str, str]]:
    """What stands left and right of the slot's node in its run, level by level."""
    out = []
    for level in levels[:-1]:
        at = slot - slot % RUN
        out.append(("".join(level[at:slot]), "".join(level[slot + 1:at + RUN])))
        slot //= RUN
    return out


def _climbed(nodes: DataFrame) -> DataFrame:
    """The nodes seven levels up, or at the root of their tree."""
    schema = pa.schema([("tree", pa.string()), ("at", pa.int64()), ("nodes", pa.int64()), ("digest", pa.binary())])

    def climb(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        tree, block = (k.as_py() for k in key)
        count = table.column("nodes")[0].as_py()
        levels = _reduced(_slots(table), count)
        for _ in levels[1:]:
            count = -(-count // RUN)
        return pa.table([[tree], [block], [count], [bytes.fromhex(levels[-1][0])]], schema=schema)

    up = nodes.groupBy("tree", "block").applyInArrow(climb, "tree string, at long, nodes long, digest binary")
    return _in_arrays(up)


def _in_arrays(nodes: DataFrame) -> DataFrame:
    slot = F.pmod("at", F.lit(SLOTS)).cast("int")
    return nodes.select("tree", F.expr(f"at div {SLOTS}").alias("block"), slot.alias("low"), slot.alias("high"), "nodes", "digest",
                        F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("other"))


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """The arrays of each round; in the last one every tree has a single node."""
    rounds = [nodes]
    while (nodes.agg(F.max("nodes")).first()[0] or 1) > 1:
        nodes = materialize(_climbed(nodes), "manifest-round")
        rounds.append(nodes)
    return rounds


def _written(path: list[tuple[str, str]]) -> str:
    return "".join(f"{left}*{right}|" for left, right in path)


def _read(path: str) -> list[tuple[str, str]]:
    return [tuple(level.split("*")) for level in path.split("|")[:-1]]


def _descended(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """(tree, at, subroot, path): each node's siblings up to the root, from those of its array's node."""
    schema = pa.schema([("tree", pa.string()), ("at", pa.int64()), ("subroot", pa.string()), ("path", pa.string())])

    def descend(key: tuple[pa.Scalar, ...], table: pa.Table, above: pa.Table) -> pa.Table:
        tree, block = (k.as_py() for k in key)
        levels = _reduced(_slots(table), table.column("nodes")[0].as_py())
        count = len(levels[0])
        up, subroot = above.column("path")[0].as_py(), above.column("subroot")[0].as_py()
        return pa.table([[tree] * count, [block * SLOTS + s for s in range(count)], [subroot] * count,
                         [_written(_siblings(levels, s)) + up for s in range(count)]], schema=schema)

    return (nodes.groupBy("tree", "block").cogroup(paths.withColumnRenamed("at", "block").groupBy("tree", "block"))
            .applyInArrow(descend, "tree string, at long, subroot string, path string"))


def _verified(nodes: DataFrame, paths: DataFrame, root: str) -> DataFrame:
    """The result rows of the leaves."""
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")),
                        ("verified", pa.bool_())])

    def verify(key: tuple[pa.Scalar, ...], table: pa.Table, above: pa.Table) -> pa.Table:
        slots = _slots(table)
        levels = _reduced(slots, table.column("nodes")[0].as_py())
        up, subroot = above.column("path")[0].as_py(), above.column("subroot")[0].as_py()
        upper = _read(up)
        upper_text = up.replace("*", "").replace("|", "").encode()
        out: list[list] = [[] for _ in schema]
        for a, b, doc_id, other in zip(*(table.column(c).to_pylist() for c in ("low", "high", "id", "other"))):
            for s in range(a, b + 1):
                own = _siblings(levels, s)
                proof = sha256("".join(left + right for left, right in own).encode())
                proof.update(upper_text)
                folded = slots[s] if other is None else other.hex()
                for left, right in (*own, *upper):
                    folded = sha256((left + folded + right).encode()).hexdigest()
                for column, value in zip(out, (doc_id, slots[s], subroot, root, proof.hexdigest(), folded, folded == root)):
                    column.append(value)
        return pa.table(out, schema=schema)

    return (nodes.groupBy("tree", "block").cogroup(paths.withColumnRenamed("at", "block").groupBy("tree", "block"))
            .applyInArrow(verify, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"))


def manifest(table: DataFrame, columns: list[str], key: str = "doc_id", group: str = "source",
             tampered: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """The Merkle tree of ``table``, a proof for each row, and what a tampered row folds to.

    Leaves are ``leaf_digest`` of ``columns``. Those of a ``group`` value ascend by the
    whole number ``key``; while there are several nodes, every three consecutive ones
    (the last run: fewer, even one) become the SHA-256 of their digests in hexadecimal.
    The subroots, in the order of ``group`` (null first, by UTF-8 bytes), give the root
    likewise. Returns per row: doc_id (the key), leaf, subroot, root, proof_sha256 (of
    the siblings from the leaf up, left to right), folded_root (the leaf and its
    siblings folded) and verified (folded_root = root). Rows where ``where`` holds fold
    the leaf of ``tampered`` (column -> changed column) with the original siblings.

    A null key comes first in its group; rows with equal keys are in the order of
    their leaf, and repeated rows have places, and proofs, of their own. A null and an
    empty value differ. Where ``where`` is null nothing is tampered. Texts of any length are hashed whole.
    A table of one row is its own root; an empty one gives no rows. Columns that are
    not named are not read. A key that is no whole number is a ValueError.
    """
    if table.schema[key].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"{key} must be a column of whole numbers")
    tampered = tampered or {}
    tree = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("+"), F.col(group).cast("string")))
    changed = leaf_digest([tampered.get(c, F.col(c)) for c in columns])
    rows = table.select(tree.alias("tree"), F.col(key).cast("long").alias("id"), F.unhex(leaf_digest([F.col(c) for c in columns])).alias("leaf"),
                        F.when(F.lit(False) if where is None else where, F.unhex(changed)).alias("other"))
    with scratch(table.sparkSession) as kept:
        # Equal rows are one leaf with a number; each still gets its own places.
        leaves = materialize(rows.groupBy("tree", "id", "leaf", "other").agg(F.count(F.lit(1)).alias("n")), "manifest-leaves")
        last = F.col("first") + F.col("n") - 1
        start = F.col("block") * SLOTS
        nodes = materialize(
            _placed(leaves).withColumn("block", F.explode(F.sequence(F.expr(f"first div {SLOTS}"), F.expr(f"(first + n - 1) div {SLOTS}"))))
            .select("tree", "block", (F.greatest("first", start) - start).cast("int").alias("low"),
                    (F.least(last, start + SLOTS - 1) - start).cast("int").alias("high"), "nodes", F.col("leaf").alias("digest"), "id", "other"), "manifest-slots")
        rounds = _rounds(nodes)
        subroots = materialize(with_row_index(rounds[-1].select("tree", "digest"), "tree", "at"), "manifest-subroots")
        count = subroots.count()
        tops = _rounds(materialize(_in_arrays(subroots.select(F.lit("").alias("tree"), "at", F.lit(count).cast("long").alias("nodes"), "digest")), "manifest-tops"))
        root = tops[-1].select(F.lower(F.hex("digest"))).first()
        none = F.lit("").alias("path")
        paths = tops[-1].select("tree", F.col("block").alias("at"), F.lit("").alias("subroot"), none)
        for level in reversed(tops[:-1]):
            paths = materialize(_descended(level, paths), "manifest-paths")
        paths = subroots.join(paths.select("at", "path"), "at").select("tree", F.lit(0).cast("long").alias("at"), F.lower(F.hex("digest")).alias("subroot"), "path")
        for level in reversed(rounds[1:-1]):
            paths = materialize(_descended(level, paths), "manifest-paths")
        paths = materialize(paths, "manifest-above")
        kept += [nodes, paths]
    return _verified(nodes, paths, root[0] if root else "")
