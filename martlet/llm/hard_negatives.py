"""Hard-negative mining by slots between the positives' upper limits (operator 12).

The score windows of an anchor's positives overlap, so that a row may belong to
several. Their upper limits, in descending order, cut the scores into disjoint
slots: a score falls in the slot of the least limit that is not below it, and the
window of a positive, apart from its lower limit, is the slots from its own on.
For every anchor the ``k`` best rows of each slot are kept, first in each tile,
then in each stripe of rows, then by a partial top-k before the shuffle and a
final one after it. The answer of a slot's window is the answer of the next slot's
put behind the slot's own rows, cut at ``k``: one descending pass over at most
``slots x k`` rows answers all windows. The lower limit only ever takes rows off
the end, so it is applied last.

Anchors are a stated set of queries that meet all rows, in blocks of anchors and
stripes of rows; scores are matrix products of tiles, which never leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import materialize

#: Anchors in a block; rows in a stripe, at most and (if that makes enough tasks) at least.
BLOCK, MOST, LEAST, TASKS = 8192, 1 << 18, 2048, 256
#: Rows and anchors scored at a time.
TILE_ROWS, TILE_ANCHORS = 4096, 512
_EXACT = 1 << 53


def _scores(a: np.ndarray, b: np.ndarray, most_a: int, most_b: int) -> np.ndarray:
    """Inner products of integer rows, exact: as doubles while every sum fits 53 bits, else as whole numbers of 64."""
    bound = most_a * most_b * max(1, a.shape[1])
    if bound < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return a @ b.T
    raise OverflowError("scores may not fit 64 bits")


def _most(x: np.ndarray) -> int:
    return max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))


class _Best:
    """The k best rows per (anchor, slot): higher scores first, ties by smaller id, null ids last."""

    def __init__(self, anchors: int, slots: int, k: int):
        self.k, self.slots = k, slots
        self.rows = [np.zeros(0, np.int64) for _ in range(4)]  # anchor * slots + slot, score, id is null, id
        self.least = np.full(anchors * slots, np.iinfo(np.int64).min)

    def add(self, group: np.ndarray, score: np.ndarray, none: np.ndarray, ids: np.ndarray) -> None:
        rows = [np.concatenate(x) for x in zip(self.rows, (group, score, none, ids))]
        order = np.lexsort((rows[3], rows[2], -rows[1], rows[0]))
        rows = [x[order] for x in rows]
        place = np.arange(len(order)) - np.searchsorted(rows[0], rows[0])
        self.rows = [x[place < self.k] for x in rows]
        last = place == self.k - 1
        self.least[rows[0][last]] = rows[1][last]


def _tile(best: _Best, at: int, score: np.ndarray, ok: np.ndarray, limits: np.ndarray, none: np.ndarray, ids: np.ndarray) -> None:
    """Offer the rows of one tile whose ``ok`` holds, each to the slot of its score."""
    for slot in range(limits.shape[1]):
        inside = ok & (score <= limits[:, slot, None])
        if slot + 1 < limits.shape[1]:
            inside &= score > limits[:, slot + 1, None]
        groups = (at + np.arange(len(score))) * best.slots + slot
        floor = best.least[groups]
        if score.shape[1] > best.k:  # the k-th best of the tile; all rows that tie with it stay
            kth = np.partition(np.where(inside, score, np.iinfo(np.int64).min), -best.k, axis=1)[:, -best.k]
            floor = np.maximum(floor, kth)
        i, j = np.nonzero(inside & (score >= floor[:, None]))
        if len(i):
            best.add(groups[i], score[i, j], none[j], ids[j])


def _vectors(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(name)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _stripe(batches: Iterator[pa.RecordBatch], same_label: bool, k: int) -> Iterator[pa.RecordBatch]:
    """The best rows of one stripe for one block of anchors, which come first."""
    parts, best, rest = [], None, None
    for batch in batches:
        is_row = batch.column("is_row").to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(is_row, True))
        if cut:
            parts.append(batch.slice(0, cut))
        rows = batch.slice(cut)
        if not rows.num_rows or not parts:
            continue
        if best is None:
            anchors = pa.concat_batches(parts)
            a, label, own = _vectors(anchors, "v"), anchors.column("label").to_numpy(), anchors.column("rid").to_numpy()
            lists = anchors.column("limits").to_pylist()
            slots = max(len(x) for x in lists)
            lowest = np.iinfo(np.int64).min
            limits = np.array([[*x, *[lowest] * (slots - len(x))] for x in lists], np.int64)
            least = anchors.column("lowest").to_numpy()
            best, most = _Best(len(a), slots, k), _most(a)
        for r in range(0, rows.num_rows, TILE_ROWS):
            tile = rows.slice(r, TILE_ROWS)
            b, b_label, b_rid = _vectors(tile, "v"), tile.column("label").to_numpy(), tile.column("rid").to_numpy()
            ids = tile.column("vec_id")
            none = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = ids.fill_null(0).to_numpy()
            most_b = _most(b)
            for at in range(0, len(a), TILE_ANCHORS):
                some = slice(at, at + TILE_ANCHORS)
                score = _scores(a[some], b, most, most_b)
                alike = label[some, None] == b_label[None, :]
                ok = (alike if same_label else ~alike) & (own[some, None] != b_rid[None, :]) & (score >= least[some, None])
                _tile(best, at, score, ok, limits[some], none, ids)
    if best is not None and len(best.rows[0]):
        group, score, none, ids = best.rows
        which = group // best.slots
        yield pa.RecordBatch.from_arrays(
            [pa.array(own[which]), pa.array((group % best.slots).astype(np.int32)), pa.array(score),
             pa.array(ids, pa.int64(), mask=none.astype(bool))], names=["rid", "slot", "score", "vec_id"])


def _against_all(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, same_label: bool, k: int) -> DataFrame:
    """(rid, slot, score, vec_id, place): the ``k`` best rows per anchor and slot."""
    tasks = min(TASKS, math.ceil(n_rows / LEAST))
    blocks = max(1, math.ceil(n_anchors / BLOCK))
    stripes = max(1, math.ceil(n_rows / MOST), math.ceil(tasks / blocks))
    columns = ["rid", "vec_id", "label", "v", "limits", "lowest", "d"]
    block, stripe = (F.pmod(F.xxhash64("rid", F.lit(salt)), F.lit(count)) for salt, count in ((1, blocks), (2, stripes)))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    a = anchors.select(*columns, F.lit(False).alias("is_row"), block.alias("block"), every(stripes).alias("stripe"))
    b = (rows.withColumn("limits", F.lit(None).cast("array<long>")).withColumn("lowest", F.lit(None).cast("long"))
         .select(*columns, F.lit(True).alias("is_row"), every(blocks).alias("block"), stripe.alias("stripe")))
    key = ["d", "block", "stripe"]
    # Anchors first in each group; they and one batch of rows are in memory at a time.
    dealt = a.unionByName(b).repartition(min(blocks * stripes, 20_000), *key).sortWithinPartitions(*key, "is_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _stripe(batches, same_label, k)

    found = dealt.groupBy(*key).applyInArrow(run, "rid long, slot int, score long, vec_id long")
    order = Window.partitionBy("rid", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10,
                   low_percent: int = 30, high_percent: int = 90) -> DataFrame:
    """Hard negatives of the anchors among ``vectors(vec_id, label, v)``.

    ``v`` is an array of whole numbers; a row's score is its inner product with the
    anchor. An anchor's positives are its first ``positives`` other rows of the same
    label; of each, the negatives are the first ``negatives`` rows of other labels
    whose score is from ``low_percent`` to ``high_percent`` of the positive's, both
    included. Higher scores come first, ties by smaller vec_id, null ids last.
    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score.

    Rows with a null label or a null vector, or one that holds a null, take no part.
    Vectors meet only those of their length; empty ones score 0. A positive with a
    negative score has no window. Repeated rows and rows that share a vec_id are rows
    of their own, as anchors too; an anchor is not its own positive, its copies are.
    An empty table, or one without anchors, gives no rows. Other columns are not
    read. A score that 64 bits may not hold is an OverflowError.
    """
    usable = F.col("label").isNotNull() & F.coalesce(F.forall("v", lambda x: x.isNotNull()), F.lit(False))
    rows = materialize(vectors.where(usable).select(
        F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("v").cast("array<long>"),
        F.size("v").alias("d"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")), "negative-rows")
    n_rows, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    anchors = rows.where("is_anchor")
    whole = F.array(F.lit((1 << 63) - 1))
    best = _against_all(anchors.withColumn("limits", whole).withColumn("lowest", F.lit(-(1 << 63))), rows, n_anchors, n_rows, True, positives)
    # Limits as whole numbers: the largest score <= high_percent, the least >= low_percent of the positive's.
    wide = F.col("score").cast("decimal(20,0)")
    chosen = best.where("score >= 0").select("rid", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                                              F.floor(wide * high_percent / 100).cast("long").alias("upper"),
                                              F.ceil(wide * low_percent / 100).cast("long").alias("lower"))
    wanted = materialize(chosen.groupBy("rid").agg(
        F.collect_list(F.struct("place", "positive_id", "positive_score", "upper", "lower")).alias("windows"),
        F.sort_array(F.collect_set("upper"), asc=False).alias("limits"), F.min("lower").alias("lowest")), "negative-windows")
    limited = materialize(anchors.join(wanted, "rid"), "negative-anchors")
    slots = _against_all(limited, rows, n_anchors, n_rows, False, negatives)
    ranked = slots.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("slot", "place", "vec_id", "score"))).alias("best"))
    window = F.col("window")
    # In the order of slots and places scores descend, so a window's first rows are the first from its slot on.
    own = f"slice(filter(best, x -> x.slot >= array_position(limits, window.upper) - 1), 1, {negatives})"
    answers = (limited.select("rid", F.col("vec_id").alias("anchor_id"), "limits", F.explode("windows").alias("window"))
               .join(ranked, "rid")
               .select("anchor_id", "window", F.expr(f"filter({own}, x -> x.score >= window.lower)").alias("kept")))
    return answers.select("anchor_id", window.positive_id.alias("positive_id"), F.posexplode("kept").alias("at", "n"), window.positive_score.alias("positive_score")).select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("negative_id"),
        "positive_score", F.col("n.score").alias("negative_score"))


def whole_vectors(embeddings: DataFrame, steps: int = 256) -> DataFrame:
    """``embeddings(vec_id, label, embedding)`` with ``v``: each component times ``steps``, rounded down.

    A vector with a null or non-finite component becomes null; so does a null one.
    """
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embeddings.select("vec_id", "label", F.when(
        F.coalesce(fine, F.lit(False)), F.transform("embedding", lambda x: F.floor(x.cast("double") * steps))).alias("v"))
