"""Near-duplicate embeddings by collision-counting projections (operator 4).

Vectors are projected on many random directions. Along a direction, a window
centred on the query catches a vector at the cosine threshold with a known
probability, so the number of directions in which a true pair collides follows
a known binomial law; the count that a pair must reach is the largest that
keeps the wanted recall. Pairs that reach it are verified exactly.

In many dimensions a one-dimensional window holds a constant share of all
vectors, so the number of pairs counted grows with the square of the input. The
counting therefore works on one-byte coordinates and in blocks: each pair of
blocks is a task of bounded size, and only counts, links of a spanning forest
and ids leave it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import materialize
from martlet.llm.components import components

#: Window half-width, in standard deviations of the projected distance at the threshold.
WINDOW = 2.0
#: One-byte steps in a half-window.
STEPS = 31
TILE = 512


def needed_collisions(directions: int, recall: float, window: float = WINDOW) -> int:
    """The largest count that a pair at the threshold reaches with probability ``recall``."""
    p = math.erf(window / math.sqrt(2))
    tail, k = 0.0, directions
    while True:
        tail += math.comb(directions, k) * p**k * (1 - p) ** (directions - k)
        if tail >= recall or k == 0:
            return k
        k -= 1


def _candidates(a: np.ndarray, b: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of columns of ``a`` and ``b`` (directions x vectors, one byte each) that
    collide in ``need`` directions. Coordinates wrap; a wrapped collision only
    makes one more candidate."""
    m, first = len(a), max(1, (5 * len(a)) // 8)
    reach = np.uint8(2 * (STEPS + 1))
    count = np.zeros((a.shape[1], b.shape[1]), np.uint8)
    apart, hit = np.empty_like(count), np.empty(count.shape, bool)
    for x, y in zip(a[:first] + np.uint8(STEPS + 1), b[:first]):
        np.subtract(x[:, None], y[None, :], out=apart)
        np.less_equal(apart, reach, out=hit)
        np.add(count, hit.view(np.uint8), out=count)
    i, j = np.nonzero(count >= max(0, need - (m - first)))
    left = count[i, j].astype(np.int64)
    for x, y in zip(a[first:] + np.uint8(STEPS + 1), b[first:]):
        left += (x[i] - y[j]) <= reach
    found = left >= need
    return i[found], j[found]


def _verified(u: np.ndarray, v: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float):
    if 8 * len(i) > len(u) * len(v):  # a dense tile: one product costs less than gathering
        ok = (u @ v.T)[i, j] >= threshold
    else:
        ok = np.concatenate([np.einsum("ij,ij->i", u[i[k:k + 65536]], v[j[k:k + 65536]]) >= threshold
                             for k in range(0, len(i), 65536)] or [np.zeros(0, bool)])
    return i[ok], j[ok]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least vertex of each vertex's component."""
    label = np.arange(n)
    while True:
        new = label.copy()
        least = np.minimum(label[i], label[j])
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = np.minimum(new, new[new])
        if np.array_equal(new, label):
            return label
        label = new


def _block_pair(table: pa.Table, threshold: float, directions: int, recall: float, seed: int) -> pa.Table:
    """Links among the rows of two blocks (or inside one): per vector their number,
    copies counted, and the least vector linked through this task."""
    schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
    ids, copies, block = (table.column(c).to_numpy() for c in ("rep", "copies", "block"))
    x = np.stack(table.column("embedding").to_numpy()).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    sigma = math.sqrt(max(2 - 2 * threshold, 1e-12))
    axes = np.random.default_rng(seed).standard_normal((x.shape[1], directions))
    along = x @ axes
    order = np.lexsort((ids, along[:, 0], block))  # sorted along the first direction in each block
    ids, copies, block, x, along = ids[order], copies[order], block[order], x[order], along[order]
    byte = np.ascontiguousarray((np.rint(along * (STEPS / (WINDOW * sigma))).astype(np.int64) & 255).astype(np.uint8).T)
    need, far = needed_collisions(directions, recall), 4.5 * sigma
    two = block[0] != block[-1]
    cut = int(np.searchsorted(block, block[-1])) if two else len(ids)
    rows, cols = range(0, cut, TILE), range(cut if two else 0, len(ids), TILE)
    links, some_i, some_j = np.zeros(len(ids), np.int64), [], []
    for r in rows:
        r2 = min(r + TILE, cut)
        for c in cols:
            c2 = min(c + TILE, len(ids))
            if not two and c < r or along[c, 0] - along[r2 - 1, 0] > far or along[r, 0] - along[c2 - 1, 0] > far:
                continue
            i, j = _candidates(byte[:, r:r2], byte[:, c:c2], need)
            if not two and c == r:
                i, j = i[i < j], j[i < j]
            i, j = _verified(x[r:r2], x[c:c2], i, j, threshold)
            np.add.at(links, r + i, copies[c + j])
            np.add.at(links, c + j, copies[r + i])
            some_i.append((r + i).astype(np.int32))
            some_j.append((c + j).astype(np.int32))
    i, j = (np.concatenate([*parts, np.zeros(0, np.int32)]) for parts in (some_i, some_j))
    by_id = np.argsort(ids, kind="stable")  # so that the least place is the least vertex
    place = np.empty(len(ids), np.int64)
    place[by_id] = np.arange(len(ids))
    root = ids[by_id][_forest(len(ids), place[i], place[j])][place]
    linked = links > 0
    return pa.table([pa.array(ids[linked]), pa.array(links[linked]), pa.array(root[linked])], schema=schema)


def near_vectors(vectors: DataFrame, threshold: float = 0.9, directions: int = 32, recall: float = 0.9999,
                 block_rows: int = 4096, seed: int = 11) -> DataFrame:
    """Links by cosine among all rows of ``vectors(vec_id, embedding)``.

    Returns vec_id, n_links (other rows linked directly), component_id (least
    vec_id reachable, itself included), kept (vec_id = component_id). A vector
    that is null, empty, zero, or holds a null or a non-finite number links with
    nothing, as do vectors of different lengths; repeated rows and equal vectors
    count each; vectors that share a vec_id, or have none, are vectors of their own,
    and null ids name no group (a group of nulls alone has a null component_id); an
    empty table gives no rows; other columns are not read.

    Equal vectors are one vertex with a number of copies. The others fall by hash
    into blocks of about ``block_rows`` rows; every pair of blocks is one task.
    ``recall`` is the probability with which a pair exactly at the threshold is
    found; closer pairs are found with more.
    """
    ok = (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select("vec_id", "embedding", (F.coalesce(ok, F.lit(False)) & F.coalesce(
        F.exists("embedding", lambda x: x != 0), F.lit(False))).alias("ok"))
    # A vertex of its own for every different vector: a vec_id may name several. Written, so that the numbers stay.
    reps = materialize(rows.where("ok").groupBy("embedding").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
                       .withColumn("rep", F.monotonically_increasing_id()), "embedding-reps")
    blocks = max(1, math.ceil(reps.count() / block_rows))
    b, o = F.col("block"), F.col("other")
    paired = (reps.select("rep", "copies", "embedding", F.size("embedding").alias("d"),
                          F.pmod(F.xxhash64("rep", F.lit(seed)), F.lit(blocks)).alias("block"))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
              .withColumn("low", F.least(b, o)).withColumn("high", F.greatest(b, o)))
    found = materialize(paired.groupBy("d", "low", "high").applyInArrow(
        lambda t: _block_pair(t, threshold, directions, recall, seed), "rep bigint, links bigint, root bigint"), "embedding-links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    root = components(found.select("rep", "root"), "rep", "root")
    groups = materialize(
        reps.join(counts, "rep", "left").join(root.withColumnRenamed("node", "rep"), "rep", "left")
        .select("embedding", "least_id", "copies", F.coalesce("links", F.lit(0)).alias("links"),
                F.coalesce("root", "rep").alias("root")), "embedding-groups")
    least = groups.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = materialize(groups.join(least, "root").select(
        "embedding", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"), "embedding-named")
    r, n = rows.where("ok").alias("r"), named.alias("n")
    linked = r.join(n, F.col("r.embedding") == F.col("n.embedding")).select("r.vec_id", "n.n_links", "n.component_id")
    alone = rows.where(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
