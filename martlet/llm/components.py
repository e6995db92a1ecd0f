"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import discard, materialize


def _least_neighbour(edges: DataFrame) -> DataFrame:
    # Written out, so that the join that follows shuffles both of its sides and
    # a hub with a large part of all edges can be split among tasks.
    return materialize(edges.groupBy("u").agg(F.min("v").alias("m")), "least")


def _star(edges: DataFrame, large: bool) -> tuple[DataFrame, DataFrame]:
    """One star step over ``edges(u > v)``, and the table it leaves for discarding.

    Large: each node links its larger neighbours to the least of its neighbours
    and itself. Small: each node links its smaller neighbours, and itself, to the
    least of them.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least_neighbour(both)
        out = (both.where("v > u").join(least, "u")
               .select(F.col("v").alias("u"), F.least("u", "m").alias("v")))
    else:
        least = _least_neighbour(edges)
        out = (edges.join(least, "u")
               .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                         F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
               .select("e.*").where("u <> v"))
    return materialize(out.distinct(), "star"), least


def _mark(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"),
                     F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; root is the least node reachable.

    Edges are long ids, in any direction, repeats allowed; loops are ignored.
    Each step is a few shuffles of the remaining edges, written to the shared
    folder; the number of rounds grows with the logarithm of the longest path.
    Only a count and two checksums reach the driver.
    """
    now = materialize(edges.where(F.col(a) != F.col(b))
                      .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        large, least_large = _star(now, True)
        small, least_small = _star(large, False)
        for gone in (now, large, least_large, least_small):
            discard(gone)
        now, (old, mark) = small, (mark, _mark(small))
        if old == mark:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
