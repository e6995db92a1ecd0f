"""Tables laid out so that a repeated left join needs no exchange (J1, J-C).

Both sides are written once as tables bucketed and sorted by the join key, in the
same number of buckets; Spark then joins bucket with bucket where they lie. A key
that holds more than a bucket's share of the left rows would fill one bucket, so the
buckets are by key and salt: rows of such a key are dealt among as many salts as it
has shares, and the right side's row of that key is written once for each. There are
fewer such keys than buckets, which bounds the table of them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.session import stage, unstage
from martlet.sources.tables import quote

_SALT, _SALTS, _HOT, _PLACE = "__martlet_salt", "__martlet_salts", "__martlet_hot", "__martlet_place"


def hot_keys(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """(key, salts): the keys, NULL too, with more rows than a bucket's share, and how many shares."""
    counts = stage(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "key-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    share = max(1, math.ceil(total / buckets))
    hot = counts.where(F.col("n") > share).select(F.col(key).alias(_HOT), F.ceil(F.col("n") / share).cast("int").alias(_SALTS))
    found = hot.collect()             # fewer than ``buckets``
    unstage(counts)
    return df.sparkSession.createDataFrame(found, hot.schema)


def _write(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    (df.repartition(buckets, key, _SALT).sortWithinPartitions(key, _SALT)
     .write.bucketBy(buckets, key, _SALT).sortBy(key, _SALT).option("path", path).saveAsTable(table))


def lay_out_left(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write the left side as ``table`` at ``path``; returns its hot keys for ``lay_out_right``."""
    hot = hot_keys(df, key, buckets)
    marked = df.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col(_HOT)), "left").drop(_HOT)
    # A salt by place is even whatever the rows hold, copies too; places are staged, so that a task that runs again deals alike.
    spread = stage(marked.where(F.col(_SALTS).isNotNull()).withColumn(_PLACE, F.monotonically_increasing_id()), "hot-rows")
    salted = spread.withColumn(_SALT, F.pmod(_PLACE, _SALTS).cast("int")).drop(_PLACE, _SALTS)
    plain = marked.where(F.col(_SALTS).isNull()).drop(_SALTS).withColumn(_SALT, F.lit(0))
    _write(plain.unionByName(salted), table, path, key, buckets)
    unstage(spread)
    return hot


def lay_out_right(df: DataFrame, table: str, path: str, key: str, buckets: int, hot: DataFrame) -> None:
    """Write the right side for a left side with the hot keys ``hot``. NULL keys match nothing and are left out."""
    marked = df.where(F.col(key).isNotNull()).join(F.broadcast(hot), F.col(key) == F.col(_HOT), "left").drop(_HOT)
    salts = F.sequence(F.lit(0), F.coalesce(_SALTS, F.lit(1)) - 1)
    _write(marked.withColumn(_SALT, F.explode(salts)).drop(_SALTS), table, path, key, buckets)


def check_unique(spark: SparkSession, table: str, key: str) -> None:
    """Raise when a key comes twice in a right side; its buckets are counted where they lie."""
    found = spark.table(table).groupBy(key, _SALT).agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
    if found is not None:
        raise ValueError(f"duplicate key in right side of enrichment join: {key}={found[key]}")


def colocated_left_join(spark: SparkSession, left: str, right: str, key: str, cols: list[str], on_duplicate: str = "error") -> DataFrame:
    """J1 over two laid out tables: as ``enrich_left_join``, without an exchange on either side."""
    if on_duplicate not in ("error", "keep"):
        raise ValueError("on_duplicate must be 'error' or 'keep'")
    if on_duplicate == "error":
        check_unique(spark, right, key)
    base = spark.table(left).drop(*cols)
    side = spark.table(right).select(key, _SALT, *cols)
    return base.join(side, [key, _SALT], "left").drop(_SALT)


def drop(spark: SparkSession, *names: str) -> None:
    """Forget laid out tables; their files stay."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {quote(name)}")
