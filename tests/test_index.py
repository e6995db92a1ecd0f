import glob
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martlet.operators.index import with_row_index
from martlet.session import ensure_checkpoint_dir


def test_row_index_matches_global_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), F.col("id").alias("v")).repartition(9)
    got = {r.k: r.row_index for r in with_row_index(df, "k", buckets=16).collect()}
    want = {r.k: r.rn for r in df.select("k", (F.row_number().over(Window.orderBy("k")) - 1).alias("rn")).collect()}
    assert got == want


def test_row_index_single_bucket_and_start(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "k int")
    got = [(r.k, r.row_index) for r in with_row_index(df, "k", buckets=1, start=1).orderBy("k").collect()]
    assert got == [(1, 1), (2, 2), (3, 3)]


def test_row_index_has_no_single_partition_window(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    out = with_row_index(df, "k", buckets=8)
    assert out.count() == 1000
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the one window runs over the sizes of the range partitions, not over rows
    assert plan.count("Window") <= 1 or "HashAggregate(keys=[__martlet_part" in plan


KEYS = {
    "hot": "case when id % 3 = 0 then 500 else id end",
    "null": "case when id % 3 = 0 then null else id end",
    "url": "concat('https://example.org/item/', id)",
    "barcode": "concat('3017620', lpad(cast(id * 37 % 6007 as string), 6, '0'))",
    "short": "concat('c', id)",
}


@pytest.mark.parametrize("kind", KEYS)
def test_row_index_is_exact_and_spread_for_any_key(spark, tmp_path, kind):
    spark.range(0, 6000).selectExpr(f"{KEYS[kind]} as k", "id as v").repartition(5).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    out = with_row_index(df, "k", buckets=16)
    rows = sorted(out.collect(), key=lambda r: r.row_index)
    assert [r.row_index for r in rows] == list(range(6000))
    keys = [(r.k is not None, r.k) for r in rows]
    assert keys == sorted(keys, key=lambda x: (x[0], x[1] if x[0] else 0))
    # rows by the range partition that numbered them, read from what was written
    written = max(glob.glob(f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/martlet/row_index-*"), key=os.path.getmtime)
    sizes = [r["count"] for r in spark.read.parquet(written).groupBy(F.expr("__martlet_place >> 33")).count().collect()]
    assert sum(sizes) == 6000 and len(sizes) > 10 and max(sizes) < 3 * 6000 / 16


def test_row_index_is_deterministic(spark):
    df = spark.range(0, 3000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v")).repartition(5)
    a = {r.v: r.row_index for r in with_row_index(df, "k", buckets=8).collect()}
    b = {r.v: r.row_index for r in with_row_index(df.repartition(3), "k", buckets=8).collect()}
    assert a == b


def test_row_index_many_buckets(spark):
    df = spark.range(0, 20000).select(F.col("id").alias("k"))
    out = with_row_index(df, "k", buckets=3000)
    assert out.where("row_index = k").count() == 20000


def test_row_index_of_an_empty_table(spark):
    e = spark.createDataFrame([], "k long")
    assert with_row_index(e, "k").columns == ["k", "row_index"] and with_row_index(e, "k").count() == 0


def test_row_index_large_longs_keep_order(spark):
    base = 2 ** 60
    df = spark.range(0, 3000).select((F.lit(base) + F.col("id")).alias("k"))
    got = [r.k for r in with_row_index(df, "k", buckets=8).orderBy("row_index").collect()]
    assert got == sorted(got) and len(set(got)) == 3000


def test_row_index_date_and_timestamp_keys(spark):
    df = spark.range(0, 500).select(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 37 % 500).cast("int"))
                                    .alias("d"))
    got = [r.d for r in with_row_index(df, "d", buckets=8).orderBy("row_index").collect()]
    assert got == sorted(got)


def test_row_index_many_hot_values(spark):
    # 300 equally common values with 2000 buckets: every value is "hot"
    df = spark.range(0, 30000).select((F.col("id") % 300).alias("k"), F.col("id").alias("v"))
    out = with_row_index(df, "k", buckets=2000)
    rows = sorted(out.collect(), key=lambda r: r.row_index)
    assert [r.row_index for r in rows] == list(range(30000))
    assert [r.k for r in rows] == sorted(r.k for r in rows)
