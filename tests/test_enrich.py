import pytest
from pyspark.sql import functions as F
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from martlet.operators import enrich


def test_left_join_keeps_left_rows_and_drops_stale_column(spark):
    left = spark.createDataFrame([("a", 1, 9), ("b", 2, 9), ("c", 3, None)], "code string, v int, prediction int")
    right = spark.createDataFrame([("a", 10), ("c", 30), ("z", 99)], "code string, prediction int")
    out = enrich.enrich_left_join(left, right, "code", ["prediction"])
    assert out.columns == ["code", "v", "prediction"]
    assert sorted(map(tuple, out.collect())) == [("a", 1, 10), ("b", 2, None), ("c", 3, 30)]


def test_duplicate_right_key_raises(spark):
    left = spark.createDataFrame([("a", 1)], "code string, v int")
    right = spark.createDataFrame([("a", 1), ("a", 2)], "code string, prediction int")
    with pytest.raises((PySparkException, Py4JJavaError)) as info:
        enrich.enrich_left_join(left, right, "code", ["prediction"]).collect()
    assert "duplicate key" in str(info.value)


def test_duplicate_right_key_keep_multiplies(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "code string, v int")
    right = spark.createDataFrame([("a", 1), ("a", 2)], "code string, prediction int")
    out = enrich.enrich_left_join(left, right, "code", ["prediction"], on_duplicate="keep")
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [("a", 1, 1), ("a", 1, 2), ("b", 2, None)], key=repr)


def test_add_null_column_is_idempotent(spark):
    df = spark.createDataFrame([("a",)], "code string")
    once = enrich.add_null_column(df, "prediction")
    twice = enrich.add_null_column(once, "prediction")
    assert once.dtypes == twice.dtypes == [("code", "string"), ("prediction", "int")]
    assert twice.first()["prediction"] is None


def test_null_right_keys_do_not_trip_the_guard(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "code string, v int")
    right = spark.createDataFrame([("a", 7), (None, 8), (None, 9)], "code string, prediction int")
    out = enrich.enrich_left_join(left, right, "code", ["prediction"])
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([("a", 1, 7), (None, 2, None)], key=repr)


@pytest.mark.parametrize("hot", ["F.lit(7)", "F.lit(None)"])
@pytest.mark.parametrize("on_duplicate", ["error", "keep"])
def test_hot_or_null_left_key_is_split_on_parquet_inputs(spark, tmp_path, hot, on_duplicate):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    # a third of the left rows share one key, or have none
    key = F.when(F.col("id") % 3 == 0, eval(hot)).otherwise(F.col("id"))
    spark.range(30000).select(key.alias("k"), F.col("id").alias("v")).repartition(6).write.parquet(f"{tmp_path}/l")
    spark.range(30000).select(F.col("id").alias("k"), (F.col("id") % 5).alias("prediction")).write.parquet(f"{tmp_path}/r")
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = enrich.enrich_left_join(spark.read.parquet(f"{tmp_path}/l"), spark.read.parquet(f"{tmp_path}/r"), "k",
                                      ["prediction"], on_duplicate=on_duplicate)
        assert len(out.collect()) == 30000      # run this DataFrame's own execution: final AQE plan
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
