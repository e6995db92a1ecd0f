import pytest
from pyspark.sql import functions as F

from martlet.operators import enrich
from martlet.plans import jobs
from martlet.session import shared_dir
from martlet.sources import colocated


@pytest.fixture()
def laid_out(spark):
    """A left side with a third of its rows on one key and a third without a key, and a right side."""
    base = shared_dir(spark, "colocated")
    tag = base.rsplit("-", 1)[-1]
    left = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).cast("long").alias("k"), "id", F.lit("stale").alias("v"))
    right = spark.range(0, 9000, 2).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v")).union(spark.sql("select 7L, 'seven'")).union(
        spark.sql("select cast(null as bigint), 'nothing'"))
    names = f"left_{tag}", f"right_{tag}"
    hot = colocated.lay_out_left(left, names[0], f"{base}/left", "k", 8)
    colocated.lay_out_right(right, names[1], f"{base}/right", "k", 8, hot)
    yield left, right, names, hot
    colocated.drop(spark, *names)


def test_join_of_laid_out_tables_equals_the_plain_join(spark, laid_out):
    left, right, names, hot = laid_out
    assert sorted((r[0] is None, r[0], r[1]) for r in hot.collect()) == [(False, 7, 3), (True, None, 3)]
    got = colocated.colocated_left_join(spark, *names, "k", ["v"])
    want = enrich.enrich_left_join(left, right, "k", ["v"])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_join_of_laid_out_tables_has_no_exchange(spark, laid_out):
    _, _, names, _ = laid_out
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = colocated.colocated_left_join(spark, *names, "k", ["v"], on_duplicate="keep")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        unique = spark.table(names[1]).groupBy("k", colocated._SALT).count()
        assert "Exchange" not in unique._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_keys_are_split_among_buckets(spark, laid_out):
    _, _, names, _ = laid_out
    per_file = [r["count"] for r in spark.table(names[0]).groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == 9000 and max(per_file) < 3000          # each hot key alone has 3,000 rows


def test_duplicate_right_keys_are_found(spark, laid_out):
    base = shared_dir(spark, "colocated_dup")
    _, _, names, hot = laid_out
    right = spark.createDataFrame([(7, "a"), (7, "b"), (2, "c")], "k long, v string")
    name = "dup_" + base.rsplit("-", 1)[-1]
    colocated.lay_out_right(right, name, base, "k", 8, hot)
    with pytest.raises(ValueError, match="duplicate key"):
        colocated.colocated_left_join(spark, names[0], name, "k", ["v"])
    kept = colocated.colocated_left_join(spark, names[0], name, "k", ["v"], on_duplicate="keep")
    assert kept.count() == 9000 + 3000 and kept.where("v = 'c'").count() == 1
    colocated.drop(spark, name)


def test_no_hot_keys_and_no_rows(spark):
    base = shared_dir(spark, "colocated_none")
    tag = base.rsplit("-", 1)[-1]
    for i, left in enumerate((spark.range(500), spark.range(0))):
        names = f"l{i}_{tag}", f"r{i}_{tag}"
        hot = colocated.lay_out_left(left, names[0], f"{base}/l{i}", "id", 4)
        colocated.lay_out_right(spark.range(250).withColumn("v", F.lit(1)), names[1], f"{base}/r{i}", "id", 4, hot)
        got = colocated.colocated_left_join(spark, *names, "id", ["v"])
        assert hot.count() == 0 and (got.count(), got.where("v = 1").count()) == ((500, 250), (0, 0))[i]


def test_write_back_again_and_again(spark):
    base = shared_dir(spark, "again")
    laid = jobs.lay_out_wide(spark.range(100).selectExpr("cast(id as string) as code", "cast(null as int) as prediction"), "wide_again_test", base, "code", 4)
    for k in (3, 2):
        out = jobs.write_back_laid_out(laid, spark.range(60).selectExpr("cast(id as string) as code", f"cast(id % {k} as int) as prediction"))
        assert out.columns == ["code", "prediction"] and out.count() == 100
        assert out.where("prediction is not null").count() == 60 and out.agg(F.max("prediction")).first()[0] == k - 1
    colocated.drop(spark, "wide_again_test")
