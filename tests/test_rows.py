import pytest
from pyspark.sql import functions as F

from martlet.operators import rows
from tests.conftest import SF_SMALL

CELLS = ["1.5", None, "NaN", "abc", "", "150", "100", "-1", "0", "1e2", "inf"]


def _cells(spark):
    return spark.createDataFrame([(str(i), v) for i, v in enumerate(CELLS)], "code string, x string")


def test_clean_numeric_golden(spark):
    got = sorted(r["x"] for r in rows.clean_numeric(_cells(spark), ["x"], keys=["code"]).collect())
    assert got == [0.0, 1.5]


def test_clean_numeric_schema_is_float(spark):
    out = rows.clean_numeric(_cells(spark), ["x"], keys=["code"])
    assert dict(out.dtypes) == {"code": "string", "x": "float"}


def test_shipped_job_order_keeps_unparsable_as_null(spark):
    # drop-then-cast, range filters discarded: the job's written rows
    out = rows.clean_numeric(_cells(spark), ["x"], keys=["code"], apply_range=False, drop_after_cast=False)
    vals = [r["x"] for r in out.collect()]
    assert len(vals) == len(CELLS) - 1          # only the NULL string is dropped
    assert vals.count(None) == 2                # 'abc' and '' become NULL after the drop


def test_clean_is_idempotent(spark):
    once = rows.clean_numeric(_cells(spark), ["x"], keys=["code"])
    twice = rows.clean_numeric(once.withColumn("x", F.col("x").cast("string")), ["x"], keys=["code"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_range_filter_drops_nan_and_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (100.0,), (-0.5,)], "x double")
    assert [r.x for r in rows.range_filter(df, ["x"]).collect()] == [1.0]


def test_hidden_column_filter_outside_projection(spark):
    df = spark.createDataFrame([("a", "10", "999.9"), ("b", "20", "1000"), ("c", "30", None),
                                ("d", "40", "1e2")], "code string, x string, energy string")
    out = rows.hidden_column_filter(df, {"energy": 1000.0}, keep=["code", "x"])
    assert out.columns == ["code", "x"]
    assert sorted(r.code for r in out.collect()) == ["a", "d"]


def test_drop_incomplete_pushes_is_not_null(spark):
    df = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    plan = rows.drop_incomplete(df.select("p_partkey", "p_name"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(p_partkey), IsNotNull(p_name)]" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan


def test_drop_incomplete_drops_nan_on_numbers(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None)], "k int, x double")
    assert [r.k for r in rows.drop_incomplete(df).collect()] == [1]


def test_limit_rows_is_ordered(spark):
    df = spark.range(100).withColumn("k", 99 - F.col("id"))
    assert sorted(r.k for r in rows.limit_rows(df, 3, order_by=["k"]).collect()) == [0, 1, 2]
    assert sorted(r.k for r in rows.limit_rows(df, 3, order_by=["-k"]).collect()) == [97, 98, 99]


@pytest.mark.parametrize("n", [0, 1, 49, 50, 51, 500, 999, 1000, 5000])
def test_limit_rows_cuts_anywhere(spark, n):
    """With ties, a hot key and NULL keys; the same rows on every layout."""
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id")).alias("k"), "id")
    got = [sorted(r.id for r in rows.limit_rows(d, n, order_by=["k"]).collect()) for d in (df, df.repartition(5))]
    assert got[0] == got[1] and len(got[0]) == min(n, 1000)
    nulls = {i for i in range(1000) if i % 3 == 0}
    assert set(got[0]) <= nulls if n <= len(nulls) else nulls <= set(got[0])
    assert rows.limit_rows(df, n).count() == min(n, 1000)


def test_limit_rows_filters_where_rows_lie(spark, tmp_path):
    """Half the table, a third of it on one key: no top-n in one task, no shuffle of rows, a bound that reaches the scan."""
    spark.range(40_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id").repartition(8).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    half = rows.limit_rows(df, 20_000, order_by=["k", "id"])
    plan = half._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Limit" not in plan and "Exchange" not in plan and "LessThanOrEqual(k" in plan.replace("LessThan(k", "LessThanOrEqual(k")
    assert sorted(map(tuple, half.collect())) == sorted(map(tuple, df.collect()))[:20_000]
    inside = rows.limit_rows(df, 5_000, order_by=["k"])              # the cut is among the rows of the hot key
    assert "Limit" not in inside._jdf.queryExecution().executedPlan().toString()
    got = [r.k for r in inside.collect()]
    assert len(got) == 5_000 and sorted(got) == sorted(r.k for r in df.collect())[:5_000]


@pytest.mark.parametrize("order", [["a"], ["-a"], ["a", "-b"], ["-b", "a", "c"], ["c", "-a"], ["x", "a"], ["-x"], ["s", "-d"]])
def test_limit_rows_follows_sparks_order(spark, order):
    """NULLs, NaN, dates, text; ascending and descending."""
    df = spark.range(300).selectExpr(
        "if(id % 7 = 0, null, id % 11) as a", "if(id % 5 = 0, null, cast(id % 13 as string)) as b", "id as c",
        "case when id % 9 = 0 then double('NaN') when id % 4 = 0 then null else id / 8 end as x", "date_add(date'2024-01-01', cast(id % 17 as int)) as d",
        "decode(cast(array('é', 'z', 'A', '', 'zz')[cast(id % 5 as int)] as binary), 'UTF-8') as s")
    names = [o.removeprefix("-") for o in order]
    want = [tuple(r) for r in df.orderBy(*[F.desc(o[1:]) if o[0] == "-" else F.asc(o) for o in order]).select(*names).collect()]
    for n in (1, 60, 150, 299):
        got = rows.limit_rows(df, n, order_by=order)
        again = got.orderBy(*[F.desc(o[1:]) if o[0] == "-" else F.asc(o) for o in order]).select(*names).collect()
        assert repr([tuple(r) for r in again]) == repr(want[:n]) and got.columns == df.columns
        assert got.select("c").distinct().count() == n


def test_stop_list_filter_list_and_frame_agree(spark):
    words = spark.createDataFrame([(1, "the"), (2, "fish"), (3, None), (4, "and"), (5, "red")], "id int, word string")
    by_list = rows.stop_list_filter(words, "word", ["the", "and"])
    stop_df = spark.createDataFrame([("the",), ("and",), (None,), ("the",)], "w string")
    by_frame = rows.stop_list_filter(words, "word", stop_df)
    assert sorted(map(tuple, by_list.collect())) == sorted(map(tuple, by_frame.collect())) == [(2, "fish"), (5, "red")]
