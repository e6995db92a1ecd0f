"""Plan shape checks: pruning, pushdown, scans and exchanges per job."""


from martlet.operators import cluster, profile, rows, text
from martlet.plans.fixtures import dirty
from martlet.session import shared_dir
from tests.conftest import SF_SMALL


def _plan(df):
    df.collect()                  # run this DataFrame's own execution so AQE shows the final plan
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _dirty_parquet(spark):
    path = shared_dir(spark, "dirty_parquet")
    dirty(spark, SF_SMALL).write.parquet(path)
    return spark.read.parquet(path)


def test_clean_numeric_pushes_not_null_into_scan(spark):
    d = _dirty_parquet(spark)
    q = rows.clean_numeric(d, ["qty", "tax"], keys=["l_orderkey"])
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(qty)" in plan and "IsNotNull(tax)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,qty:string,tax:string>" in plan


def test_missing_profile_is_one_scan_one_final_row(spark):
    d = _dirty_parquet(spark)
    plan = _plan(profile.missing_profile(d))
    assert plan.count("FileScan parquet") == 1 or plan.count("Scan parquet") == 1
    assert "SinglePartition" in plan           # only per-task partial rows are exchanged


def test_word_count_exchanges_hash_then_range(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = text.word_count(docs, "text")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(word" in plan and "rangepartitioning(count" in plan
    assert "ReadSchema: struct<text:string>" in plan


def test_fixed_centre_assignment_has_no_join(spark):
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    q = cluster.assign_nearest(part.select("p_partkey", "p_size", "p_retailprice"),
                               ["p_size", "p_retailprice"], [(1.0, 900.0), (40.0, 990.0)])
    plan = _plan(q)
    assert "Join" not in plan and "Exchange" not in plan
    assert "WholeStageCodegen" in plan or "*(" in plan


def test_describe_is_one_aggregate(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    plan = _plan(profile.describe_numeric(li, ["l_quantity", "l_tax"]))
    assert plan.count("HashAggregate") == 2                    # partial + final
    assert "ReadSchema: struct<l_quantity:double,l_tax:double>" in plan


def test_hidden_column_filter_prunes_after_filtering(spark):
    d = _dirty_parquet(spark)
    q = rows.hidden_column_filter(d, {"price": 50000.0}, keep=["l_orderkey", "qty"])
    assert q.columns == ["l_orderkey", "qty"]
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,qty:string,price:string>" in plan
