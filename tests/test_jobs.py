import pytest
from pyspark.sql import functions as F

from martlet.plans import jobs
from martlet.plans.fixtures import dirty_part
from martlet.session import shared_dir
from tests.conftest import SF_CHECK


def _wide(spark):
    rows = []
    for i in range(300):
        g = i % 3
        rows.append((f"c{i:04d}", f"{g * 30 + (i % 7)}", f"{g * 20 + 1}", None if i % 10 == 0 else "x", None))
    return spark.createDataFrame(rows, "code string, fat_100g string, sugars_100g string, url string, "
                                       "prediction string")


def test_run_stages_chain(spark):
    wide = _wide(spark)
    base = shared_dir(spark, "chain")
    tag = base.rsplit("-", 1)[-1]
    wname, mname = f"wide_{tag}", f"mart_{tag}"
    wide.write.parquet(f"{base}/seed")
    spark.sql(f"CREATE TABLE {wname} USING parquet LOCATION '{base}/seed'")
    cfg = jobs.MartConfig(wide_table=wname, mart_table=mname, base_dir=base,
                               features=["fat_100g", "sugars_100g"], k=3)
    with pytest.raises(ValueError):
        jobs.run_stages(spark, ["Write"], cfg)   # table missing / not clustered
    rep = jobs.run_stages(spark, ["PREPROCESS", "clusterize", "write"], cfg)
    assert rep["preprocess"]["rows"] == 300
    assert sum(rep["clusterize"]["cluster_sizes"]) == 300
    out = spark.table(wname)
    assert out.count() == 300                      # no doubling on write-back
    assert out.where(F.col("prediction").isNull()).count() == 0
    assert out.select("prediction").distinct().count() == 3


def test_unknown_stage_rejected(spark):
    with pytest.raises(ValueError):
        jobs.run_stages(spark, ["deploy"], jobs.MartConfig("a", "b", "/nowhere"))


def test_flagship_figures_at_sf001(spark):
    enriched, res = jobs.mart_end_to_end(dirty_part(spark, SF_CHECK), "code", ["size_g", "price_g"])
    r = jobs.mart_invariants(enriched).first()
    assert (r.n_rows, r.n_with_prediction, r.n_clusters) == (2000, 1285, 5)
    assert -1 <= res.silhouette <= 1 and sum(res.sizes) == 1285


def test_explore_drops_sparse(spark):
    df = spark.createDataFrame([("a", None, "1"), ("b", None, "2"), ("c", "x", "unknown")],
                               "code string, sparse string, v string")
    out = jobs.explore(df, ["code", "sparse", "v"], strict=False).pruned
    assert out.columns == ["code", "v"] and out.count() == 3


def test_command_line_stages_and_wordcount(spark):
    from martlet.__main__ import main

    base = shared_dir(spark, "cli")
    tag = base.rsplit("-", 1)[-1]
    _wide(spark).write.parquet(f"{base}/seed")
    spark.sql(f"CREATE TABLE wide_cli_{tag} USING parquet LOCATION '{base}/seed'")
    rep = main(["stages", "preprocess", "CLUSTERIZE", "write", "--wide", f"wide_cli_{tag}", "--mart",
                f"mart_cli_{tag}", "--base", base, "--features", "fat_100g,sugars_100g", "--k", "3"])
    assert set(rep) == {"preprocess", "clusterize", "write"} and rep["write"]["rows"] == 300
    docs = f"{base}/docs"
    spark.createDataFrame([("the red fish",), ("red",)], "t string").write.parquet(docs)
    main(["wordcount", "--input", docs, "--text-col", "t", "--output", f"{base}/wc"])
    got = {r.word: r["count"] for r in spark.read.parquet(f"{base}/wc").collect()}
    assert got == {"red": 2, "fish": 1}
    spark.createDataFrame([("the red fish",), ("red",)], "t string").write.option("header", "true").csv(f"{base}/csv")
    main(["wordcount", "--input", f"{base}/csv", "--format", "csv", "--option", "header=true", "--text-col", "t",
          "--output", f"{base}/wc_csv", "--top", "1"])
    assert [(r.word, r["count"]) for r in spark.read.parquet(f"{base}/wc_csv").collect()] == [("red", 2)]


def test_command_line_exits_non_zero_on_unknown_stage():
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    proc = subprocess.run([sys.executable, "-m", "martlet", "stages", "deploy", "--wide", "a", "--mart", "b",
                           "--base", "/nowhere"], cwd=repo, capture_output=True, text=True, timeout=300)
    assert proc.returncode == 1
    assert "unknown stages" in proc.stderr


def test_command_line_limits_partitioned_reads_and_resumes(spark):
    from martlet.__main__ import main

    base = shared_dir(spark, "cli_resume")
    tag = base.rsplit("-", 1)[-1]
    args = ["stages", "preprocess", "--wide", f"w_{tag}", "--mart", f"m_{tag}", "--base", base, "--features", "fat_100g"]
    with pytest.raises(ValueError, match="at most 100"):
        main([*args, "--wide-source", "jdbc", "--wide-source-option", "numPartitions=101"])
    from martlet.sources import tables
    tables.publish(spark, _wide(spark), f"w_{tag}", f"{base}/w_{tag}")
    assert "resumed" not in main(args)["preprocess"] and main([*args, "--resume"])["preprocess"]["resumed"]


def test_clusterize_repeatable_by_key(spark):
    mart = dirty_part(spark, SF_CHECK)
    clean = jobs.preprocess(mart, "code", ["size_g", "price_g"])
    a = jobs.clusterize(clean, ["size_g", "price_g"], order_key="code", num_partitions=3)
    b = jobs.clusterize(clean.repartition(5), ["size_g", "price_g"], order_key="code", num_partitions=3)
    assert sorted(map(tuple, a.model.clusterCenters())) == sorted(map(tuple, b.model.clusterCenters()))
    assert sorted(a.sizes) == sorted(b.sizes) and sum(a.sizes) == 1285


def test_explore_reports_counts_figures_and_dropped_columns(spark):
    df = spark.createDataFrame([("a", None, "1", "u"), ("b", None, "2", "u"), ("c", "x", None, "u"), ("d", None, "4", "u")],
                               "code string, sparse string, v string, image_url string")
    out = jobs.explore(df, ["code", "sparse", "v"], name_tokens=["url"], strict=False)
    assert (out.n_rows, out.n_pruned, out.dropped) == (4, 3, ["sparse"]) and out.missing == {"code": 0.0, "sparse": 75.0, "v": 25.0}
    assert out.pruned.columns == ["code", "v"]
    figures = {r.column_name: r for r in out.figures.collect()}
    assert {c: (r["n_rows"], r["count"], r.missing_pct, r.kept) for c, r in figures.items()} == {
        "code": (4, 4, 0.0, True), "sparse": (4, 1, 75.0, False), "v": (4, 3, 25.0, True), "image_url": (4, 4, 0.0, False)}
    assert figures["v"]["min"] == "1" and round(figures["v"]["mean"], 6) == 2.333333
    with pytest.raises(ValueError, match="sparse"):
        jobs.explore(df, ["code", "sparse", "v"])


def test_explore_reads_its_table_once(spark):
    base = shared_dir(spark, "explored")
    spark.range(200).selectExpr(*[f"cast(id % {k + 2} as string) as c{k}" for k in range(120)]).write.parquet(base)
    out = jobs.explore(spark.read.parquet(base), ["c0", "c1"])
    from martlet.session import delete_path
    delete_path(spark, base)                    # what follows reads the staged copy
    assert out.pruned.count() == out.n_pruned == 200 and out.figures.where("kept").count() == 2 and out.figures.count() == 120


def test_chain_applies_extra_bounds_and_saves_the_model(spark):
    from martlet.operators import cluster
    from martlet.sources import tables

    base = shared_dir(spark, "bounds")
    tag = base.rsplit("-", 1)[-1]
    wide = spark.range(120).selectExpr("cast(id as string) as code", "cast(id % 3 * 20 + id / 200 as string) as x",
                                       "cast(id * 10 as string) as energy")
    tables.publish(spark, wide, f"wide_{tag}", f"{base}/w")
    cfg = jobs.MartConfig(f"wide_{tag}", f"mart_{tag}", base, key="code", features=["x"], k=3,
                          extra_bounds={"energy": 900}, model_path=f"{base}/model")
    report = jobs.run_stages(spark, ["preprocess", "clusterize", "write"], cfg)
    assert report["preprocess"]["rows"] == 90 and report["write"]["rows"] == 120
    assert len(cluster.load_model(report["clusterize"]["model"]).clusterCenters()) == 3
    assert spark.table(f"wide_{tag}").where("prediction is not null").count() == 90


def test_stages_read_and_write_formats_with_options(spark):
    from martlet import __main__ as cli

    base = shared_dir(spark, "formats")
    tag = base.rsplit("-", 1)[-1].replace("-", "_")
    spark.range(90).selectExpr("cast(id as string) as code", "cast(id % 3 * 20 + id / 200 as string) as x").write.csv(
        f"{base}/wide", header=True, sep="|")
    report = cli.main([
        "stages", "preprocess", "clusterize", "write", "--wide", f"w_{tag}", "--mart", f"m_{tag}", "--base", base, "--features", "x", "--k", "3",
        "--wide-source", "csv", "--wide-source-option", f"path={base}/wide", "--wide-source-option", "header=true",
        "--wide-source-option", "sep=|", "--mart-source", "json", "--mart-source-option", f"path={base}/mart",
        "--mart-sink", "json", "--mart-sink-option", f"path={base}/mart",
        # The wide table goes back to where it came from.
        "--wide-sink", "csv", "--wide-sink-option", f"path={base}/wide", "--wide-sink-option", "header=true", "--wide-sink-option", "sep=|"])
    assert report["preprocess"]["sink"] == "json" and report["clusterize"]["sink"] == "json" and report["write"]["sink"] == "csv"
    back = spark.read.csv(f"{base}/wide", header=True, sep="|")
    assert back.count() == 90 and back.select("prediction").distinct().count() == 3
    assert spark.read.json(f"{base}/mart").where("prediction is not null").count() == 90
    with pytest.raises(ValueError, match="does not exist"):
        jobs.run_stages(spark, ["clusterize"], jobs.MartConfig(f"w_{tag}", "no_such_mart", base))


def _chain(spark):
    from martlet.sources import tables
    base = shared_dir(spark, "resume")
    tag = base.rsplit("-", 1)[-1]
    wide = spark.range(90).selectExpr("cast(id as string) as code", "cast(id % 3 * 20 + id / 200 as string) as x")
    tables.publish(spark, wide, f"w_{tag}", f"{base}/w_{tag}")
    return jobs.MartConfig(f"w_{tag}", f"m_{tag}", base, features=["x"], k=3)


def test_a_failed_chain_goes_on_at_the_first_stage_without_a_commit(spark, monkeypatch):
    from martlet.sources import tables
    cfg, stages = _chain(spark), ["preprocess", "clusterize", "write"]
    ran = []
    for name in ("preprocess", "clusterize", "write_back"):
        monkeypatch.setattr(jobs, name, lambda *a, _f=getattr(jobs, name), _n=name, **k: ran.append(_n) or _f(*a, **k))
    fit = jobs.cluster.fit_kmeans
    monkeypatch.setattr(jobs.cluster, "fit_kmeans", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.run_stages(spark, stages, cfg, resume=True)
    monkeypatch.setattr(jobs.cluster, "fit_kmeans", fit)
    report = jobs.run_stages(spark, stages, cfg, resume=True)
    assert ran == ["preprocess", "clusterize", "clusterize", "write_back"]           # stage one ran once
    assert report["preprocess"]["resumed"] and "resumed" not in report["clusterize"]
    assert spark.table(cfg.wide_table).where("prediction is not null").count() == 90

    again = jobs.run_stages(spark, stages, cfg, resume=True)                          # all committed: nothing runs
    assert len(ran) == 4 and all(r["resumed"] for r in again.values()) and again["write"]["path"] == report["write"]["path"]
    other = jobs.run_stages(spark, stages, jobs.MartConfig(**{**vars(cfg), "k": 2}), resume=True)   # another parameter: all but none
    assert "resumed" not in other["clusterize"] and len(other["clusterize"]["cluster_sizes"]) == 2
    tables.publish(spark, spark.range(30).selectExpr("cast(id as string) as code", "cast(id % 3 as string) as x"), cfg.wide_table,
                   f"{cfg.base_dir}/{cfg.wide_table}")
    fresh = jobs.run_stages(spark, stages, cfg, resume=True)                          # another input: all again
    assert not any("resumed" in r for r in fresh.values()) and fresh["write"]["rows"] == 30


def test_a_chain_without_resume_always_runs_and_inputs_without_versions_too(spark):
    cfg = _chain(spark)
    jobs.run_stages(spark, ["preprocess"], cfg)
    assert "resumed" not in jobs.run_stages(spark, ["preprocess"], cfg)["preprocess"]
    assert "resumed" in jobs.run_stages(spark, ["preprocess"], cfg, resume=True)["preprocess"]
    path = f"{cfg.base_dir}/plain"
    spark.table(cfg.wide_table).write.parquet(path)
    read = jobs.MartConfig(**{**vars(cfg), "sources": {cfg.wide_table: ("parquet", {"path": path})}})
    for _ in range(2):
        assert "resumed" not in jobs.run_stages(spark, ["preprocess"], read, resume=True)["preprocess"]


def test_duplicate_keys_are_found_on_the_published_layout(spark):
    from martlet.sources import tables
    cfg = _chain(spark)
    twice = spark.range(90).selectExpr("cast(id % 60 as string) as code", "cast(id % 3 * 20 + id / 200 as string) as x")
    tables.publish(spark, twice, cfg.wide_table, f"{cfg.base_dir}/{cfg.wide_table}")
    jobs.run_stages(spark, ["preprocess", "clusterize"], cfg)                         # clustering needs no unique key
    with pytest.raises(ValueError, match="duplicate key"):
        jobs.run_stages(spark, ["write"], cfg)


def test_end_to_end_cleans_once_and_joins_without_counting_keys(spark, monkeypatch):
    from martlet.operators import enrich
    monkeypatch.setattr(enrich, "check_unique", lambda *a: 1 / 0)
    cleaned = []
    monkeypatch.setattr(jobs, "preprocess", lambda *a, _f=jobs.preprocess, **k: cleaned.append(1) or _f(*a, **k))
    enriched, _ = jobs.mart_end_to_end(dirty_part(spark, SF_CHECK), "code", ["size_g", "price_g"])
    plan = enriched._jdf.queryExecution().optimizedPlan().toString()
    assert len(cleaned) == 1 and plan.count("part.parquet") <= 1 and plan.count("try_cast") == 0
    twice = dirty_part(spark, SF_CHECK).withColumn("code", F.lit("same"))
    with pytest.raises(ValueError, match="duplicate key"):
        jobs.mart_end_to_end(twice, "code", ["size_g", "price_g"])


def test_full_mart_plots_saves_and_republishes(spark):
    from martlet.operators import cluster
    base = shared_dir(spark, "full")
    wide = spark.range(120).selectExpr("cast(id as string) as code", "cast(id % 4 * 40 - 5 + id / 200 as string) as x", "if(id % 10 = 0, null, cast(id * 10 as string)) as energy")
    report = jobs.full_mart(wide, "martlet_full_test", base, "code", ["x"], k=2, extra_bounds={"energy": 900})
    plots = {r.stage: r for r in report.plots.collect()}
    assert set(plots) == set(jobs.FILTERS) and plots["cast"].whisker_low < 0 <= plots["lower"].whisker_low and plots["upper"].whisker_high < 100 < plots["extra"].whisker_high
    want = sum(1 for i in range(120) if i % 10 and i < 90 and 0 <= i % 4 * 40 - 5 + i / 200 < 100)
    assert report.enriched.count() == report.published["rows"] == 120
    assert report.enriched.where("prediction is not null").count() == want == sum(report.clusters.sizes)
    assert len(cluster.load_model(report.model_path).clusterCenters()) == 2
    spark.sql("DROP VIEW martlet_full_test")
