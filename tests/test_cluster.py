import numpy as np
import pytest
from pyspark.sql import functions as F

from martlet.operators import cluster
from martlet.session import shared_dir


def test_assign_nearest_ties_go_to_lowest(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 5.0, 0.0), (3, 9.0, 0.0)], "id int, x double, y double")
    centres = [(10.0, 0.0), (0.0, 0.0), (10.0, 0.0)]
    got = {r.id: r.prediction for r in cluster.assign_nearest(df, ["x", "y"], centres).collect()}
    assert got == {1: 1, 2: 0, 3: 0}   # id 2 ties between 0 and 1 -> 0; 3 ties 0 and 2 -> 0


def test_assign_nearest_matches_model_transform(spark):
    rng = np.random.default_rng(1)
    pts = rng.normal(size=(300, 2)) + np.repeat(np.array([[0, 0], [6, 6], [0, 6]]), 100, axis=0)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "id int, x double, y double")
    feats = cluster.assemble(df, ["x", "y"])
    model = cluster.fit_kmeans(feats, k=3, seed=42)
    centres = [tuple(c) for c in model.clusterCenters()]
    mine = cluster.assign_nearest(df, ["x", "y"], centres).select("id", "prediction")
    theirs = model.transform(feats).select("id", F.col("prediction").alias("p2"))
    assert mine.join(theirs, "id").where("prediction != p2").count() == 0
    assert sum(model.summary.clusterSizes) == 300


def _brute_silhouette(points, labels):
    n = len(points)
    s = []
    for i in range(n):
        d = ((points - points[i]) ** 2).sum(axis=1)
        own = labels == labels[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[own].sum() / (own.sum() - 1)
        b = min(d[labels == l].mean() for l in set(labels) if l != labels[i])
        s.append((b - a) / max(a, b))
    return float(np.mean(s))


def test_silhouette_matches_pairwise_definition(spark):
    rng = np.random.default_rng(5)
    pts = rng.normal(size=(120, 3))
    labels = rng.integers(0, 4, 120)
    df = spark.createDataFrame([(pts[i].tolist(), int(labels[i])) for i in range(120)], "v array<double>, label int")
    got = cluster.silhouette(cluster.array_features(df, "v"), prediction_col="label")
    assert got == pytest.approx(_brute_silhouette(pts, labels), abs=1e-9)


def test_model_roundtrip_and_relabel(spark):
    df = spark.createDataFrame([(float(x), float(k * 100 + x % 3)) for k in range(3) for x in range(20)],
                               "a double, b double")
    feats = cluster.assemble(df, ["b"])
    model = cluster.fit_kmeans(feats, k=3, seed=42)
    loaded = cluster.load_model(cluster.save_model(model, shared_dir(spark, "test_model")))
    assert np.allclose(np.array(model.clusterCenters()), np.array(loaded.clusterCenters()))
    assert loaded.hasSummary is False
    rel = cluster.relabel_by_centre_order(model.transform(feats), model)
    by_b = {int(r.b // 100): r.cluster for r in rel.collect()}
    assert by_b == {0: 0, 1: 1, 2: 2}


def test_cluster_sizes_sum_to_rows(spark):
    df = spark.range(50).select((F.col("id") % 4).alias("prediction"))
    assert sum(r["size"] for r in cluster.cluster_sizes(df).collect()) == 50


def test_assemble_errors_on_null_by_default(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception):
        cluster.assemble(df, ["a", "b"]).collect()
    assert cluster.assemble(df, ["a", "b"], handle_invalid="skip").count() == 0


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_blobs_relabelled_are_partition_independent(spark, parts):
    from tests.conftest import SF_CHECK
    part = spark.read.parquet(f"{SF_CHECK}/part.parquet").select(
        "p_partkey",
        ((F.col("p_partkey") % 5) * 1000 + F.col("p_size")).cast("double").alias("x"),
        (F.col("p_retailprice") / 1000).alias("y")).repartition(parts)
    feats = cluster.assemble(part, ["x", "y"])
    model = cluster.fit_kmeans(feats, k=5, seed=42)
    out = cluster.relabel_by_centre_order(model.transform(feats), model, dim=0)
    assert out.where(F.col("cluster") != (F.col("p_partkey") % 5)).count() == 0


def test_fit_is_repeatable_with_an_order_key(spark):
    from tests.conftest import SF_CHECK
    part = spark.read.parquet(f"{SF_CHECK}/part.parquet").select("p_partkey", "p_size", "p_retailprice")
    centres = []
    for layout in (1, 6):
        feats = cluster.assemble(part.repartition(layout), ["p_size", "p_retailprice"])
        m = cluster.fit_kmeans(feats, k=5, seed=42, order_key="p_partkey", num_partitions=4)
        centres.append(sorted(tuple(c) for c in m.clusterCenters()))
    assert np.allclose(np.array(centres[0]), np.array(centres[1]))


def test_silhouette_per_row_equals_the_definition(spark):
    rng = np.random.default_rng(4)
    x = np.r_[rng.normal(0, 1, (40, 3)), rng.normal(3, 1, (30, 3)), rng.normal(-4, 2, (20, 3)), [[9.0, 9.0, 9.0]]]
    label = [0] * 40 + [1] * 30 + [2] * 20 + [3]
    df = cluster.array_features(spark.createDataFrame([(i, v.tolist(), c) for i, (v, c) in enumerate(zip(x, label))], "id int, a array<double>, c int"), "a")
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    label = np.array(label)
    want = []
    for i, c in enumerate(label):
        own = (label == c).sum()
        b = min(d[i, label == o].mean() for o in set(label) - {c})
        a = d[i, label == c].sum() / max(1, own - 1)
        want.append(0.0 if own == 1 else (b - a) / max(a, b))
    got = {r.id: r.silhouette for r in cluster.silhouette_rows(df, prediction_col="c").collect()}
    assert [got[i] for i in range(len(x))] == pytest.approx(want, abs=1e-9)
    assert cluster.silhouette(df, prediction_col="c") == pytest.approx(np.mean(want), abs=1e-6)
    per = {r.c: (r["size"], r.silhouette) for r in cluster.silhouette_by_cluster(df, prediction_col="c").collect()}
    assert per[1] == (30, pytest.approx(np.mean(np.array(want)[label == 1]), abs=1e-9)) and per[3] == (1, 0.0)


def test_silhouette_of_one_cluster_and_of_rows_without_one(spark):
    df = cluster.array_features(spark.createDataFrame([(1, [1.0], 0), (2, [2.0], 0), (3, [5.0], None)], "id int, a array<double>, c int"), "a")
    assert {r.id: r.silhouette for r in cluster.silhouette_rows(df, prediction_col="c").collect()} == {1: 0.0, 2: 0.0, 3: None}
