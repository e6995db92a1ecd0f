"""Feature vectors, k-means, assignment and silhouette (M1-M5, A6) with MLlib.

MLlib k-means is already distributed: each iteration broadcasts k centres,
sums per partition and reduces k rows. Assignment to a fixed set of centres is
written as plain column arithmetic (k is bounded), so it stays inside
whole-stage codegen with no join at all.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Model parameters of the clustering job.
DEFAULT_K = 5
DEFAULT_SEED = 42


def assemble(df: DataFrame, input_cols: list[str], output_col: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """M1: numeric columns -> one vector column (``error`` on NULL/NaN by default)."""
    return VectorAssembler(inputCols=input_cols, outputCol=output_col,
                           handleInvalid=handle_invalid).transform(df)


def array_features(df: DataFrame, array_col: str, output_col: str = "features") -> DataFrame:
    """array<float|double> column -> ML vector column."""
    return df.withColumn(output_col, array_to_vector(F.col(array_col)))


def vector_as_array(col: str) -> Column:
    return vector_to_array(F.col(col))


def repeatable_layout(df: DataFrame, key: str, num_partitions: int) -> DataFrame:
    """Deterministic partition contents and row order: hash on ``key`` into a
    fixed number of partitions, sorted by ``key`` inside each. MLlib's seeded
    k-means depends on both, so this makes a fit repeatable whatever layout the
    input arrived in."""
    return df.repartition(num_partitions, F.col(key)).sortWithinPartitions(key)


def fit_kmeans(df: DataFrame, k: int = DEFAULT_K, seed: int = DEFAULT_SEED,
               features_col: str = "features", prediction_col: str = "prediction",
               max_iter: int = 20, tol: float = 1e-4, order_key: str | None = None,
               num_partitions: int | None = None) -> KMeansModel:
    """M2: ``KMeans(k).setSeed(seed).fit`` with MLlib defaults (k-means||, 2 init
    steps, euclidean). Features are not scaled, as in the job.

    With a fixed seed the result still depends on the input partitioning; give a
    unique ``order_key`` (and ``num_partitions``) for a repeatable fit."""
    if order_key is not None:
        n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        df = repeatable_layout(df, order_key, n)
    km = KMeans(k=k, seed=seed, featuresCol=features_col, predictionCol=prediction_col,
                maxIter=max_iter, tol=tol)
    return km.fit(df)


def squared_distance(cols: list[str], centre) -> Column:
    parts = [(F.col(c).cast("double") - F.lit(float(v))) * (F.col(c).cast("double") - F.lit(float(v)))
             for c, v in zip(cols, centre)]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def assign_nearest(df: DataFrame, cols: list[str], centres, prediction_col: str = "prediction") -> DataFrame:
    """M3 for given centres: index of the nearest centre (squared euclidean);
    ties go to the lowest index."""
    if not centres:
        raise ValueError("assign_nearest needs at least one centre")
    dists = [squared_distance(cols, c) for c in centres]
    tmp = [f"__d{i}" for i in range(len(dists))]
    with_d = df.select("*", *[d.alias(t) for d, t in zip(dists, tmp)])
    best = F.least(*[F.col(t) for t in tmp]) if len(tmp) > 1 else F.col(tmp[0])
    pick = None
    for i in reversed(range(len(tmp))):
        cond = F.col(tmp[i]) == best
        pick = F.when(cond, F.lit(i)) if pick is None else F.when(cond, F.lit(i)).otherwise(pick)
    return with_d.withColumn(prediction_col, pick.cast("int")).drop(*tmp)


def predict(model: KMeansModel, df: DataFrame) -> DataFrame:
    """M3 with a fitted model."""
    return model.transform(df)


def silhouette(df: DataFrame, features_col: str = "features", prediction_col: str = "prediction",
               distance: str = "squaredEuclidean") -> float:
    """M4: mean silhouette (MLlib computes it from per-cluster sums: linear in rows)."""
    ev = ClusteringEvaluator(featuresCol=features_col, predictionCol=prediction_col,
                             metricName="silhouette", distanceMeasure=distance)
    return ev.evaluate(df)


def cluster_statistics(df: DataFrame, features_col: str = "features", prediction_col: str = "prediction") -> DataFrame:
    """Per cluster what the silhouette needs of it: n, the sum of its vectors and of their squared lengths."""
    x = vector_to_array(F.col(features_col))
    return df.where(F.col(prediction_col).isNotNull()).groupBy(F.col(prediction_col).alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"), vector_to_array(Summarizer.sum(F.col(features_col))).alias("vector_sum"),
        F.sum(_dot(x, x)).alias("square_sum"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def silhouette_rows(df: DataFrame, features_col: str = "features", prediction_col: str = "prediction") -> DataFrame:
    """M4 per row: ``df`` with ``silhouette`` (squared euclidean).

    The mean squared distance of a row to a cluster follows from the cluster's
    statistics, so rows never meet each other: k rows of statistics, one array in a
    scalar subquery, go to every row. 0 in a cluster of one row or where there is no
    other cluster; NULL without a cluster.
    """
    stats = cluster_statistics(df, features_col, prediction_col).agg(F.collect_list(F.struct("cluster", "n", "vector_sum", "square_sum"))).scalar()
    x, own = vector_to_array(F.col(features_col)), F.col(prediction_col)

    def mean(s: Column) -> Column:       # over the other rows of the cluster: a row is at no distance from itself
        total = s.n * F.col("__xx") + s.square_sum - 2 * _dot(F.col("__x"), s.vector_sum)
        return F.struct(s.cluster.alias("cluster"), (total / F.when(s.cluster == own, F.greatest(s.n - 1, F.lit(1))).otherwise(s.n)).alias("d"), s.n.alias("n"))

    far = df.withColumn("__x", x).withColumn("__xx", _dot(F.col("__x"), F.col("__x"))).withColumn("__stats", stats).withColumn(
        "__far", F.transform("__stats", mean))
    same = F.filter("__far", lambda s: s.cluster == own)[0]
    b = F.array_min(F.transform(F.filter("__far", lambda s: s.cluster != own), lambda s: s.d))
    a = same.d
    value = F.when(own.isNull(), F.lit(None).cast("double")).when((same.n == 1) | b.isNull() | (F.greatest(a, b) == 0), F.lit(0.0)).otherwise((b - a) / F.greatest(a, b))
    return far.withColumn("silhouette", value).drop("__x", "__xx", "__stats", "__far")


def silhouette_by_cluster(df: DataFrame, features_col: str = "features", prediction_col: str = "prediction") -> DataFrame:
    """M4 per cluster: rows, and the mean silhouette of its rows."""
    return silhouette_rows(df, features_col, prediction_col).groupBy(prediction_col).agg(
        F.count(F.lit(1)).alias("size"), F.avg("silhouette").alias("silhouette"))


def cluster_sizes(df: DataFrame, prediction_col: str = "prediction") -> DataFrame:
    """Rows per cluster."""
    return df.groupBy(prediction_col).agg(F.count(F.lit(1)).alias("size"))


def model_summary(model: KMeansModel) -> dict:
    """M5: k, cluster sizes and whether a training summary is attached."""
    has = model.hasSummary
    return {"k": len(model.clusterCenters()), "has_summary": has,
            "cluster_sizes": list(model.summary.clusterSizes) if has else None}


def relabel_by_centre_order(df: DataFrame, model: KMeansModel, dim: int = 0,
                            prediction_col: str = "prediction", output_col: str = "cluster") -> DataFrame:
    """Cluster ids renumbered by the ``dim`` coordinate of their centre, so
    results can be compared across runs and partitionings."""
    centres = model.clusterCenters()
    order = sorted(range(len(centres)), key=lambda i: float(centres[i][dim]))
    mapping = {old: new for new, old in enumerate(order)}
    expr = F.create_map(*[x for old, new in mapping.items() for x in (F.lit(old), F.lit(new))])
    return df.withColumn(output_col, expr[F.col(prediction_col)].cast("int"))


def save_model(model: KMeansModel, path: str) -> str:
    """K7: write the model (overwrite) to a shared path."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> KMeansModel:
    return KMeansModel.load(path)
