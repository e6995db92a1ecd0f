"""User-level jobs (J-A .. J-G). They take and return DataFrames; I/O happens
only at the edges (``run_stages`` reads and publishes tables).
"""

from __future__ import annotations

import functools
import hashlib
import json
import uuid
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.operators import cluster, columns, enrich, profile, rows
from martlet.session import WIDE_ROWS, delete_path, shared_dir, stage, unstage
from martlet.sources import colocated, tables

# Columns of the product mart.
MART_KEY = "code"
MART_FEATURES = ["fat_100g", "carbohydrates_100g", "sugars_100g", "proteins_100g",
                 "salt_100g", "sodium_100g"]


def preprocess(df: DataFrame, key: str, features: list[str], **clean_opts) -> DataFrame:
    """J-A: wide table -> numeric mart (key + float features, cleaned)."""
    return rows.clean_numeric(df, features, keys=[key], **clean_opts)


@dataclass
class ClusterResult:
    predictions: DataFrame
    model: object
    silhouette: float
    sizes: list[int]


def clusterize(mart: DataFrame, features: list[str], k: int = cluster.DEFAULT_K,
               seed: int = cluster.DEFAULT_SEED, keep: list[str] | None = None,
               order_key: str | None = None, num_partitions: int | None = None) -> ClusterResult:
    """J-B: assemble -> fit -> predict -> silhouette.

    The fit gets the unpersisted frame on purpose: MLlib then caches its own
    decoded vectors for the iterations, which measured twice as fast as
    iterating over a persisted DataFrame. The scored frame is persisted (memory,
    spilling to disk) only for the evaluator's two passes, then released. The
    returned predictions are lazy and recompute from the input with the fitted
    model, which is deterministic; persistence is never needed for correctness.
    ``order_key`` (a unique key) makes the fit repeatable across input layouts.
    """
    assembled = cluster.assemble(mart, features)
    model = cluster.fit_kmeans(assembled, k=k, seed=seed, order_key=order_key, num_partitions=num_partitions)
    scored = model.transform(assembled).select("features", "prediction").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        score = cluster.silhouette(scored)
        # Sizes from the cached scores (k rows); the training summary's own
        # clusterSizes would re-read the unpersisted input once more.
        sizes = [0] * len(model.clusterCenters())
        for r in cluster.cluster_sizes(scored).collect():
            sizes[r["prediction"]] = r["size"]
    finally:
        scored.unpersist()
    keep = keep if keep is not None else mart.columns
    predictions = model.transform(cluster.assemble(mart, features)).select(*keep, "prediction")
    return ClusterResult(predictions, model, score, sizes)


def write_back(wide: DataFrame, predictions: DataFrame, key: str,
               on_duplicate: str = "error") -> DataFrame:
    """J-C: drop the stale ``prediction`` from the wide table and left-join the new one."""
    return enrich.enrich_left_join(wide, predictions, key, ["prediction"], on_duplicate=on_duplicate)


@dataclass
class LaidOutWide:
    """A wide table laid out once for repeated write-backs, and what a mart's layout needs of it."""
    table: str
    base: str
    key: str
    buckets: int
    hot: DataFrame


def lay_out_wide(wide: DataFrame, table: str, base: str, key: str, buckets: int) -> LaidOutWide:
    """Write ``wide`` as the bucketed and sorted table ``table`` under ``base``."""
    return LaidOutWide(table, base, key, buckets, colocated.lay_out_left(wide, table, f"{base}/{table}", key, buckets))


def write_back_laid_out(laid: LaidOutWide, predictions: DataFrame, on_duplicate: str = "error") -> DataFrame:
    """J-C for a wide table that predictions come back to again and again: the mart's
    (key, prediction) is laid out like it, and the join has no exchange on either side."""
    spark = predictions.sparkSession
    mart = f"{laid.table}_{uuid.uuid4().hex[:8]}"
    colocated.lay_out_right(predictions.select(laid.key, "prediction"), mart, f"{laid.base}/{mart}", laid.key, laid.buckets, laid.hot)
    return colocated.colocated_left_join(spark, laid.table, mart, laid.key, ["prediction"], on_duplicate)


@dataclass
class Exploration:
    """What J-D finds: the pruned rows, and the figures that led there."""
    pruned: DataFrame
    n_rows: int                       # of the table (A1)
    missing: dict[str, float | None]  # percent (A2), of the columns that their name did not drop
    figures: DataFrame                # A1, A2 and A4 of every column of the table, and whether it is kept
    dropped: list[str]                # useful columns that were absent or too sparse

    @functools.cached_property
    def n_pruned(self) -> int:
        """Number of the pruned rows (A1)."""
        return self.pruned.count()


def explore(df: DataFrame, useful: list[str], metadata: list[str] | None = None,
            name_tokens: list[str] | None = None, threshold: float = 50.0, strict: bool = True) -> Exploration:
    """J-D: count the rows (A1), describe every column (A4), drop metadata and name-token
    columns, profile the rest (A2), drop columns missing in more than ``threshold``
    percent of the rows, keep the useful ones that survive, drop incomplete rows and
    count again.

    The table is staged once; A1, A2 and A4 are one aggregate per 50 columns of that
    copy, and the pruned rows read their own columns of it. With ``strict`` a useful
    column that does not survive is an error.
    """
    staged = stage(df, "explore", maxRecordsPerFile=WIDE_ROWS)
    report = stage(profile.column_report(staged, digits=None), "explore-report")
    by_name = {r["column_name"]: r for r in report.select("column_name", "n_rows", "missing_pct").collect()}
    named = columns.drop_named(staged, metadata or [])
    if name_tokens:
        named = columns.drop_by_name_token(named, *name_tokens)
    missing = {c: by_name[c]["missing_pct"] for c in named.columns}
    kept = columns.drop_sparse_columns(named, missing, threshold)
    dropped = [c for c in useful if c not in kept.columns]
    if strict and dropped:
        raise ValueError(f"useful columns dropped or absent: {dropped}")
    keep = [c for c in useful if c in kept.columns]
    pruned = rows.drop_incomplete(kept.select(*keep))
    figures = report.withColumn("kept", F.col("column_name").isin(keep))
    n_rows = next((r["n_rows"] for r in by_name.values()), 0)
    return Exploration(pruned, n_rows, missing, figures, dropped)


def mart_end_to_end(wide: DataFrame, key: str, features: list[str], k: int = cluster.DEFAULT_K,
                    seed: int = cluster.DEFAULT_SEED, **clean_opts) -> tuple[DataFrame, ClusterResult]:
    """J-F: clean -> cluster -> left-join the prediction back onto the wide table.

    The mart is laid out once, sorted by its key; the fit, the scores and the prediction
    read that copy, and its key is proved unique there, so that nothing is cleaned twice
    and the join needs no count per key.
    """
    spark = wide.sparkSession
    path = tables.write_sorted(preprocess(wide, key, features, **clean_opts), shared_dir(spark, "mart"), key)
    tables.check_unique_sorted(spark, path, key)
    result = clusterize(spark.read.parquet(path), features, k=k, seed=seed, keep=[key])
    return write_back(wide, result.predictions, key, on_duplicate="keep"), result  # "keep" as the key is proved


#: The filters of J-F in their order, after each of which the box plots are drawn.
FILTERS = ("cast", "extra", "upper", "lower")


def _filtered(wide: DataFrame, key: str, features: list[str], extra_bounds: dict[str, float] | None,
              upper: float | None, lower: float | None) -> dict[str, DataFrame]:
    """The mart after the cast and after each of the three filters."""
    near = rows.bound_by(extra_bounds or {})            # on the cells as they are, before a cast rounds them
    needed = rows.drop_incomplete(wide.select(key, *features, F.coalesce(near, F.lit(False)).alias("__near")), [key, *features])
    out = {"cast": rows.clean_numbers(rows.cast_numeric(needed, features), features)}
    out["extra"] = out["cast"].where("__near")
    out["upper"] = out["extra"].where(rows.bound_condition(features, upper=upper)) if upper is not None else out["extra"]
    out["lower"] = out["upper"].where(rows.bound_condition(features, lower=lower)) if lower is not None else out["upper"]
    return {name: df.select(key, *features) for name, df in out.items()}


def box_plots(wide: DataFrame, key: str, features: list[str], extra_bounds: dict[str, float] | None = None,
              upper: float | None = 100.0, lower: float | None = 0.0) -> DataFrame:
    """A5 around each of the three filters of J-F: figures per feature, after the cast
    (``cast``), the bounds on other columns (``extra``), the upper and the lower bound."""
    spark = wide.sparkSession
    parts = [profile.boxplot_stats(spark, df, features).withColumn("stage", F.lit(name))
             for name, df in _filtered(wide, key, features, extra_bounds, upper, lower).items()]
    return functools.reduce(DataFrame.unionByName, parts)


@dataclass
class MartReport:
    """What the whole of J-F leaves."""
    enriched: DataFrame               # the republished wide table
    plots: DataFrame                  # box-plot figures around each filter
    clusters: ClusterResult
    model_path: str
    published: dict


def full_mart(wide: DataFrame, name: str, base: str, key: str, features: list[str], k: int = cluster.DEFAULT_K,
              seed: int = cluster.DEFAULT_SEED, extra_bounds: dict[str, float] | None = None,
              upper: float | None = 100.0, lower: float | None = 0.0, repeatable: int | None = None) -> MartReport:
    """J-F as one job: cast, box plots around each of the three filters, cluster, score,
    save the model (K7), join the prediction back and republish the wide table as ``name`` (K6).

    The cast rows are staged once for the plots, and the filtered mart once for the
    clustering, with its key proved unique on the way. ``repeatable`` partitions, dealt by
    the key, make the fit the same on any cluster.
    """
    spark = wide.sparkSession
    needed = [key, *features, *(extra_bounds or {})]
    staged = stage(wide.select(*dict.fromkeys(needed)), "mart-input")
    plots = stage(box_plots(staged, key, features, extra_bounds, upper, lower), "mart-plots")
    mart = _filtered(staged, key, features, extra_bounds, upper, lower)["lower"]
    path = tables.write_sorted(mart, f"{base}/mart-{uuid.uuid4().hex[:8]}", key)
    tables.check_unique_sorted(spark, path, key)
    result = clusterize(spark.read.parquet(path), features, k=k, seed=seed, keep=[key],
                        order_key=key if repeatable else None, num_partitions=repeatable)
    model_path = cluster.save_model(result.model, f"{base}/model-{uuid.uuid4().hex[:8]}")
    published = tables.publish(spark, write_back(wide, result.predictions, key, on_duplicate="keep"), name, f"{base}/{name}")
    unstage(staged)
    return MartReport(spark.table(name), plots, result, model_path, published)


def mart_invariants(enriched: DataFrame) -> DataFrame:
    """Figures that do not depend on k-means' arbitrary cluster numbering."""
    return enriched.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("prediction").alias("n_with_prediction"),
        F.countDistinct("prediction").alias("n_clusters"),
    )


@dataclass
class MartConfig:
    """Names and parameters of the three-stage chain (entrypoint of the job)."""
    wide_table: str
    mart_table: str
    base_dir: str
    key: str = MART_KEY
    features: list[str] = field(default_factory=lambda: list(MART_FEATURES))
    k: int = cluster.DEFAULT_K
    seed: int = cluster.DEFAULT_SEED
    apply_range: bool = True
    repeatable: bool = False          # fit on a key-hashed, key-sorted layout
    extra_bounds: dict[str, float] | None = None    # F4: upper bounds on columns outside the mart
    model_path: str | None = None     # where to save the fitted model (K7)
    sources: dict[str, tuple[str, dict]] = field(default_factory=dict)  # table -> (format, options) to read it from
    sinks: dict[str, tuple[str, dict]] = field(default_factory=dict)    # table -> (format, options) to deliver it to


STAGES = ("preprocess", "clusterize", "write")


def _table_base(cfg: MartConfig, name: str) -> str:
    return f"{cfg.base_dir}/{name}"


def _version(spark: SparkSession, cfg: MartConfig, name: str) -> int | None:
    """The version of a table published by the chain, as it was before the chain's own
    write-back: a wide table with new predictions is still the same input. None for a
    table that has no versions."""
    if name in cfg.sources:
        return None
    found = {e["version"]: e for e in tables.versions(spark, _table_base(cfg, name))}
    version = max(found, default=None)
    while version in found and (note := found[version].get("note") or {}).get("stage") == "write":
        version = note["inputs"].get(name)
    return version


def _stage_input(spark: SparkSession, cfg: MartConfig, name: str, stage_name: str, version: int | None) -> DataFrame:
    if name in cfg.sources:
        fmt, options = cfg.sources[name]
        return spark.read.format(fmt).options(**options).load()
    if version is not None and any(e["version"] == version for e in tables.versions(spark, _table_base(cfg, name))):
        return tables.read_version(spark, _table_base(cfg, name), version)
    if not spark.catalog.tableExists(name):
        raise ValueError(f"stage {stage_name!r} needs table {name!r}, which does not exist")
    return spark.table(name)


def _stage_output(spark: SparkSession, cfg: MartConfig, df: DataFrame, name: str, note: dict, sort_by: str | None = None) -> dict:
    """Publish ``df`` as the table ``name`` and, where it has a sink, deliver that version.

    The sink is overwritten from the published copy, never from what the stage reads,
    so it may be the very table that the stage was read from.
    """
    out = tables.publish(spark, df, name, _table_base(cfg, name), note=note, sort_by=sort_by)
    if name in cfg.sinks:
        fmt, options = cfg.sinks[name]
        spark.read.parquet(out["path"]).write.format(fmt).options(**options).mode("overwrite").save()
        out["sink"] = fmt
    return out


def _commit_path(cfg: MartConfig, stage_name: str, inputs: dict) -> str:
    """Where the commit record of a stage with these parameters and input versions is."""
    made_of = {"inputs": inputs, "key": cfg.key, "features": cfg.features, "k": cfg.k, "seed": cfg.seed, "apply_range": cfg.apply_range,
               "repeatable": cfg.repeatable, "extra_bounds": cfg.extra_bounds, "sinks": cfg.sinks, "model": cfg.model_path}
    return f"{cfg.base_dir}/_stages/{stage_name}-{hashlib.sha256(json.dumps(made_of, sort_keys=True).encode()).hexdigest()[:24]}.json"


def _committed(spark: SparkSession, cfg: MartConfig, path: str, inputs: dict) -> dict | None:
    """The report of a stage that these inputs went through before and whose output still is there."""
    if None in inputs.values():
        return None                   # an input without versions may have changed
    text = tables.read_text(spark, path)
    report = json.loads(text) if text else None
    if report and any(e["version"] == report["version"] for e in tables.versions(spark, _table_base(cfg, report["table"]))):
        return report | {"resumed": True}
    return None


def _preprocess_stage(spark: SparkSession, cfg: MartConfig, at: dict, note: dict) -> dict:
    wide = _stage_input(spark, cfg, cfg.wide_table, "preprocess", at[cfg.wide_table])
    mart = preprocess(wide, cfg.key, cfg.features, apply_range=cfg.apply_range, extra_bounds=cfg.extra_bounds)
    return _stage_output(spark, cfg, mart, cfg.mart_table, note)


def _clusterize_stage(spark: SparkSession, cfg: MartConfig, at: dict, note: dict) -> dict:
    mart = _stage_input(spark, cfg, cfg.mart_table, "clusterize", at[cfg.mart_table])
    res = clusterize(mart, cfg.features, k=cfg.k, seed=cfg.seed, keep=[c for c in mart.columns if c != "prediction"],
                     order_key=cfg.key if cfg.repeatable else None)
    # Sorted by the key, so that the write-back can prove it unique where it lies.
    out = _stage_output(spark, cfg, res.predictions, cfg.mart_table, note | {"sorted_by": cfg.key}, sort_by=cfg.key)
    out.update(silhouette=res.silhouette, cluster_sizes=res.sizes)
    if cfg.model_path:
        out["model"] = cluster.save_model(res.model, cfg.model_path)
    return out


def _write_stage(spark: SparkSession, cfg: MartConfig, at: dict, note: dict) -> dict:
    mart = _stage_input(spark, cfg, cfg.mart_table, "write", at[cfg.mart_table])
    if "prediction" not in mart.columns:
        raise ValueError("stage 'write' needs a clustered mart (run 'clusterize' first)")
    wide = _stage_input(spark, cfg, cfg.wide_table, "write", at[cfg.wide_table])
    laid = [e["path"] for e in tables.versions(spark, _table_base(cfg, cfg.mart_table))
            if e["version"] == at[cfg.mart_table] and (e["note"] or {}).get("sorted_by") == cfg.key]
    if laid:
        tables.check_unique_sorted(spark, laid[0], cfg.key)
    enriched = write_back(wide, mart.select(cfg.key, "prediction"), cfg.key, on_duplicate="keep" if laid else "error")
    return _stage_output(spark, cfg, enriched, cfg.wide_table, note)


def run_stages(spark: SparkSession, stage_names, cfg: MartConfig, resume: bool = False) -> dict:
    """J-G: run the named stages (case-insensitive) in chain order; the first
    failing stage stops the chain. Stages hand over state only through tables,
    each published as a new version (never written over its own input). A table
    with an entry in ``cfg.sources`` is read from that format with its options
    instead of the catalog, and one in ``cfg.sinks`` is also written there.

    Every stage that ends leaves a commit record of its parameters, the versions of its
    inputs and its output. With ``resume`` a stage whose record fits and whose output is
    still there is not run again, so a chain that failed goes on at the first stage
    without a commit, on the versions that the earlier ones read and wrote. Inputs
    without versions (other formats, tables not published here) are always read anew.
    """
    wanted = {s.lower() for s in stage_names}
    unknown = wanted - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    run = {"preprocess": _preprocess_stage, "clusterize": _clusterize_stage, "write": _write_stage}
    reads = {"preprocess": [cfg.wide_table], "clusterize": [cfg.mart_table], "write": [cfg.mart_table, cfg.wide_table]}
    at = {name: _version(spark, cfg, name) for name in (cfg.wide_table, cfg.mart_table)}
    report: dict = {}
    for stage_name in STAGES:
        if stage_name not in wanted:
            continue
        inputs = {name: at[name] for name in reads[stage_name]}
        commit = _commit_path(cfg, stage_name, inputs)
        done = _committed(spark, cfg, commit, inputs) if resume else None
        if done is None:
            done = run[stage_name](spark, cfg, at, {"stage": stage_name, "inputs": inputs})
            delete_path(spark, commit)      # of an earlier run with the same inputs
            tables.create_text(spark, commit, json.dumps(done))
        report[stage_name] = done
        if stage_name != "write" and cfg.mart_table not in cfg.sources:
            at[cfg.mart_table] = done["version"]
    return report
