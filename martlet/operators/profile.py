"""Counting and profiling (A1, A2, A4, A5).

Every profile is one scan with all aggregates side by side, the missing profile
one per 7 columns (partial aggregation per task, a single tiny final row), reshaped to one row per column by a
``stack`` generator. Nothing is converted to pandas.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martlet.functions.expressions import is_missing
from martlet.functions.quantiles import exact_order_statistics


def row_count(df: DataFrame) -> DataFrame:
    """A1 as a DataFrame: one row ``n_rows``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def observe_count(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """A1 inside a job: attach a row counter that fills during the next action
    (e.g. the write), replacing a separate ``count()`` pass."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("n_rows")), obs


def _stack_long(wide: DataFrame, names: list[str], metrics: list[str], label: str = "column_name") -> DataFrame:
    """Reshape a one-row frame with columns ``m{i}_{metric}`` into one row per name."""
    parts = []
    for i, name in enumerate(names):
        quoted = name.replace("'", "\\'")
        parts.append(f"'{quoted}'")
        parts += [f"`m{i}_{m}`" for m in metrics]
    expr = f"stack({len(names)}, {', '.join(parts)}) as ({label}, {', '.join(metrics)})"
    return wide.selectExpr(expr)


#: Columns profiled by one aggregate; more would outgrow the code that Spark generates for it.
COLUMNS_AT_ONCE = 50
#: The same for ``missing_profile``: with the expressions that make the columns, the generated
#: methods stay under the 8000 bytes above which the JVM interprets a method and never compiles it.
MISSING_AT_ONCE = 7


def missing_profile(df: DataFrame, cols: list[str] | None = None, digits: int | None = 6,
                    at_once: int = MISSING_AT_ONCE) -> DataFrame:
    """A2: percentage of "missing" cells per column.

    missing = NULL, NaN, ``''`` or text containing ``None``/``NULL``/``unknown``.
    The denominator is the row count of ``df`` (taken before any column drop).
    Columns go through aggregates of ``at_once``, each of which reads its columns
    only, so the time grows with the width and no faster.
    """
    cols = list(cols or df.columns)
    parts = [_missing_profile(df, cols[k:k + at_once], digits) for k in range(0, len(cols), at_once)]
    return functools.reduce(DataFrame.unionAll, parts)


def _missing_pct(df: DataFrame, c: str) -> Column:
    n_missing = F.count(F.when(is_missing(df, c), F.lit(1)))
    return F.try_divide(n_missing.cast("double"), F.count(F.lit(1))) * 100   # NULL when empty


def _missing_profile(df: DataFrame, cols: list[str], digits: int | None) -> DataFrame:
    aggs = []
    for i, c in enumerate(cols):
        pct = _missing_pct(df, c)
        if digits is not None:
            pct = F.round(pct, digits)
        aggs.append(pct.alias(f"m{i}_missing_pct"))
    return _stack_long(df.agg(*aggs), cols, ["missing_pct"])


def missing_percentages(df: DataFrame, cols: list[str] | None = None) -> dict[str, float]:
    """A2 on the driver: ``{column: pct}`` (one bounded row)."""
    return {r["column_name"]: r["missing_pct"] for r in missing_profile(df, cols, digits=None).collect()}


def describe_numeric(df: DataFrame, cols: list[str], digits: int | None = 6) -> DataFrame:
    """A4 with real types: count, mean, sample stddev, min, max per column."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        stats = {
            "count": F.count(x),
            "mean": F.avg(x),
            "stddev": F.stddev_samp(x),
            "min": F.min(x),
            "max": F.max(x),
        }
        for k, e in stats.items():
            if digits is not None and k != "count":
                e = F.round(e, digits)
            aggs.append(e.alias(f"m{i}_{k}"))
    return _stack_long(df.agg(*aggs), cols, ["count", "mean", "stddev", "min", "max"])


def _description(c: str) -> dict[str, Column]:
    x = F.col(c).try_cast("double")
    return {"count": F.count(F.col(c)), "mean": F.avg(x), "stddev": F.stddev_samp(x),
            "min": F.min(F.col(c)).cast("string"), "max": F.max(F.col(c)).cast("string")}


def describe_all(df: DataFrame, cols: list[str] | None = None, digits: int | None = 6) -> DataFrame:
    """A4 over any columns, like ``df.describe()`` but in one typed pass.

    count of non-NULL values; mean and sample stddev of the values that parse as
    numbers (``try_cast``, so text columns never raise under ANSI); min and max
    in the column's own order, rendered as text so all columns share a schema.
    """
    cols = list(cols or df.columns)
    aggs = []
    for i, c in enumerate(cols):
        for k, e in _description(c).items():
            if digits is not None and k in ("mean", "stddev"):
                e = F.round(e, digits)
            aggs.append(e.alias(f"m{i}_{k}"))
    return _stack_long(df.agg(*aggs), cols, ["count", "mean", "stddev", "min", "max"])


def column_report(df: DataFrame, cols: list[str] | None = None, digits: int | None = 6, at_once: int = COLUMNS_AT_ONCE) -> DataFrame:
    """A1, A2 and A4 fused: per column n_rows, missing_pct, count, mean, stddev, min and max.

    One aggregate, and so one read of the columns, per ``at_once`` columns.
    """
    cols = list(cols or df.columns)
    parts = []
    for k in range(0, len(cols), at_once):
        some, aggs = cols[k:k + at_once], []
        for i, c in enumerate(some):
            stats = {"n_rows": F.count(F.lit(1)), "missing_pct": _missing_pct(df, c), **_description(c)}
            aggs += [(F.round(e, digits) if digits is not None and m in ("missing_pct", "mean", "stddev") else e).alias(f"m{i}_{m}")
                     for m, e in stats.items()]
        parts.append(_stack_long(df.agg(*aggs), some, ["n_rows", "missing_pct", "count", "mean", "stddev", "min", "max"]))
    return functools.reduce(DataFrame.unionAll, parts)


def boxplot_stats(spark: SparkSession, df: DataFrame, cols: list[str], whisker: float = 1.5,
                  digits: int | None = 6, method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """A5: the figures behind a box plot, per column.

    q1/median/q3 (``quantile_cont``), iqr, the whisker ends (most extreme values
    inside ``[q1 - w*iqr, q3 + w*iqr]``) and the number of outliers outside.
    ``method="exact"`` uses the distributed selection; ``"approx"`` uses
    ``percentile_approx`` (one pass, rank error 1/accuracy).
    """
    probs = [0.25, 0.5, 0.75]
    if method == "exact":
        q = exact_order_statistics(spark, df, cols, probs)
    else:
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(c)
                       for c in cols]).first()
        q = {(c, p): (row[c][i] if row[c] else None) for c in cols for i, p in enumerate(probs)}

    aggs = []
    for i, c in enumerate(cols):
        q1, med, q3 = q[(c, 0.25)], q[(c, 0.5)], q[(c, 0.75)]
        x = F.col(c).cast("double")
        if q1 is None:
            lo_f = hi_f = None
            figures = {k: F.lit(None).cast("double") for k in ("q1", "median", "q3", "iqr")}
            figures.update(whisker_low=F.lit(None).cast("double"), whisker_high=F.lit(None).cast("double"),
                           n_outliers=F.lit(0).cast("long"))
        else:
            iqr = q3 - q1
            lo_f, hi_f = q1 - whisker * iqr, q3 + whisker * iqr
            figures = {
                "q1": F.lit(q1), "median": F.lit(med), "q3": F.lit(q3), "iqr": F.lit(iqr),
                "whisker_low": F.min(F.when(x >= lo_f, x)),
                "whisker_high": F.max(F.when(x <= hi_f, x)),
                "n_outliers": F.count_if((x < lo_f) | (x > hi_f)),
            }
        for k, e in figures.items():
            if digits is not None and k != "n_outliers":
                e = F.round(e.cast("double"), digits)
            aggs.append(e.alias(f"m{i}_{k}"))
    metrics = ["q1", "median", "q3", "iqr", "whisker_low", "whisker_high", "n_outliers"]
    return _stack_long(df.agg(*aggs), cols, metrics)
