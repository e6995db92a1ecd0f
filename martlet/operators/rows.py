"""Row cleaning: completeness, tolerant casts, range bounds, stop lists, caps
(F1-F6, P6, E9, E10).

Order of the cleaning chain (decisions T1, T2, T3 of the blueprint):
non-null strings -> try_cast -> non-null / non-NaN numbers -> range bounds.
Explicit ``isNotNull`` conjuncts are emitted next to ``dropna`` because
``AtLeastNNonNulls`` is not translated into a Parquet pushed filter, while
``IsNotNull`` is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.expressions import all_of, to_number
from martlet.operators.index import any_rows, first_rows


def drop_incomplete(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """drop rows with any NULL (and NaN, for float/double columns) in ``cols``."""
    cols = list(cols or df.columns)
    pushed = df.where(all_of(F.col(c).isNotNull() for c in cols))
    return pushed.dropna(how="any", subset=cols)


def cast_numeric(df: DataFrame, cols: list[str], dtype: str = "float") -> DataFrame:
    """One projection casting ``cols`` with ``try_cast`` (bad text -> NULL).

    A single ``select`` instead of a loop of ``withColumn`` keeps the plan flat.
    """
    wanted = set(cols)
    return df.select(*[to_number(c, dtype).alias(c) if c in wanted else F.col(c) for c in df.columns])


def bound_condition(cols: list[str], upper: float | None = None, lower: float | None = None,
                    upper_inclusive: bool = False) -> Column:
    """AND of per-column bounds: ``col < upper`` and ``col >= lower``."""
    parts = []
    for c in cols:
        if upper is not None:
            parts.append(F.col(c) <= upper if upper_inclusive else F.col(c) < upper)
        if lower is not None:
            parts.append(F.col(c) >= lower)
    return all_of(parts)


def range_filter(df: DataFrame, cols: list[str], upper: float | None = 100.0,
                 lower: float | None = 0.0) -> DataFrame:
    """keep rows with every column in ``[lower, upper)``.

    NULL and NaN fail every comparison here (NaN sorts above all numbers in
    Spark, so ``NaN < upper`` is false), so they are dropped as well.
    """
    return df.where(bound_condition(cols, upper=upper, lower=lower))


def bound_by(bounds: dict[str, float], dtype: str = "double") -> Column:
    """every column below its bound, as numbers; NULL and other text fail."""
    return all_of(to_number(c, dtype) < v for c, v in bounds.items())


def hidden_column_filter(df: DataFrame, bounds: dict[str, float], keep: list[str],
                         dtype: str = "double") -> DataFrame:
    """bound columns that are *not* in the output projection.

    The bound is evaluated on ``try_cast(col AS double)`` before the projection
    (rather than relying on the analyser to resolve a pruned column); NULL drops
    the row.
    """
    return df.where(bound_by(bounds, dtype)).select(*keep)


def stop_list_filter(df: DataFrame, col: str, values) -> DataFrame:
    """``col NOT IN values`` (a NULL in ``col`` drops the row).

    A Python list is a bounded constant, compiled into the filter (``InSet``).
    A DataFrame of values (a list too large to inline) becomes a ``left_anti``
    join; AQE broadcasts it only when its runtime size is under the threshold.
    NULLs are removed first on both sides, so the result equals ``NOT IN``.
    """
    if isinstance(values, DataFrame):
        stop = values.select(F.col(values.columns[0]).alias(col)).where(F.col(col).isNotNull()).distinct()
        return df.where(F.col(col).isNotNull()).join(stop, col, "left_anti").select(*df.columns)
    return df.where(~F.col(col).isin(list(values)))


def limit_rows(df: DataFrame, n: int, order_by: list[str] | None = None) -> DataFrame:
    """the first ``n`` rows in the order of ``order_by`` (names; ``-name`` descends), ties
    by a hash of the row, so the cap is reproducible. Without an order it is any ``n``
    rows, those of the first partitions.

    ``n`` may be any part of the table: the key of the n-th row is found from the order
    columns alone, and rows are filtered by it where they lie. No task collects the
    ``n`` rows.
    """
    return first_rows(df, n, order_by) if order_by else any_rows(df, n)


def clean_numbers(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep rows in which no number of ``cols`` is NULL or NaN."""
    return df.where(all_of(F.col(c).isNotNull() & ~F.isnan(F.col(c)) for c in cols))


def clean_numeric(df: DataFrame, features: list[str], keys: list[str] | None = None,
                  dtype: str = "float", upper: float | None = 100.0, lower: float | None = 0.0,
                  apply_range: bool = True, drop_after_cast: bool = True,
                  extra_bounds: dict[str, float] | None = None) -> DataFrame:
    """J-A core: project keys + features, drop incomplete, cast, drop again, bound.

    ``apply_range=False`` reproduces the shipped job, whose range filters were
    built and discarded; ``drop_after_cast=False`` reproduces its drop-then-cast
    order (unparsable text then survives as NULL). ``extra_bounds`` applies F4
    bounds on columns outside the projection, before projecting.
    """
    keys = list(keys or [])
    if extra_bounds:
        df = df.where(bound_by(extra_bounds))
    out = drop_incomplete(df.select(*keys, *features))
    out = cast_numeric(out, features, dtype)
    if drop_after_cast:
        out = clean_numbers(out, features)
    if apply_range:
        out = range_filter(out, features, upper=upper, lower=lower)
    return out
