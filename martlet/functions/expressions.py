"""Reusable column expressions (JVM side, codegen friendly)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Substrings that mark a cell as missing in the profile
# (case-sensitive, matched anywhere in the text).
MISSING_MARKERS = ("None", "NULL", "unknown")

FRACTIONAL_TYPES = (T.FloatType, T.DoubleType)


def all_of(conditions) -> Column:
    """AND-reduce a sequence of boolean columns (TRUE for an empty sequence)."""
    conditions = list(conditions)
    if not conditions:
        return F.lit(True)
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions) -> Column:
    conditions = list(conditions)
    if not conditions:
        return F.lit(False)
    return reduce(lambda a, b: a | b, conditions)


def to_number(column: str | Column, dtype: str = "float") -> Column:
    """Tolerant string -> number: unparsable text becomes NULL, never an error.

    Spark 4 runs with ANSI on, where a plain ``cast`` raises on ``'abc'``;
    ``try_cast`` keeps the non-ANSI NULL semantics the jobs rely on.
    """
    c = F.col(column) if isinstance(column, str) else column
    return c.try_cast(dtype)


def is_missing(df: DataFrame, name: str, markers=MISSING_MARKERS) -> Column:
    """Profile notion of "missing" for one column.

    NULL, or NaN for numbers; for text additionally ``''``, any marker substring,
    or text that parses to NaN.
    """
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.StringType):
        parts = [c.contains(m) for m in markers]
        # Only text that holds "nan" can parse to NaN; other cells are not parsed.
        parts += [c == F.lit(""), c.isNull(), F.when(c.ilike("%nan%"), F.isnan(c.try_cast("double"))).otherwise(False)]
        # NULL-safe: contains()/== on NULL give NULL; coalesce to FALSE.
        return F.coalesce(any_of(parts), F.lit(False))
    if isinstance(dtype, FRACTIONAL_TYPES):
        return c.isNull() | F.isnan(c)
    return c.isNull()
