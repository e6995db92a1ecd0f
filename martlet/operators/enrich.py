"""Putting predictions back onto the wide table.

The right side must be unique on the key. That is checked once, before the join,
by a count per key over the key column alone, and the join itself is a plain
left join of two shuffled sides. So AQE can split a key value (or the NULL keys)
that holds a large part of the left rows; an aggregate between the shuffle and
the join would prevent that. When the right side is small AQE turns the join into
a broadcast join from runtime statistics
(``spark.sql.adaptive.autoBroadcastJoinThreshold`` is the size check).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_N = "__martlet_n"


def add_null_column(df: DataFrame, name: str, dtype: str = "int") -> DataFrame:
    """K5: add a nullable column of NULLs, only when it is missing (idempotent)."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(None).cast(dtype))


def check_unique(right: DataFrame, key: str) -> None:
    """Raise when a key value occurs twice. NULL keys never match, so they don't count.

    One job over the key column; nothing but its end reaches the driver.
    """
    counts = right.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(_N))
    guard = F.when(F.col(_N) > 1, F.raise_error(F.concat(
        F.lit(f"duplicate key in right side of enrichment join: {key}="), F.col(key).cast("string"))))
    counts.where(guard.isNotNull()).count()


def enrich_left_join(left: DataFrame, right: DataFrame, key: str, cols: list[str],
                     on_duplicate: str = "error") -> DataFrame:
    """``left.drop(cols) LEFT JOIN right(key, cols) USING (key)``.

    Key comes first in the output, unmatched rows get NULLs.
    ``on_duplicate="error"`` (default) raises on a duplicated right key, when
    called; ``"keep"`` multiplies left rows like a plain join.
    """
    if on_duplicate not in ("error", "keep"):
        raise ValueError("on_duplicate must be 'error' or 'keep'")
    base = left.drop(*cols)
    side = right.select(key, *cols)
    if on_duplicate == "error":
        check_unique(right.select(key), key)
    return base.join(side, key, "left")
