"""Exact quantiles (``quantile_cont`` semantics) by radix selection.

Spark's exact ``percentile`` merges every distinct value of a column in one final
task. Here order statistics are selected digit by digit instead. Each value becomes
a 64-bit whole number whose order is the order of the values: sign, exponent and
mantissa of the double, taken apart by exact arithmetic. The numbers are staged
once; then four passes read 16 bits each, from the top. A pass counts the digits of
the values that share a wanted rank's digits so far, sums the counts in the order
of the digits, and keeps the digit in which the rank falls.

The passes are always the same four, whatever the number of rows, the values and
their ties. A pass holds at most 65,536 counts per column and rank (partial counts
before the shuffle, running sums in one window for each), and one row per column and
rank reaches the driver, so memory grows with neither rows nor values.

NULL and NaN are ignored; ``-0.0`` counts as ``0.0``.
"""

from __future__ import annotations

import math
import struct

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlet.functions.expressions import any_of
from martlet.session import stage, unstage

DIGIT_BITS = 16
_SHIFTS = (48, 32, 16, 0)
# Parts of a 64-bit IEEE double.
_MANTISSA_BITS, _BIAS, _LEAST_EXPONENT = 52, 1023, -1022
#: Columns whose digits are counted by one aggregate.
COLUMNS_AT_ONCE = 50


def order_keys(df: DataFrame, cols: list[str], names: list[str] | None = None) -> DataFrame:
    """Columns ``k0``, ``k1``, ... (or ``names``): the bits of each of ``cols`` as a double, in a
    long that orders like it (negative for negative values); NULL for NULL and NaN.

    The exponent comes from a logarithm, set right by comparing with the powers of two
    next to it; dividing by that power, and scaling what is left, are exact. Every step is
    a projection of its own, so that no logarithm or power is computed twice.
    """
    places = range(len(cols))
    x, a, e, p = (lambda i, c=c: F.col(f"__{c}{i}") for c in "xaep")
    at = df.select(*[F.col(f"`{c}`").cast("double").alias(f"__x{i}") for i, c in enumerate(cols)])
    at = at.select("*", *[F.abs(x(i)).alias(f"__a{i}") for i in places])
    at = at.select("*", *[F.least(F.floor(F.log2(a(i))).cast("double"), F.lit(float(_BIAS))).alias(f"__e{i}") for i in places])
    at = at.select("*", *[F.pow(F.lit(2.0), e(i)).alias(f"__p{i}") for i in places])

    def key(i: int) -> Column:
        below, above = p(i) > a(i), p(i) * 2 <= a(i)
        power = F.when(below, p(i) / 2).when(above, p(i) * 2).otherwise(p(i))
        exponent = e(i).cast("long") + F.when(below, -1).when(above, 1).otherwise(0)
        mantissa = ((a(i) / power - 1) * float(1 << _MANTISSA_BITS)).cast("long")
        normal = (exponent + _BIAS) * (1 << _MANTISSA_BITS) + mantissa
        # Values below the least normal power are whole multiples of 2**-1074; two factors, as one would overflow.
        tiny = (a(i) * 2.0 ** 537 * 2.0 ** 537).cast("long")
        bits = (F.when(a(i) == 0, F.lit(0).cast("long")).when(a(i) < 2.0 ** _LEAST_EXPONENT, tiny)
                .when(a(i) == float("inf"), F.lit(2047 << _MANTISSA_BITS)).otherwise(normal))
        return F.when(x(i).isNull() | F.isnan(x(i)), F.lit(None).cast("long")).otherwise(bits)

    at = at.select("*", *[key(i).alias(f"__b{i}") for i in places])
    return at.select(*[F.when(x(i) < 0, -F.col(f"__b{i}")).otherwise(F.col(f"__b{i}")).alias(names[i] if names else f"k{i}") for i in places])


def value_of(key: int) -> float:
    """The double of a key of ``order_keys``."""
    value = struct.unpack(">d", struct.pack(">Q", abs(key)))[0]
    return -value if key < 0 else value


def _digits(keys: DataFrame, columns: range, shift: int, wanted: dict[tuple[int, int], list[int]] | None) -> DataFrame:
    """(col, prefix, digit, n): how often each digit follows a wanted prefix."""
    names = [f"k{i}" for i in columns]
    long = keys.select(*names).unpivot([], names, "name", "key").where("key is not null")
    if wanted is None:
        prefix, digit = F.lit(0).cast("long"), F.shiftright("key", shift)
    else:
        prefix, digit = F.shiftright("key", shift + DIGIT_BITS), F.shiftright("key", shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
        of_column = {i: sorted({p for c, p in wanted if c == i}) for i in columns}
        long = long.where(any_of((F.col("name") == f"k{i}") & prefix.isin(there) for i, there in of_column.items() if there))
    return (long.groupBy("name", prefix.alias("prefix"), digit.alias("digit")).agg(F.count(F.lit(1)).alias("n"))
            .select(F.substring("name", 2, 9).cast("int").alias("col"), "prefix", "digit", "n"))


def exact_order_statistics(spark: SparkSession, df: DataFrame, cols: list[str],
                           probs: list[float]) -> dict[tuple[str, float], float | None]:
    """Return ``{(column, p): quantile_cont(column, p)}``; None where a column has no value."""
    out: dict[tuple[str, float], float | None] = {}
    keys = stage(order_keys(df, cols), "quantile-keys")
    try:
        for at in range(0, len(cols), COLUMNS_AT_ONCE):
            _select(keys, range(at, min(at + COLUMNS_AT_ONCE, len(cols))), cols, probs, out)
    finally:
        unstage(keys)
    return out


def _select(keys: DataFrame, columns: range, cols: list[str], probs: list[float], out: dict) -> None:
    # Top digits: running counts give each column's size and so the wanted ranks.
    in_order = Window.partitionBy("col", "prefix").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    running = _digits(keys, columns, _SHIFTS[0], None).withColumn("before", F.coalesce(F.sum("n").over(in_order), F.lit(0)))
    sized = running.withColumn("total", F.sum("n").over(Window.partitionBy("col")))
    place = [(F.col("total") - 1) * F.lit(float(p)) for p in probs]
    ranks = F.array_distinct(F.array(*[f(x).cast("long") for x in place for f in (F.floor, F.ceil)]))
    hits = (sized.withColumn("rank", F.explode(ranks)).where("rank >= before and rank < before + n")
            .select("col", "digit", "rank", "before", "total").collect())
    totals = {r["col"]: r["total"] for r in hits}
    at = {(r["col"], r["rank"]): (r["digit"], r["rank"] - r["before"]) for r in hits}     # digits so far, rank among them
    for shift in _SHIFTS[1:]:
        if not at:
            break
        wanted: dict[tuple[int, int], list[int]] = {}
        for (c, _), (prefix, rest) in at.items():
            wanted.setdefault((c, prefix), []).append(rest)
        asked = F.broadcast(keys.sparkSession.createDataFrame(          # one row per column and rank
            [(c, prefix, rest) for (c, prefix), rests in wanted.items() for rest in sorted(set(rests))], "col int, prefix long, rest long"))
        running = _digits(keys, columns, shift, wanted).withColumn("before", F.coalesce(F.sum("n").over(in_order), F.lit(0)))
        found = {(r["col"], r["prefix"], r["rest"]): (r["digit"], r["before"]) for r in
                 running.join(asked, ["col", "prefix"]).where("rest >= before and rest < before + n").collect()}
        for key, (prefix, rest) in at.items():
            digit, before = found[key[0], prefix, rest]
            at[key] = ((prefix << DIGIT_BITS) | digit, rest - before)
    for i in columns:
        for p in probs:
            if i not in totals:
                out[cols[i], p] = None
                continue
            h = (totals[i] - 1) * p
            low, high = (value_of(at[i, f(h)][0]) for f in (math.floor, math.ceil))
            out[cols[i], p] = low if low == high else low + (high - low) * (h - math.floor(h))
