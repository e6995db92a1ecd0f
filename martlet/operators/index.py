"""Deterministic row index over a key ordering (S3) and row cap (F6) without a global window.

``row_number() OVER (ORDER BY key)`` with no partition moves every row into one
task. Here Spark's own range partitioner lays the rows out by (key, tie-break
columns, row hash) and each partition sorts itself, so partitions are contiguous
in that order whatever the key's type, and a hot key value or the NULL keys are
cut between partitions by the hash. The layout is written once to the shared
folder together with each row's partition and place
(``monotonically_increasing_id``); rows per partition (one row per partition)
give the offsets, and the index is offset plus place.

The order is total and deterministic: key (NULLs first, Spark's default), then
``tiebreak`` columns, then a hash of the whole row (rows equal in every column
are interchangeable). Where the partitioner cuts depends on its sample, the
index does not. What is written stays, so a lost executor renumbers nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.functions.expressions import all_of, any_of
from martlet.session import stage, unstage

_HASH = "__martlet_row_hash"
_TIE = "__martlet_tie"
_PLACE = "__martlet_place"
_PART = "__martlet_part"
_COUNT = "__martlet_count"
# monotonically_increasing_id: the partition above 33 bits of place.
_PLACE_BITS = 33


def ranged(df: DataFrame, order: list[Column], parts: int | None, name: str) -> DataFrame:
    """``df`` laid out once in ``parts`` range partitions of a total order (``order``, then
    a hash of the whole row), each sorted, with every row's partition and place in
    ``__martlet_place``."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    by = [*order, F.col(_HASH)]
    laid = (df.withColumn(_HASH, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
            .repartitionByRange(n, *by).sortWithinPartitions(*by).drop(_HASH))
    return stage(laid.withColumn(_PLACE, F.monotonically_increasing_id()), name)


def _sizes(laid: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows of each partition (or the sum of ``weight``) and of all before it; one row per partition."""
    rows = F.sum(weight) if weight else F.count(F.lit(1))
    sizes = laid.groupBy(F.shiftrightunsigned(_PLACE, _PLACE_BITS).alias(_PART)).agg(rows.alias("n"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(_PART, "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def _in_partition(part: int) -> Column:
    return F.col(_PLACE).between(part << _PLACE_BITS, ((part + 1) << _PLACE_BITS) - 1)


def any_rows(df: DataFrame, n: int) -> DataFrame:
    """``n`` rows of ``df``, those of its first partitions: staged with their places, cut by one comparison of places."""
    laid = stage(df.withColumn(_PLACE, F.monotonically_increasing_id()), "any_rows")
    cut = _sizes(laid).where((F.col("before") < n) & (F.col("before") + F.col("n") >= n)).first()
    if n <= 0:
        laid = laid.where(F.lit(False))
    elif cut is not None:
        laid = laid.where(F.col(_PLACE) < (cut[_PART] << _PLACE_BITS) + n - cut["before"])
    return laid.drop(_PLACE)


def _carried(name: str, kind: T.DataType) -> Column:
    """A value in a form that Python gives back unchanged, whatever the time zones."""
    c = F.col(f"`{name}`")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return c.cast("string")
    return c


def _literal(value, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType) and value is not None:
        return F.timestamp_micros(F.lit(value))
    return F.lit(value).cast(kind)


def _before(name: str, down: bool, value, kind: T.DataType) -> Column:
    """Rows whose ``name`` sorts before ``value``; NULLs come first, or last when ``down``."""
    c = F.col(f"`{name}`")
    if value is None:
        return c.isNotNull() if down else F.lit(False)
    return c > _literal(value, kind) if down else c.isNull() | (c < _literal(value, kind))


def _at(name: str, value, kind: T.DataType) -> Column:
    return F.col(f"`{name}`").isNull() if value is None else F.col(f"`{name}`") == _literal(value, kind)


def first_rows(df: DataFrame, n: int, order: list[str], parts: int | None = None) -> DataFrame:
    """The first ``n`` rows of ``df`` in ``order`` (names; ``-name`` descends), for any ``n``.

    Only the order columns are shuffled, and each of their values once, with its number
    of rows: they are laid out in range partitions, the partition's sums tell which holds
    the n-th row, and a running sum inside that one finds its key. The result is ``df``
    filtered by that key, which reaches the scan, so its rows are neither shuffled nor
    gathered. Of the rows that share the last key as many as still fit are taken, by a
    hash of the row. Two rows reach the driver. ``df`` must give the same rows twice.
    """
    names = [o.removeprefix("-") for o in order]
    downs = [o.startswith("-") for o in order]
    keys = df.groupBy(*[F.col(f"`{c}`") for c in names]).agg(F.count(F.lit(1)).alias(_COUNT))
    laid = ranged(keys, [F.desc(f"`{c}`") if d else F.asc(f"`{c}`") for c, d in zip(names, downs)], parts, "first_keys")
    part = _sizes(laid, _COUNT).where((F.col("before") < n) & (F.col("before") + F.col("n") >= n)).first()
    if n <= 0 or part is None:
        unstage(laid)
        return df.where(F.lit(n > 0))
    running = F.sum(_COUNT).over(Window.orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, 0))   # over one range partition
    kinds = [df.schema[c].dataType for c in names]
    found = (laid.where(_in_partition(part[_PART])).withColumn("upto", running + part["before"])
             .where(F.col("upto") >= n).orderBy(_PLACE).limit(1)
             .select("upto", _COUNT, *[_carried(c, kind).alias(f"v{i}") for i, (c, kind) in enumerate(zip(names, kinds))]).first())
    unstage(laid)
    cut = [(c, found[f"v{i}"], kind) for i, (c, kind) in enumerate(zip(names, kinds))]
    earlier = any_of(all_of([*[_at(*x) for x in cut[:i]], _before(c, downs[i], value, kind)]) for i, (c, value, kind) in enumerate(cut))
    last = all_of(_at(*x) for x in cut)
    c, value, kind = cut[0]
    reaches = _before(c, downs[0], value, kind) | _at(c, value, kind)              # what the scan can use
    room = n - (found["upto"] - found[_COUNT])
    if room == found[_COUNT]:
        return df.where(reaches).where(F.coalesce(earlier, F.lit(False)) | F.coalesce(last, F.lit(False)))
    tied = df.where(last)
    if names == [_TIE]:                                                            # equal rows: any of them
        kept = any_rows(tied, room)
    else:
        hashed = tied.withColumn(_TIE, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
        kept = first_rows(hashed, room, [_TIE], parts).drop(_TIE)
    return df.where(reaches).where(earlier).unionByName(kept)


def with_row_index(df: DataFrame, order_col: str, index_col: str = "row_index",
                   buckets: int | None = None, tiebreak: list[str] | None = None,
                   start: int = 0) -> DataFrame:
    """``df`` with a gapless ``index_col`` from ``start`` in the order of ``order_col``.

    ``buckets`` is the number of range partitions (default
    ``spark.sql.shuffle.partitions``). An array, map or variant column must be
    hashable by ``xxhash64`` (maps are not).
    """
    laid = ranged(df, [F.col(order_col), *[F.col(c) for c in tiebreak or []]], buckets, "row_index")
    placed = laid.withColumn(_PART, F.shiftrightunsigned(_PLACE, _PLACE_BITS))
    # One row per range partition: the broadcast and the window are bounded by ``buckets``.
    offsets = _sizes(laid).select(_PART, F.col("before").alias("__martlet_offset"))
    place = F.col(_PLACE).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return placed.join(F.broadcast(offsets), _PART).select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("__martlet_offset") + place + start).cast("long").alias(index_col))
