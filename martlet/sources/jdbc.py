"""JDBC sources and sinks.

Credentials travel only in the options map and are never logged. The
partitioned read splits a numeric, indexed key into ``num_partitions`` ranges
whose stride comes from the key's real min/max (bounds do not filter; they only
set the stride), and uses ``dbtable`` because Spark cannot combine ``query``
with ``partitionColumn``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, **extra) -> dict[str, str]:
    opts = {"url": url}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_table(spark: SparkSession, options: dict[str, str], table: str | None = None,
               query: str | None = None) -> DataFrame:
    """Whole-table read through ``dbtable`` or a pass-through ``query``."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    opts = dict(options)
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query
    return spark.read.format("jdbc").options(**opts).load()


def validate_partitions(num_partitions: int, hi: int | None = None) -> int:
    """A number of partitions of at least one, and of at most ``hi`` where a caller sets a limit."""
    n = int(num_partitions)
    if n < 1 or (hi is not None and n > hi):
        raise ValueError("num_partitions must be at least 1" + (f" and at most {hi}" if hi is not None else ""))
    return n


def partition_bounds(spark: SparkSession, options: dict[str, str], table: str, column: str) -> tuple:
    """min/max of the partition key, computed by the database (one tiny row)."""
    q = f"select min({column}) as lo, max({column}) as hi from {table}"
    row = read_table(spark, options, query=q).first()
    return row[0], row[1]


def read_partitioned(spark: SparkSession, options: dict[str, str], table: str, column: str,
                     num_partitions: int, bounds: tuple | None = None,
                     fetch_size: int | None = None) -> DataFrame:
    """Parallel read in ``num_partitions`` key ranges."""
    n = validate_partitions(num_partitions)
    lo, hi = bounds if bounds is not None else partition_bounds(spark, options, table, column)
    opts = dict(options, dbtable=table, partitionColumn=column, lowerBound=str(lo),
                upperBound=str(hi), numPartitions=str(n))
    if fetch_size:
        opts["fetchsize"] = str(fetch_size)
    return spark.read.format("jdbc").options(**opts).load()


def write_table(df: DataFrame, options: dict[str, str], table: str, mode: str = "append",
                create_table_options: str | None = None, truncate: bool = False,
                num_partitions: int | None = None) -> None:
    """K1 (append, table created when absent) / K2 (overwrite; ``truncate``
    keeps the table definition). ``num_partitions`` bounds concurrent
    connections by coalescing first."""
    if mode not in ("append", "overwrite"):
        raise ValueError("mode must be append or overwrite")
    opts = dict(options, dbtable=table)
    if create_table_options:
        opts["createTableOptions"] = create_table_options
    if truncate:
        opts["truncate"] = "true"
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    df.write.format("jdbc").mode(mode).options(**opts).save()

