"""Projection and schema-driven column operators.

All of these decide *which* columns survive from the schema (driver-side
metadata) and then issue one ``select``; Catalyst prunes the scan to the
surviving columns, so nothing here reads data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPE_NAMES = {
    "string": T.StringType, "double": T.DoubleType, "float": T.FloatType,
    "int": T.IntegerType, "bigint": T.LongType, "long": T.LongType,
    "boolean": T.BooleanType, "timestamp": T.TimestampType,
    "timestamp_ntz": T.TimestampNTZType, "date": T.DateType,
}


def project(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep a fixed list of columns, in the given order."""
    return df.select(*cols)


def drop_named(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop listed columns; unknown names are ignored."""
    return df.drop(*cols)


def drop_by_name_token(df: DataFrame, *tokens: str) -> DataFrame:
    """Drop every column whose name contains any of ``tokens``."""
    doomed = [c for c in df.columns if any(t in c for t in tokens)]
    return df.drop(*doomed)


def columns_of_type(df: DataFrame, *type_names: str) -> list[str]:
    """Names of columns whose type is one of ``type_names`` (e.g. 'string', 'double')."""
    wanted = tuple(_TYPE_NAMES[t] for t in type_names)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]


def select_by_type(df: DataFrame, *type_names: str) -> DataFrame:
    """Keep only the columns of the given types."""
    return df.select(*columns_of_type(df, *type_names))


def feature_columns(useful: list[str], metadata: list[str]) -> list[str]:
    """P5: features = useful columns minus metadata columns, order kept."""
    return [c for c in useful if c not in metadata]


def normalise_names(df: DataFrame, old: str = "-", new: str = "_") -> DataFrame:
    """Rename ``a-b`` to ``a_b``; raise when two names collide."""
    renamed = [c.replace(old, new) for c in df.columns]
    seen: dict[str, str] = {}
    for original, name in zip(df.columns, renamed):
        if name in seen:
            raise ValueError(f"normalised name {name!r} collides: {seen[name]!r} and {original!r}")
        seen[name] = original
    return df.toDF(*renamed)


def drop_sparse_columns(df: DataFrame, missing_pct: dict[str, float], threshold: float = 50.0) -> DataFrame:
    """Drop the columns whose missing percentage is strictly above ``threshold``."""
    return df.drop(*[c for c, pct in missing_pct.items() if pct is not None and pct > threshold])


def schema_report(spark: SparkSession, df: DataFrame, with_counts: bool = True) -> DataFrame:
    """P9 as data: one row per column (position, name, type, nullable), plus the
    number of non-NULL values when ``with_counts`` (one aggregate pass, so the
    declared nullability can be checked against the data)."""
    fields = df.schema.fields
    if not with_counts:
        rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(fields)]
        return spark.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")
    counts = df.agg(*[F.count(F.col(f.name)).alias(f"c{i}") for i, f in enumerate(fields)])
    parts = []
    for i, f in enumerate(fields):
        name = f.name.replace("\\", "\\\\").replace("'", "\\'")
        parts += [f"{i + 1}", f"'{name}'", f"'{f.dataType.simpleString()}'", "true" if f.nullable else "false",
                  f"c{i}"]
    return counts.selectExpr(
        f"stack({len(fields)}, {', '.join(parts)}) as (position, column_name, data_type, nullable, n_non_null)")


def layout_report(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """P9 of a table's files: per file its size, its rows, and the tasks that read it.

    One scan without any column of the data; partial counts per file and task.
    """
    rows = spark.read.format(fmt).load(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), F.spark_partition_id().alias("task"))
    return rows.groupBy("file", "bytes", "task").agg(F.count(F.lit(1)).alias("n")).groupBy("file", "bytes").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_tasks"), F.max("n").alias("most_rows_of_a_task"))


def partition_report(df: DataFrame) -> DataFrame:
    """P9 of a frame: rows per partition, empty ones left out."""
    return df.select(F.spark_partition_id().alias("partition")).groupBy("partition").agg(F.count(F.lit(1)).alias("n_rows"))
