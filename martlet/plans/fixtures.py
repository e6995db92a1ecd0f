"""Shared fixture views, written once as SQL text and run by both engines.

``{s}`` is the string type name (``string`` in Spark, ``varchar`` in DuckDB);
``{lineitem}`` / ``{part}`` are the input relations (a DataFrame argument of
``spark.sql`` on Spark, the pre-registered view name in DuckDB).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The dirty-cell pattern of the shared `dirty` view.
DIRTY_SQL = """
select l_orderkey, l_linenumber,
  case when l_orderkey%7=0 then null when l_orderkey%11=0 then 'unknown' when l_orderkey%13=0 then 'NaN'
       when l_orderkey%17=0 then '' when l_orderkey%19=0 then '-1.5' when l_orderkey%23=0 then '150'
       else cast(l_quantity as {s}) end as qty,
  case when l_partkey%2=0 or l_partkey%5=0 then null else cast(l_discount as {s}) end as disc,
  cast(l_tax as {s}) as tax, cast(l_extendedprice as {s}) as price
from {lineitem}
"""

# The flagship view, unique key `code`.
DIRTY_PART_SQL = """
select cast(p_partkey as {s}) as code, p_name,
  case when p_partkey%7=0 then null when p_partkey%11=0 then 'unknown' when p_partkey%13=0 then 'NaN'
       when p_partkey%17=0 then '150' when p_partkey%19=0 then '-1.5' else cast(p_size as {s}) end as size_g,
  cast(p_retailprice/10 as {s}) as price_g
from {part}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = DIRTY_SQL.replace("{s}", "string")
    return spark.sql(sql, lineitem=table(spark, sf_dir, "lineitem"))


def dirty_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = DIRTY_PART_SQL.replace("{s}", "string")
    return spark.sql(sql, part=table(spark, sf_dir, "part"))


def duck(sql: str) -> str:
    """Fixture SQL in DuckDB dialect over the pre-registered views."""
    return sql.replace("{s}", "varchar").replace("{lineitem}", "lineitem").replace("{part}", "part")


def with_dirty(body: str) -> str:
    return f"with dirty as ({duck(DIRTY_SQL)}) {body}"


def with_dirty_part(body: str) -> str:
    return f"with dirty_part as ({duck(DIRTY_PART_SQL)}) {body}"
