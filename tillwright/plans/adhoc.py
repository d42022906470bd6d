"""Bounded ad-hoc SQL over registered tables. Spark parses, binds and plans it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwright.operators.ordering import RESULT_CAP, cap_rows
from tillwright.sources.tables import register


def run_sql(
    spark: SparkSession, query: str, tables: dict[str, DataFrame], cap: int = RESULT_CAP
) -> DataFrame:
    """Result of one query over the given tables, at most ``cap`` rows.

    The query stands in a subquery, so it has to be a single SELECT.
    """
    register(tables)
    return cap_rows(spark.sql(f"SELECT * FROM (\n{query.strip().rstrip(';')}\n) AS result"), cap)
