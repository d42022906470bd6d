"""Grouped and scalar aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions.money import money_sum, percent, total


def sum_by(
    df: DataFrame,
    keys: list[str],
    amount: str | None = None,
    quantity: str | None = None,
    final: bool = True,
) -> DataFrame:
    """Revenue and units per group; with ``final`` off the revenue is summed further, unrounded."""
    aggregates: list[Column] = []
    if amount:
        aggregates.append((money_sum(amount) if final else total(amount)).alias("revenue"))
    if quantity:
        aggregates.append(F.sum(quantity).alias("units"))
    return df.groupBy(*keys).agg(*aggregates)


def distinct_by(df: DataFrame, keys: list[str], counted: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(counted).alias(name))


def count_by(
    df: DataFrame, keys: list[str], name: str = "rows", more_than: int | None = None
) -> DataFrame:
    """Rows per group; ``more_than`` is the HAVING form."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return counted if more_than is None else counted.filter(F.col(name) > more_than)


def value_counts(df: DataFrame, name: str, counted_as: str = "runs") -> DataFrame:
    return count_by(df.filter(F.col(name).isNotNull()), [name], counted_as)


def order_summary_status(orders: DataFrame, amount: str = "order_amount") -> DataFrame:
    return orders.groupBy("order_date", "order_status").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("quantity").alias("total_quantity"),
        money_sum(amount).alias("total_order_amount"),
    )


def order_summary_daily(orders: DataFrame, amount: str = "total_amount") -> DataFrame:
    """Per day; orders without a date form a group of their own."""
    return orders.groupBy("order_date").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_quantity"),
        F.coalesce(money_sum(amount), F.lit(0.0)).alias("total_sales"),
    )


def bounds(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.min(name).alias(f"min_{name}"), F.max(name).alias(f"max_{name}"))


def business_stats(orders: DataFrame, amount: str = "total_amount") -> DataFrame:
    revenue = money_sum(amount)
    return orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        revenue.alias("total_revenue"),
        F.try_divide(revenue, F.count(amount).cast("double")).alias("average_order_value"),
    )


def measure_by(df: DataFrame, dimension: str, measure: str) -> DataFrame:
    """Sum of a measure by a dimension, as it is; non-numeric measures and nulls are left out."""
    number = F.col(measure).cast("string").try_cast("double")
    usable = df.select(F.col(dimension), number.alias(measure)).filter(
        F.col(dimension).isNotNull() & F.col(measure).isNotNull() & ~F.isnan(measure)
    )
    return usable.groupBy(dimension).agg(F.sum(measure).alias(measure))


def distinct_points(df: DataFrame, dimension: str) -> DataFrame:
    return df.agg(F.count_distinct(dimension).alias("points"))


def overview(tables: dict[str, DataFrame]) -> DataFrame:
    """Tables, rows and columns of the whole warehouse, in one row."""
    per_table = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        per_table = one if per_table is None else per_table.unionByName(one)
    if per_table is None:
        raise ValueError("no tables")
    return per_table.agg(
        F.count(F.lit(1)).alias("tables"),
        F.sum("rows").alias("total_rows"),
        F.sum("columns").alias("total_columns"),
    )


def run_kpis(runs: DataFrame) -> DataFrame:
    """Run count, success rate, failures, records, rejects, mean duration; zeros if empty."""
    status = F.col("processing_status")
    n_runs = F.count(F.lit(1))
    zero = F.lit(0.0)
    return runs.agg(
        n_runs.alias("pipeline_runs"),
        F.coalesce(percent(F.count_if(status == "SUCCESS"), n_runs), zero).alias("success_rate"),
        F.count_if(status == "FAILED").alias("failed_runs"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("rejected_count"), F.lit(0)).alias("rejected_records"),
        F.coalesce(
            F.try_divide(
                F.sum(F.col("processing_time").cast("decimal(18,3)")).cast("double"),
                F.count("processing_time").cast("double"),
            ),
            zero,
        ).alias("avg_duration"),
    )


def runs_daily(runs: DataFrame) -> DataFrame:
    return runs.groupBy(
        F.col("ingestion_time").cast("date").alias("run_date"), "processing_status"
    ).agg(F.count(F.lit(1)).alias("runs"))
