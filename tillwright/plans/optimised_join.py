"""The wide order join: prune, filter, join, write by month or day."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tillwright.operators.clean import join_inputs
from tillwright.operators.joins import star_chain
from tillwright.operators.quality import known_status, within_days
from tillwright.schemas import require_columns
from tillwright.sources.files import read_source
from tillwright.sources.sinks import write_by_day


def _chosen(orders: DataFrame, start: str | None, end: str | None) -> DataFrame:
    return orders.where(within_days("order_date", start, end) & known_status())


def wide_orders(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    start: str | None = None,
    end: str | None = None,
    broadcast_mb: float | None = None,
) -> DataFrame:
    """Filter on the stored columns, so that it reaches the scan; then project and join."""
    require_columns(
        orders,
        ["order_id", "customer_id", "product_id", "order_date", "quantity", "unit_price",
         "order_status"],
        "orders",
    )
    require_columns(
        customers,
        ["customer_id", "customer_name", "city", "state", "customer_segment"],
        "customers",
    )
    require_columns(products, ["product_id", "product_name", "category", "price"], "products")
    typed, people, goods = join_inputs(orders, customers, products)
    return star_chain(_chosen(typed, start, end), people, goods, broadcast_mb)


def run(
    spark: SparkSession,
    orders_path: str,
    customers_path: str,
    products_path: str,
    output: str,
    file_format: str = "parquet",
    start: str | None = None,
    end: str | None = None,
    broadcast_mb: float | None = None,
    output_partitions: int | None = None,
    keep_orders: bool = False,
    explain: bool = False,
    grain: str = "month",
) -> None:
    """Read, filter, join and write; ``grain`` says whether a folder holds a month or a day."""
    orders = read_source(spark, orders_path, file_format)
    if keep_orders:
        orders = _chosen(orders, start, end).persist(StorageLevel.MEMORY_AND_DISK)
    joined = wide_orders(
        orders,
        read_source(spark, customers_path, file_format),
        read_source(spark, products_path, file_format),
        start,
        end,
        broadcast_mb,
    )
    if explain:
        joined.explain("formatted")
    write_by_day(joined, output, "order_date", output_partitions, grain)
    if keep_orders:
        orders.unpersist()
