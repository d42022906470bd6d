"""The three marts over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions.money import money_sum, round2, total
from tillwright.operators.clean import region_lookup
from tillwright.operators.joins import few_rows, lookup
from tillwright.operators.quality import current_versions, gate_lookups
from tillwright.operators.windows import dense_rank_by, keep_last
from tillwright.schemas import require_columns
from tillwright.session import cut
from tillwright.sources.sinks import replace_table
from tillwright.sources.tables import Warehouse


def _sale_count(unique: bool) -> tuple[Column, Column]:
    """What a sale has to carry to be counted, and the count by sale id.

    Where sale ids are unique a sale counts for itself and its id is left behind.
    """
    if unique:
        return F.when(F.col("sale_id").isNotNull(), 1).alias("sale"), F.count("sale")
    return F.col("sale_id").alias("sale"), F.count_distinct("sale")


def sales_summary(
    fact: DataFrame,
    dim_date: DataFrame,
    dim_product: DataFrame,
    dim_store: DataFrame,
    regions: DataFrame,
    unique: bool = False,
) -> DataFrame:
    """Orders, quantity and revenue per day, region and category.

    ``unique`` says that neither sale ids nor the keys of the dimensions repeat, as in the
    star that ``build_fact`` makes; then no sale ids are moved and compared.
    """
    require_columns(
        fact,
        ["sale_id", "date_key", "product_key", "store_key", "quantity", "sales_amount"],
        "fact_sales",
    )
    sale, orders = _sale_count(unique)
    store_regions = lookup(dim_store.select("store_key", "store_id"), regions, ["store_id"])
    sales = fact.select(sale, "date_key", "product_key", "store_key", "quantity", "sales_amount")
    sales = sales.join(
        dim_date.select("date_key", F.col("full_date").alias("date")), "date_key", "left"
    )
    sales = lookup(
        sales,
        dim_product.select("product_key", "category"),
        ["product_key"],
        {"category": "Unknown"},
    )
    sales = lookup(
        sales,
        few_rows(store_regions.select("store_key", "region")),
        ["store_key"],
        {"region": "Unknown"},
    )
    # A sale without its day fails the task that finds it.
    day = F.coalesce(
        F.col("date"), F.raise_error(F.lit("a sale has no day in dim_date")).cast("date")
    )
    return (
        sales.withColumn("date", day)
        .groupBy("date", "region", "category")
        .agg(
            orders.alias("total_orders"),
            F.sum("quantity").alias("total_quantity"),
            money_sum("sales_amount").alias("total_revenue"),
        )
        .orderBy("date", "region", "category")
    )


def customer_analytics(
    fact: DataFrame, dim_date: DataFrame, dim_customer: DataFrame, unique: bool = False
) -> DataFrame:
    """Per natural customer over all versions, with the segment of the current one.

    ``unique`` says that neither sale ids nor the keys of ``dim_date`` repeat. Then the fact
    is summed by customer key, and the join sees one row per version.
    """
    require_columns(fact, ["sale_id", "customer_key", "date_key", "sales_amount"], "fact_sales")
    require_columns(
        dim_customer, ["customer_key", "customer_id", "customer_segment"], "dim_customer"
    )
    keys = dim_customer.select("customer_key", F.col("customer_id").cast("string")).filter(
        "customer_id IS NOT NULL"
    )
    sale, orders = _sale_count(unique)
    days = dim_date.select("date_key", F.col("full_date").alias("order_date"))
    sales = fact.select(sale, "customer_key", "date_key", "sales_amount").join(
        days, "date_key", "left"
    )
    last_day = F.max("order_date")
    if unique:
        by_key = sales.groupBy("customer_key").agg(
            orders.alias("n"), total("sales_amount").alias("r"), last_day.alias("order_date")
        )
        # A key that comes several times for a customer adds its amounts as often, its
        # sales once.
        copies = keys.groupBy("customer_key", "customer_id").agg(F.count(F.lit(1)).alias("copies"))
        spend = by_key.join(copies, "customer_key").groupBy("customer_id").agg(
            F.sum("n").alias("total_orders"),
            F.round(F.sum(F.col("r") * F.col("copies")), 2).alias("spend"),
            last_day.alias("last_order_date"),
        )
    else:
        spend = sales.join(keys, "customer_key").groupBy("customer_id").agg(
            orders.alias("total_orders"),
            money_sum("sales_amount").alias("spend"),
            last_day.alias("last_order_date"),
        )
    segments = current_versions(dim_customer).select(
        F.col("customer_id").cast("string"),
        F.coalesce("customer_segment", F.lit("Unknown")).alias("customer_segment"),
    )
    segments = keep_last(segments, ["customer_id"])
    average = F.coalesce(
        round2(F.try_divide(F.col("spend").cast("double"), F.col("total_orders"))), F.lit(0.0)
    )
    return (
        lookup(spend, segments, ["customer_id"], {"customer_segment": "Unknown"})
        .select(
            "customer_id",
            "total_orders",
            F.col("spend").cast("double").alias("total_spend"),
            average.alias("average_order_value"),
            "last_order_date",
            "customer_segment",
        )
        .orderBy(F.col("total_spend").desc(), "customer_id")
    )


def product_analytics(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Per product: quantity, revenue, average price and dense rank by revenue.

    The fact is summed by product key before it meets the dimension, so the
    join and the ranking see one row per product. Those rows are needed twice,
    for the ranks and for the result, and are cut off from the fact for that.
    """
    require_columns(fact, ["sale_id", "product_key", "quantity", "sales_amount"], "fact_sales")
    require_columns(dim_product, ["product_key", "product_id"], "dim_product")
    by_key = fact.groupBy("product_key").agg(
        F.sum("quantity").alias("q"), total("sales_amount").alias("r")
    )
    by_product = (
        by_key.join(
            dim_product.select("product_key", F.col("product_id").cast("string")), "product_key"
        )
        .filter("product_id IS NOT NULL")
        .groupBy("product_id")
        .agg(
            F.sum("q").alias("total_quantity_sold"),
            F.round(F.sum("r"), 2).alias("revenue"),
        )
    )
    average = F.coalesce(
        round2(F.try_divide(F.col("revenue").cast("double"), F.col("total_quantity_sold"))),
        F.lit(0.0),
    )
    return (
        dense_rank_by(cut(by_product), "revenue", "sales_rank")
        .select(
            "product_id",
            "total_quantity_sold",
            F.col("revenue").cast("double").alias("total_revenue"),
            average.alias("average_price"),
            "sales_rank",
        )
        .orderBy("sales_rank", "product_id")
    )


def load_marts(
    warehouse: Warehouse, region_by_store: dict[str, str] | None = None, unique: bool = False
) -> dict[str, int]:
    """Rebuild all marts; an empty input table stops the job before anything is written.

    ``unique`` is for a star that ``load_star`` has verified: its sale ids and keys do not
    repeat.
    """
    names = ("fact_sales", "dim_customer", "dim_product", "dim_store", "dim_date")
    tables = {n: warehouse.read(n) for n in names}
    empty = [n for n, df in tables.items() if df.isEmpty()]
    if empty:
        raise ValueError(f"empty tables {empty}; build the star schema first")
    fact = gate_lookups(tables["fact_sales"], ["date_key"])
    marts = {
        "mart_sales_summary": sales_summary(
            fact,
            tables["dim_date"],
            tables["dim_product"],
            tables["dim_store"],
            region_lookup(tables["dim_store"], region_by_store),
            unique,
        ),
        "mart_customer_analytics": customer_analytics(
            fact, tables["dim_date"], tables["dim_customer"], unique
        ),
        "mart_product_analytics": product_analytics(fact, tables["dim_product"]),
    }
    return {n: replace_table(df, warehouse.path(n)) for n, df in marts.items()}
