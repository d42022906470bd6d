"""The business questions over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions.dates import month_start
from tillwright.functions.money import money_sum, percent, total
from tillwright.operators.ordering import top
from tillwright.operators.quality import current_versions
from tillwright.operators.windows import change_to_previous
from tillwright.sources.sinks import replace_partitioned

# Length of the top list, days without order that make inactive.
TOP_PRODUCTS = 10
INACTIVE_DAYS = 90


def top_products(fact: DataFrame, dim_product: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    """Products by revenue. The fact shrinks to one row per product before the join."""
    by_key = fact.groupBy("product_key").agg(
        total("sales_amount").alias("r"), F.sum("quantity").alias("q")
    )
    per_product = (
        by_key.join(
            dim_product.select("product_key", "product_id", "product_name", "category"),
            "product_key",
        )
        .groupBy("product_id", "product_name", "category")
        .agg(F.round(F.sum("r"), 2).alias("revenue"), F.sum("q").alias("units_sold"))
    )
    return top(per_product, "revenue", ["product_id"], n)


def city_sales(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return (
        fact.join(dim_customer.select("customer_key", "city"), "customer_key")
        .groupBy("city")
        .agg(
            money_sum("sales_amount").alias("total_sales"),
            F.count_distinct("sale_id").alias("orders"),
        )
        .orderBy(F.col("total_sales").desc(), "city")
    )


def monthly_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue and orders per month with growth over the previous present month."""
    months = (
        fact.join(dim_date.select("date_key", "full_date"), "date_key")
        .groupBy(month_start("full_date").alias("month"))
        .agg(
            money_sum("sales_amount").alias("revenue"),
            F.count_distinct("sale_id").alias("orders"),
        )
    )
    return (
        change_to_previous(months, "month", "revenue")
        .select(
            "month",
            "revenue",
            "orders",
            F.col("previous_revenue").alias("previous_month_revenue"),
            F.col("growth_percent").alias("mom_growth_percent"),
        )
        .orderBy("month")
    )


def inactive_customers(
    fact: DataFrame,
    dim_date: DataFrame,
    dim_customer: DataFrame,
    days: int = INACTIVE_DAYS,
    by: str = "customer_key",
) -> DataFrame:
    """Current customers without an order in the last days before the latest order day.

    By ``customer_key`` an order belongs to the version it was placed under, so
    a customer counts as inactive until the newest version has an order. By
    ``customer_id`` orders of all versions count.
    """
    cutoff = dim_date.agg(F.date_sub(F.max("full_date"), days)).scalar()
    recent_days = dim_date.filter(F.col("full_date") >= cutoff).select("date_key")
    active = fact.join(recent_days, "date_key", "left_semi").select("customer_key").distinct()
    if by == "customer_id":
        active = (
            dim_customer.select("customer_key", "customer_id")
            .join(active, "customer_key", "left_semi")
            .select("customer_id")
            .distinct()
        )
    return (
        current_versions(dim_customer)
        .join(active, by, "left_anti")
        .select(
            "customer_key", "customer_id", "customer_name", "email", "city", "state",
            "customer_segment", "effective_from",
        )
        .orderBy("customer_id")
    )


def last_months(fact: DataFrame, dim_date: DataFrame, n: int = 2) -> DataFrame:
    """Days (date_key, month) of the last months that have sales, found by the distinct days.

    Where the fact lies in month folders, only those of the last months are read for that.
    """
    if "month_key" in fact.columns:
        newest = fact.select("month_key").distinct().orderBy(F.desc("month_key")).limit(n)
        fact = fact.where(F.col("month_key").isin([r["month_key"] for r in newest.collect()]))
    sold = fact.select("date_key").distinct()
    days = dim_date.join(sold, "date_key", "left_semi").select(
        "date_key", month_start("full_date").alias("month")
    )
    newest = days.select("month").distinct().orderBy(F.col("month").desc_nulls_last()).limit(n)
    return days.join(newest, "month", "left_semi").select("date_key", "month")


def category_months(fact: DataFrame, dim_product: DataFrame, days: DataFrame) -> DataFrame:
    """Revenue per category and month over the given days, summed by key before the product join."""
    by_key = (
        _by_day(fact, days, "month")
        .groupBy("product_key", "month")
        .agg(total("sales_amount").alias("r"))
    )
    return (
        by_key.join(dim_product.select("product_key", "category"), "product_key")
        .groupBy("category", "month")
        .agg(F.round(F.sum("r"), 2).alias("revenue"))
    )


def compare_last_months(
    fact: DataFrame, dim_product: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """Each category's revenue in the previous and the latest present month.

    Only the sales of these two months are read; only categories of the previous
    month appear.
    """
    days = last_months(fact, dim_date)
    latest = days.agg(F.max("month")).scalar()
    is_latest = F.col("month") == latest
    return (
        category_months(fact, dim_product, days)
        .groupBy("category")
        .agg(
            F.sum(F.when(~is_latest, F.col("revenue"))).alias("previous_month_revenue"),
            F.coalesce(F.sum(F.when(is_latest, F.col("revenue"))), F.lit(0.0)).alias(
                "latest_month_revenue"
            ),
        )
        .filter(F.col("previous_month_revenue").isNotNull())
    )


def declining_categories(
    fact: DataFrame, dim_product: DataFrame, dim_date: DataFrame
) -> DataFrame:
    """Categories whose revenue fell from the previous to the latest month."""
    change = F.col("latest_month_revenue") - F.col("previous_month_revenue")
    return (
        compare_last_months(fact, dim_product, dim_date)
        .withColumn("revenue_change", change)
        .withColumn("change_percent", percent("revenue_change", "previous_month_revenue"))
        .filter(F.col("revenue_change") < 0)
        .orderBy("revenue_change", "category")
    )


def month_key(date_key: Column | str) -> Column:
    """199601 of the key 19960131."""
    key = F.col(date_key) if isinstance(date_key, str) else date_key
    return F.floor(key / 100).cast("int").alias("month_key")


def fact_by_month(fact: DataFrame) -> DataFrame:
    """The fact with the column that its folders are named by."""
    return fact.withColumn("month_key", month_key("date_key"))


def load_fact_by_month(fact: DataFrame, path: str) -> None:
    """The fact in a folder per month, where the questions below find it.

    A question that chooses days in the date dimension joins by month and day. Spark then
    takes the months of the chosen days from the dimension at run time and lists only
    their folders.
    """
    replace_partitioned(fact_by_month(fact), path, "month_key")


def _by_day(fact: DataFrame, days: DataFrame, *carry: str) -> DataFrame:
    """The sales of the given days; by month as well, where the fact lies in month folders."""
    if "month_key" not in fact.columns:
        return fact.join(days.select("date_key", *carry), "date_key", "inner" if carry else "left_semi")
    keyed = days.select("date_key", month_key("date_key"), *carry)
    return fact.join(keyed, ["month_key", "date_key"], "inner" if carry else "left_semi")


def category_revenue(
    fact: DataFrame, dim_product: DataFrame, dim_date: DataFrame, start: str, end: str
) -> DataFrame:
    """Revenue per category, first day included, last day excluded."""
    day = F.col("full_date")
    days = dim_date.filter(
        (day >= F.lit(start).cast("date")) & (day < F.lit(end).cast("date"))
    ).select("date_key")
    by_key = (
        _by_day(fact, days)
        .groupBy("product_key")
        .agg(total("sales_amount").alias("r"))
    )
    return (
        by_key.join(dim_product.select("product_key", "category"), "product_key")
        .groupBy("category")
        .agg(F.round(F.sum("r"), 2).alias("revenue"))
        .orderBy("category")
    )
