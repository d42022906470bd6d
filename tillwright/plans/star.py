"""Dimensions, the sales fact and their verification."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.functions.dates import as_day, calendar_columns
from tillwright.functions.money import line_amount
from tillwright.functions.text import tidy
from tillwright.operators import quality
from tillwright.operators.clean import default_discount
from tillwright.operators.joins import as_of, as_of_version, few_rows, lookup_on
from tillwright.operators.sets import distinct_values
from tillwright.operators.windows import keep_last, number_rows
from tillwright.plans.scd2 import build_customer_dimension
from tillwright.schemas import FACT_COLUMNS, require_columns
from tillwright.session import cut
from tillwright.sources import storage
from tillwright.sources.sinks import write_version
from tillwright.sources.tables import Warehouse


def product_dimension(products: DataFrame, arrival: list[str] | None = None) -> DataFrame:
    """Last row per product, numbered by id; keys are new on every refresh."""
    columns = ["product_id", "product_name", "category", "price", "supplier"]
    require_columns(products, columns, "products")
    df = products.withColumn("product_id", tidy("product_id")).filter("product_id IS NOT NULL")
    order = [n for n in arrival or [] if n in df.columns]
    last = keep_last(df, ["product_id"], order).select(*columns)
    return number_rows(last, ["product_id"], "product_key")


def store_dimension(orders: DataFrame) -> DataFrame:
    """Distinct store ids of the orders, numbered in order.

    Distinct first: the numbering sees one row per store.
    """
    ids = distinct_values(orders.select(tidy("store_id").alias("store_id")), "store_id")
    return number_rows(ids, ["store_id"], "store_key")


def date_dimension(orders: DataFrame) -> DataFrame:
    """The days on which orders exist; gaps stay gaps."""
    days = orders.select(as_day(orders, "order_date").alias("d"))
    return distinct_values(days, "d").select(*calendar_columns("d"))


def order_dimensions(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``store_dimension`` and ``date_dimension`` by one pass over the orders.

    Each order gives its store and its day as a row of their own; the distinct ones are kept
    and both dimensions made from them, so orders that are a join are joined once.
    """
    store, day = tidy("store_id"), as_day(orders, "order_date")
    entries = F.array(
        F.struct(store.alias("store_id"), F.lit(None).cast("date").alias("order_date")),
        F.struct(F.lit(None).cast("string").alias("store_id"), day.alias("order_date")),
    )
    found = cut(orders.select(F.inline(entries)).distinct())
    return store_dimension(found), date_dimension(found)


def versions_overlap(dim_customer: DataFrame) -> bool:
    """Whether some day falls into two versions of one customer."""
    previous = Window.partitionBy("customer_id").orderBy("effective_from", "effective_to")
    clash = F.lag("effective_to").over(previous) >= F.col("effective_from")
    return not dim_customer.select(clash.alias("clash")).filter("clash").isEmpty()


def _found(key: str, kind: str) -> Column:
    """The key, or a failing task if the lookup had no match; checked while writing."""
    message = F.lit(f"an order has no {key} in its dimension")
    return F.coalesce(F.col(key), F.raise_error(message).cast(kind)).alias(key)


def build_fact(
    orders: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_store: DataFrame,
    dim_date: DataFrame,
    arrival: list[str] | None = None,
    within: str | None = None,
) -> DataFrame:
    """One row per order with the customer version of the order day.

    Orders without a valid version drop out; a missing product, store or day
    fails the job. The discount is carried, not subtracted. ``within`` names a column that
    has one value for each order id, by which the orders are dealt out already, as after a
    join on it; then they are not shuffled by order id.
    """
    df = default_discount(orders).withColumns(
        {
            "order_id": tidy("order_id"),
            "customer_id": tidy("customer_id"),
            "product_id": tidy("product_id"),
            "store_id": tidy("store_id"),
            "order_date": as_day(orders, "order_date"),
        }
    )
    order = [n for n in arrival or [] if n in df.columns]
    used = [
        "order_id", "customer_id", "product_id", "store_id", "order_date",
        "quantity", "unit_price", "discount", *order,
    ]
    keys = [within, "order_id"] if within else ["order_id"]
    df = keep_last(df.select(*dict.fromkeys([*keys, *used])), keys, order)
    overlap = versions_overlap(dim_customer)
    as_of_day = as_of_version if overlap else as_of
    # A store's key is shorter than its id in the shuffles that follow.
    stores = few_rows(dim_store.select("store_key", "store_id"))
    df = lookup_on(df, stores, "store_id", "store_id")
    df = as_of_day(df, dim_customer, "customer_id", "order_date", ["customer_key"])
    df = lookup_on(df, dim_date.select("date_key", "full_date"), "order_date", "full_date")
    df = lookup_on(df, dim_product.select("product_key", "product_id"), "product_id", "product_id")
    fact = df.select(
        F.col("order_id").alias("sale_id"),
        "customer_key",
        _found("product_key", "bigint"),
        _found("store_key", "bigint"),
        _found("date_key", "int"),
        F.col("quantity").cast("bigint").alias("quantity"),
        line_amount("quantity", "unit_price").alias("sales_amount"),
        "discount",
    )
    # Orders are unique already. A sale can only repeat where versions overlap,
    # and looking at the dimension is cheaper than another pass over the fact.
    if overlap:
        fact = keep_last(fact, ["sale_id"], ["customer_key"])
    return fact.select(*FACT_COLUMNS)


MUST_BE_ZERO = ("customer_bad_current_keys", "customer_bad_date_order", "fact_duplicate_sale_ids")


def require_sound_star(fact: DataFrame, dim_customer: DataFrame) -> dict[str, int]:
    """All counts of the verification; a fault stops the load."""
    counts = {r["check"]: r["rows"] for r in verify_star(fact, dim_customer).collect()}
    faults = {n: counts[n] for n in MUST_BE_ZERO if counts[n]}
    if faults:
        raise quality.QualityError(f"the star is not sound: {faults}")
    return counts


def verify_star(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """(check, rows) of both verifications; those named in MUST_BE_ZERO have to be 0."""
    frames = [quality.verify_history(dim_customer), quality.verify_fact(fact)]
    parts = []
    for prefix, df in zip(("customer", "fact"), frames, strict=True):
        pairs = F.array(
            *[
                F.struct(F.lit(f"{prefix}_{n}").alias("check"), F.col(n).alias("rows"))
                for n in df.columns
            ]
        )
        parts.append(df.select(F.inline(pairs)))
    return parts[0].unionByName(parts[1])


def load_star(
    warehouse: Warehouse,
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    run_day: date | str,
    arrival: list[str] | None = None,
    within: str | None = None,
) -> dict[str, int]:
    """All dimensions, then the fact, verified and only then shown, all in one step.

    Until the written tables have passed, readers see the star as it was; a fault leaves
    it so. ``within`` is that of ``build_fact``.
    """
    spark = warehouse.spark
    dim_store, dim_date = order_dimensions(orders)
    first_day = dim_date.agg(F.min("full_date")).first()[0]
    if first_day is None:
        raise ValueError("orders hold no date, so the history cannot start")
    ready: dict[str, storage.Shown] = {}
    rows: dict[str, int] = {}

    def write(name: str, df: DataFrame) -> DataFrame:
        ready[name], rows[name] = write_version(df, warehouse.path(name))
        return storage.read_shown(spark, ready[name])

    known = warehouse.read_or_none("dim_customer")
    dims = [
        write("dim_customer", build_customer_dimension(customers, known, first_day, run_day, arrival)),
        write("dim_product", product_dimension(products, arrival)),
        write("dim_store", dim_store),
        write("dim_date", dim_date),
    ]
    fact = write("fact_sales", build_fact(orders, *dims, arrival, within))
    counts = require_sound_star(fact, dims[0])
    for name, check in (("fact_sales", "fact_total_rows"), ("dim_customer", "customer_total_rows")):
        if counts[check] != rows[name]:
            raise quality.QualityError(f"{name} has {counts[check]} rows, {rows[name]} were written")
    storage.show_together(spark, warehouse.base, ready)
    return rows
