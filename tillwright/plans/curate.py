"""Raw text tables to curated tables: clean, validate, quarantine, upsert.

``curate_*`` are pure functions; ``load_*`` write the zones.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.operators import clean, quality
from tillwright.operators.windows import keep_last
from tillwright.plans import daily
from tillwright.plans.state import apply_changes
from tillwright.schemas import (
    CUSTOMER_COLUMNS,
    ORDER_COLUMNS,
    PRODUCT_COLUMNS,
    require_columns,
)
from tillwright.session import run_dir
from tillwright.sources import sinks, storage
from tillwright.sources.tables import Warehouse


@dataclass
class Checked:
    """Outcome of one batch; ``rejects`` and ``n_deletes`` where rows have been counted."""

    valid: DataFrame
    rejected: DataFrame
    deletes: DataFrame | None = None
    rejects: int | None = None
    n_deletes: int | None = None


def _arrival(df: DataFrame, arrival: list[str] | None) -> list[str]:
    return [n for n in arrival or [] if n in df.columns]


def _last_then(
    valid: DataFrame, key: str, arrival: list[str] | None, derived: list[str], finish: Finish
) -> DataFrame:
    """The last row per key, with columns that ``finish`` derives from the others.

    Derived columns come after all others and cannot decide between rows that are equal in
    those, so they are computed for the rows that stay and are not shuffled. Where the input
    has such a column, or the arrival is told by one, they are computed first.
    """
    if {*valid.columns, *(arrival or [])} & {*derived}:
        whole = finish(valid)
        return keep_last(whole, [key], _arrival(whole, arrival))
    return finish(keep_last(valid, [key], _arrival(valid, arrival)))


#: Takes a classified batch and, if it has one, the column that marks deletes.
Stage = Callable[[DataFrame, str | None], quality.Outcomes]
Finish = Callable[[DataFrame], DataFrame]


def _as_is(df: DataFrame) -> DataFrame:
    return df


def _split(classified: DataFrame, stage: Stage | None, deleted: str | None = None) -> Checked:
    """By one write, if there is a stage, else by filters."""
    if stage is None:
        gone = classified.filter(deleted).drop(deleted) if deleted else None
        rest = classified.filter(f"NOT {deleted}").drop(deleted) if deleted else classified
        return Checked(*quality.split_classified(rest), gone)
    found = stage(classified, deleted)
    return Checked(
        found.valid,
        found.rejected,
        found.deletes if deleted else None,
        found.counts[quality.REJECTED],
        found.counts[quality.DELETED],
    )


def curate_customers(
    raw: DataFrame, arrival: list[str] | None = None, stage: Stage | None = None
) -> Checked:
    df = clean.accept_customer_name(clean.clean_names(raw))
    require_columns(df, CUSTOMER_COLUMNS, "customers")
    checked = _split(quality.classify(clean.cast_customers(df), quality.customer_rules()), stage)
    last = keep_last(checked.valid, ["customer_id"], _arrival(checked.valid, arrival))
    return replace(checked, valid=last)


def curate_products(
    raw: DataFrame, arrival: list[str] | None = None, stage: Stage | None = None
) -> Checked:
    df = require_columns(clean.clean_names(raw), PRODUCT_COLUMNS, "products")
    checked = _split(quality.classify(clean.cast_products(df), quality.product_rules()), stage)
    last = keep_last(checked.valid, ["product_id"], _arrival(checked.valid, arrival))
    return replace(checked, valid=last)


def curate_orders(
    raw: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    arrival: list[str] | None = None,
    stage: Stage | None = None,
) -> Checked:
    """Row rules, reference check, amounts, last row per order; delete records aside."""
    df = require_columns(clean.clean_names(raw), ORDER_COLUMNS, "orders")
    marked = clean.cast_orders(df).withColumn("is_delete", quality.is_delete(df))
    classified = quality.classify(
        marked, quality.order_rules(), {"customer_id": customers, "product_id": products}
    )
    checked = _split(classified, stage, "is_delete")

    def price(df: DataFrame) -> DataFrame:
        priced = clean.order_amount(df, "total_amount", rounded=False)
        return clean.order_calendar(clean.order_amount(priced, "order_amount", rounded=True))

    derived = ["total_amount", "order_amount", "order_year", "order_month"]
    return replace(
        checked,
        valid=_last_then(checked.valid, "order_id", arrival, derived, price),
        deletes=checked.deletes.select("order_id"),
    )


def curate_enriched(
    raw: DataFrame, arrival: list[str] | None = None, stage: Stage | None = None
) -> Checked:
    df = clean.cast_enriched(clean.clean_names(raw))
    checked = _split(quality.classify(df, quality.enriched_rules(df.columns)), stage)
    finish, derived = _as_is, []
    if {"quantity", "unit_price"} <= set(checked.valid.columns):
        finish, derived = partial(clean.order_amount, name="total_amount", rounded=False), ["total_amount"]
    return replace(checked, valid=_last_then(checked.valid, "order_id", arrival, derived, finish))


def _load(
    zones: Warehouse,
    dataset: str,
    key: str,
    curate: Callable[[Stage], Checked],
    finish: Finish,
    at: str | None,
    batch: str | None,
    buckets: int | None,
) -> int:
    """Quarantine, processed zone, then the upsert into the curated table.

    The checked rows are written once to the shared folder, in a folder per outcome, and
    every output is made from there; the curated table is made from the processed files.
    Returns the number of processed rows.
    """
    spark = zones.spark
    folders: list[str] = []

    def stage(df: DataFrame, deleted: str | None) -> quality.Outcomes:
        folders.append(run_dir(spark, f"checked-{dataset}"))
        return quality.write_outcomes(df, folders[-1], deleted)

    try:
        checked = curate(stage)
        sinks.write_quarantine(
            checked.rejected, zones.path(f"quarantine/{dataset}"), batch, checked.rejects
        )
        rows = sinks.write_processed(checked.valid, zones.path(f"processed/{dataset}"))
        curated = f"curated/{dataset}"
        processed = zones.read(f"processed/{dataset}")
        deletes = checked.deletes if checked.n_deletes else None
        if rows or (deletes is not None and zones.has(curated)):
            incoming = clean.stamp(finish(processed), at)
            # The processed rows, if there are any, are the last of each key already.
            apply_changes(zones, curated, key, incoming, deletes, buckets=buckets, unique=rows > 0)
        return rows
    finally:
        for path in folders:
            storage.remove(spark, path)


def load_customers(
    zones: Warehouse,
    raw: DataFrame,
    at: str | None = None,
    batch: str | None = None,
    buckets: int | None = None,
    **order,
) -> int:
    return _load(
        zones,
        "customers",
        "customer_id",
        lambda stage: curate_customers(raw, stage=stage, **order),
        lambda df: clean.title_case(df, "customer_name"),
        at,
        batch,
        buckets,
    )


def load_products(
    zones: Warehouse,
    raw: DataFrame,
    at: str | None = None,
    batch: str | None = None,
    buckets: int | None = None,
    **order,
) -> int:
    return _load(
        zones,
        "products",
        "product_id",
        lambda stage: curate_products(raw, stage=stage, **order),
        lambda df: clean.title_case(df, "product_name"),
        at,
        batch,
        buckets,
    )


def load_orders(
    zones: Warehouse,
    raw: DataFrame,
    at: str | None = None,
    batch: str | None = None,
    buckets: int | None = None,
    **order,
) -> int:
    """The curated customers and products are the references."""
    customers = zones.read("curated/customers")
    products = zones.read("curated/products")
    return _load(
        zones,
        "orders",
        "order_id",
        lambda stage: curate_orders(raw, customers, products, stage=stage, **order),
        _as_is,
        at,
        batch,
        buckets,
    )


def load_enriched(
    zones: Warehouse,
    raw: DataFrame,
    at: str | None = None,
    batch: str | None = None,
    buckets: int | None = None,
    **order,
) -> int:
    return _load(
        zones,
        "orders_enriched",
        "order_id",
        lambda stage: curate_enriched(raw, stage=stage, **order),
        _as_is,
        at,
        batch,
        buckets,
    )


def load_order_summary(zones: Warehouse, at: str | None = None) -> int:
    """Daily summary of the curated orders; only what changed is summed again.

    Returns the days that the summary has; no orders, no summary.
    """
    if not zones.has(daily.ORDERS):
        return 0
    daily.refresh(zones, at)
    return zones.read(daily.SUMMARY).count()


LOADERS = {
    "customers": load_customers,
    "products": load_products,
    "orders": load_orders,
    "orders_enriched": load_enriched,
}


def load(zones: Warehouse, dataset: str, raw: DataFrame, **options) -> int:
    if dataset not in LOADERS:
        raise ValueError(f"unknown dataset {dataset}; there are {sorted(LOADERS)}")
    return LOADERS[dataset](zones, raw, **options)


def run_all(spark: SparkSession, base: str, raw: dict[str, DataFrame], **options) -> dict[str, int]:
    """All datasets in dependency order, then the daily summary."""
    zones = Warehouse(spark, base)
    rows = {name: load(zones, name, raw[name], **options) for name in LOADERS if name in raw}
    rows["order_summary"] = load_order_summary(zones, options.get("at"))
    return rows


def quarantine_counts(rejected: DataFrame) -> DataFrame:
    """Rejected rows per reason and set of broken rules."""
    return rejected.groupBy(
        "dq_reason", F.concat_ws(",", "failed_rules").alias("rules")
    ).agg(F.count(F.lit(1)).alias("rows"))
