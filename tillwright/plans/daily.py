"""The daily order summary, kept up to date by what changed.

Next to the curated orders lies a small table of sums per bucket and day. A refresh sums
only the buckets that were written since (their folder is another than the sums were made
from), compares these sums with the former ones, and makes the days of the months anew in
which a sum changed. Everything follows from what the catalogue shows, not from what a run
remembers: a run that died is simply repeated, and nothing is counted twice.

Amounts are summed as decimals of the unrounded products, so a total does not depend on
the order of summation and is the same however often it was refreshed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillwright.operators.clean import stamp
from tillwright.plans.state import BUCKET, bucket_of
from tillwright.sources import storage
from tillwright.sources.tables import Warehouse

ORDERS, SUMMARY, SUMS = "curated/orders", "curated/order_summary", "curated/order_summary_sums"
#: Exact sums of amounts; what is no number or beyond 10^18 counts as missing.
AMOUNT = "decimal(28,10)"
MEASURES = ["orders", "quantity", "amount"]


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: the buckets it summed and the months it made anew."""

    buckets: list[int]
    months: list[int]


def month_number(day: Column | str) -> Column:
    """199601 for a day of January 1996; 0 for orders without a date."""
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(0)).cast("int")


def day_sums(orders: DataFrame, buckets: int) -> DataFrame:
    """Orders (each id once), quantity and exact amount per bucket and day."""
    return orders.groupBy(bucket_of("order_id", buckets).alias("bucket"), "order_date").agg(
        F.count("order_id").alias("orders"),
        F.sum("quantity").alias("quantity"),
        F.sum(F.col("total_amount").try_cast(AMOUNT)).alias("amount"),
    )


def summary(sums: DataFrame) -> DataFrame:
    """The daily summary from the sums of all buckets."""
    return sums.groupBy("order_date").agg(
        F.sum("orders").alias("total_orders"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_quantity"),
        F.coalesce(F.round(F.sum("amount"), 2).cast("double"), F.lit(0.0)).alias("total_sales"),
    )


def _write_parts(df: DataFrame, part: Column, path: str) -> storage.Shown:
    """The rows in a fresh folder, one sub-folder per part; nothing shows them yet."""
    folder = storage.new_version(path)
    seen = Observation()
    marked = df.withColumn(BUCKET, part).observe(seen, F.collect_set(BUCKET).alias("written"))
    marked.repartition(BUCKET).write.partitionBy(BUCKET).parquet(folder)
    return storage.Shown(df.schema, buckets=0, parts={p: folder for p in seen.get["written"]})


def _with(parts: dict[int, str], new: storage.Shown, gone: set[int]) -> storage.Shown:
    """A table of the parts that stay and the new ones."""
    rest = {p: f for p, f in parts.items() if p not in gone}
    return storage.Shown(new.schema, buckets=0, parts=rest | new.parts)


def refresh(zones: Warehouse, at: str | None = None) -> Refresh:
    """Bring the summary up to the curated orders."""
    spark = zones.spark
    orders = storage.current(spark, zones.path(ORDERS))
    if orders is None or orders.buckets is None:
        raise LookupError(f"there is no table in buckets at {zones.path(ORDERS)}")
    shown, old = storage.current(spark, zones.path(SUMMARY)), storage.current(spark, zones.path(SUMS))
    before = storage.read_shown(spark, old) if old else None
    # One row per bucket comes to the driver.
    made_from = dict(map(tuple, before.select("bucket", "source").distinct().collect())) if old else {}
    source = {b: f.rsplit("/", 1)[-1] for b, f in orders.parts.items()}
    stale = sorted(b for b in source if made_from.get(b) != source[b])
    gone = sorted(b for b in made_from if b not in source)
    if not stale and not gone and shown is not None:
        return Refresh([], [])
    own = storage.Shown(orders.schema, buckets=orders.buckets, parts={b: orders.parts[b] for b in stale})
    names = spark.createDataFrame([(b, source[b]) for b in stale], "bucket int, source string")
    fresh = day_sums(storage.read_shown(spark, own), orders.buckets).join(F.broadcast(names), "bucket")
    written = _write_parts(fresh, F.col("bucket"), zones.path(SUMS))
    sums = _with(old.parts if old else {}, written, {*stale, *gone})
    after = storage.read_shown(spark, written)
    months = _changed_months(before, after, [*stale, *gone])
    every = storage.read_shown(spark, sums).where(month_number("order_date").isin(months))
    days = _write_parts(stamp(summary(every), at), month_number("order_date"), zones.path(SUMMARY))
    # The summary first: if the run ends in between, the sums are still the old ones and
    # the next run does the same again.
    storage.show(spark, zones.path(SUMMARY), _with(shown.parts if shown else {}, days, set(months)))
    storage.show(spark, zones.path(SUMS), sums)
    return Refresh(stale, months)


def _changed_months(before: DataFrame | None, after: DataFrame, buckets: list[int]) -> list[int]:
    """Months in which a sum of these buckets is another than before, or new, or gone."""
    columns = ["bucket", "order_date", *MEASURES]
    new = after.select(*columns)
    if before is None:
        differs = new
    else:
        old = before.where(F.col("bucket").isin(buckets)).select(*columns)
        differs = new.exceptAll(old).unionByName(old.exceptAll(new))
    found = differs.select(month_number("order_date").alias("month")).distinct().collect()
    return sorted(r["month"] for r in found)
