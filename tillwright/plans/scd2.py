"""The customer dimension with history (slowly changing, type 2)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions.text import tidy
from tillwright.operators.clean import accept_customer_name, normalise_day
from tillwright.operators.windows import keep_last, max_key, number_rows
from tillwright.schemas import TRACKED_CUSTOMER_COLUMNS, require_columns
from tillwright.session import cut

# Fixed value: end of a version that is still open.
OPEN_END = "9999-12-31"

HISTORY_COLUMNS = ["effective_from", "effective_to", "is_current", "version"]
COLUMNS = ["customer_key", "customer_id", *TRACKED_CUSTOMER_COLUMNS, *HISTORY_COLUMNS]


def _day(value: date | str):
    return F.lit(str(value)).cast("date")


def prepare_source(source: DataFrame, arrival: list[str] | None = None) -> DataFrame:
    """Last row per known id with the tracked attributes."""
    df = accept_customer_name(source)
    require_columns(df, ["customer_id", *TRACKED_CUSTOMER_COLUMNS], "customer source")
    df = normalise_day(df, "signup_date").withColumn("customer_id", tidy("customer_id"))
    df = df.filter(F.col("customer_id").isNotNull())
    order = [n for n in arrival or [] if n in df.columns]
    return keep_last(df, ["customer_id"], order).select("customer_id", *TRACKED_CUSTOMER_COLUMNS)


def first_load(source: DataFrame, first_day: date | str) -> DataFrame:
    """Every customer gets version 1, open from the earliest order day."""
    opened = source.select(
        "customer_id",
        *TRACKED_CUSTOMER_COLUMNS,
        _day(first_day).alias("effective_from"),
        _day(OPEN_END).alias("effective_to"),
        F.lit(True).alias("is_current"),
        F.lit(1).alias("version"),
    )
    return number_rows(opened, ["customer_id"], "customer_key").select(*COLUMNS)


def must_rebuild(dim: DataFrame, first_day: date | str) -> bool:
    """The dimension has no history columns, or a first load that starts too late.

    Raises if no row is current. One aggregate row reaches the driver.
    """
    if not set(HISTORY_COLUMNS) <= set(dim.columns):
        return True
    state = dim.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("is_current").alias("current"),
        F.min(F.when(F.col("is_current"), F.col("effective_from"))).alias("earliest"),
    ).first()
    if state["rows"] == 0:
        return True
    if state["current"] == 0:
        raise ValueError("the customer dimension has no current row")
    only_current = state["current"] == state["rows"]
    return only_current and str(state["earliest"]) > str(first_day)


def next_load(dim: DataFrame, source: DataFrame, run_day: date | str) -> DataFrame:
    """Open, close and update versions for one run.

    One join of the current versions with the source decides every row, and each joined
    row emits what becomes of it: the version that was there, kept, updated in place or
    closed, and the version that it opens. The emitted rows are stored once; only those
    that opened are numbered. Ids the source does not mention stay open.
    """
    today = _day(run_day)
    attributes = TRACKED_CUSTOMER_COLUMNS
    current = dim.filter("is_current").select(*COLUMNS)
    history = dim.filter(~F.coalesce(F.col("is_current"), F.lit(False))).select(*COLUMNS)
    incoming = source.select(
        F.col("customer_id").alias("new_id"), *[F.col(n).alias(f"new_{n}") for n in attributes]
    )
    both = current.join(incoming, F.col("customer_id") == F.col("new_id"), "full_outer")
    known, offered = F.col("customer_id").isNotNull(), F.col("new_id").isNotNull()
    # The attributes of both sides as one value each; nulls are equal to each other.
    before = F.struct(*[F.col(n).cast("string").alias(n) for n in attributes])
    after = F.struct(*[F.col(f"new_{n}").cast("string").alias(n) for n in attributes])
    changed = known & offered & ~before.eqNullSafe(after)
    in_place = changed & (F.col("effective_from") == today)
    closed = changed & (F.col("effective_from") != today)

    def version(**columns) -> Column:
        return F.struct(*[columns[n].cast(dim.schema[n].dataType).alias(n) for n in COLUMNS])

    settled = version(
        customer_key=F.col("customer_key"),
        customer_id=F.col("customer_id"),
        **{n: F.when(in_place, F.col(f"new_{n}")).otherwise(F.col(n)) for n in attributes},
        effective_from=F.col("effective_from"),
        effective_to=F.when(closed, F.date_sub(today, 1)).otherwise(F.col("effective_to")),
        is_current=~closed,
        version=F.col("version"),
    )
    opened = version(
        customer_key=F.lit(None),
        customer_id=F.col("new_id"),
        **{n: F.col(f"new_{n}") for n in attributes},
        effective_from=today,
        effective_to=_day(OPEN_END),
        is_current=F.lit(True),
        version=F.coalesce("version", F.lit(0)) + 1,
    )
    opens = offered & (~known | closed)
    emitted = cut(
        both.select(F.inline(F.array_compact(F.array(F.when(known, settled), F.when(opens, opened)))))
    )
    fresh = emitted.filter("customer_key IS NULL").drop("customer_key")
    numbered = number_rows(fresh, ["customer_id"], "customer_key", max_key(dim, "customer_key") + 1)
    kept = emitted.filter("customer_key IS NOT NULL")
    return history.unionByName(kept).unionByName(numbered.select(*COLUMNS))


def build_customer_dimension(
    source: DataFrame,
    dim: DataFrame | None,
    first_day: date | str,
    run_day: date | str,
    arrival: list[str] | None = None,
) -> DataFrame:
    """The whole dimension after one run; the caller rewrites the table with it."""
    prepared = prepare_source(source, arrival)
    if dim is None or must_rebuild(dim, first_day):
        return first_load(prepared, first_day)
    return next_load(dim, prepared, run_day)
