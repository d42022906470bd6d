"""Row picking, numbering, ranking and calendar windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.functions.money import percent
from tillwright.session import cut


def keep_last(
    df: DataFrame,
    keys: list[str],
    order: list[str] | None = None,
    priority: list[str] | None = None,
) -> DataFrame:
    """One row per key: the greatest by ``order`` (nulls lowest), then by all columns.

    The total order makes the survivor independent of partitioning. Spark turns
    ``row_number() = 1`` into a group limit before the shuffle, so each task
    sends at most one row of a key, however many copies there are.
    """
    leading = list(order or []) + list(priority or [])
    rest = [n for n in df.columns if n not in keys and n not in leading]
    orderable = [n for n in rest if not df.schema[n].dataType.typeName().startswith("map")]
    ordering = [F.col(n).desc_nulls_last() for n in leading + orderable]
    window = Window.partitionBy(*keys).orderBy(*(ordering or [F.lit(1)]))
    return df.withColumn("__rn", F.row_number().over(window)).filter("__rn = 1").drop("__rn")


def latest_by(
    existing: DataFrame, incoming: DataFrame, keys: list[str], timestamp: str | None
) -> DataFrame:
    """Union of two sides with one row per key.

    With a timestamp the greatest wins, a null one counts as oldest and the
    incoming side wins ties; without one the incoming side wins.
    """
    both = existing.withColumn("__side", F.lit(0)).unionByName(
        incoming.withColumn("__side", F.lit(1))
    )
    order = [timestamp, "__side"] if timestamp else ["__side"]
    return keep_last(both, keys, order).drop("__side")


def number_rows(
    df: DataFrame, order: list[str | Column], name: str, start: Column | int = 1
) -> DataFrame:
    """Gap-free numbers in sort order without sorting everything in one task.

    A distributed sort gives every row its partition and its place in it. After
    the cut both are fixed data, so the per-partition offsets (one row per
    partition, hence safe to broadcast) fit whatever is recomputed later.
    ``order`` has to be unique per row.
    """
    placed = cut(df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33)
    placed = placed.withColumns(
        {"__part": part, "__place": F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    )
    first = F.lit(start).cast("bigint") if isinstance(start, int) else start.cast("bigint")
    return placed.join(F.broadcast(offsets), "__part").select(
        (first + F.col("__offset") + F.col("__place")).cast("bigint").alias(name), *df.columns
    )


def max_key(df: DataFrame, name: str) -> int:
    """Greatest key in use, 0 for an empty table (one aggregate row on the driver)."""
    return int(df.agg(F.max(name)).first()[0] or 0)


def continue_keys(
    new_rows: DataFrame, existing: DataFrame, key: str, order: list[str]
) -> DataFrame:
    """Number new rows from the greatest existing key upwards."""
    return number_rows(new_rows, order, key, max_key(existing, key) + 1)


def dense_rank_by(df: DataFrame, value: str, name: str, descending: bool = True) -> DataFrame:
    """Dense rank over the whole frame.

    The distinct values are numbered, then joined back: equal values meet as one
    row before the sort, and no task sees the whole frame.
    """
    distinct = df.select(value).filter(F.col(value).isNotNull()).distinct()
    order = F.col(value).desc() if descending else F.col(value).asc()
    ranks = number_rows(distinct, [order], name)
    return df.join(ranks, value, "left").select(*df.columns, name)


def top_per_group(
    df: DataFrame, group: list[str], order: list[Column], n: int, method: str = "row_number"
) -> DataFrame:
    """First n rows (or ranks) per group; limited per task before the shuffle."""
    rank = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[method]()
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank_in_group", rank.over(window)).filter(F.col("rank_in_group") <= n)


# The windows below run over one row per calendar period (and at most one more
# small grouping column), the result of an aggregation. The calendar bounds them.


def change_to_previous(per_period: DataFrame, period: str, value: str) -> DataFrame:
    """Previous present period's value and growth in percent; gaps are not filled."""
    previous = F.lag(value).over(Window.orderBy(period))
    return per_period.withColumn(f"previous_{value}", previous).withColumn(
        "growth_percent",
        percent(F.col(value) - F.col(f"previous_{value}"), F.col(f"previous_{value}")),
    )


def running_total(per_period: DataFrame, group: list[str], period: str, value: str) -> DataFrame:
    window = (
        Window.partitionBy(*group)
        .orderBy(period)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return per_period.withColumn("running_total", F.sum(value).over(window))


def contribution(
    df: DataFrame, value: str, group: list[str] | None = None, name: str = "contribution_percent"
) -> DataFrame:
    """Share of the total, or of the group's total, in percent.

    Totals are aggregated and joined back instead of using a window, so that a
    large group is never gathered in one task.
    """
    if not group:
        total = df.agg(F.sum(value)).scalar()
        return df.withColumn(name, percent(F.col(value).cast("double"), total.cast("double")))
    totals = df.groupBy(*group).agg(F.sum(value).alias("__total"))
    return (
        df.join(totals, group, "left")
        .withColumn(name, percent(F.col(value).cast("double"), F.col("__total").cast("double")))
        .drop("__total")
    )


def year_over_year(per_month: DataFrame, month: str, value: str) -> DataFrame:
    """Each month next to the same month one year earlier (null where there is none)."""
    earlier = per_month.select(
        F.add_months(F.col(month), 12).alias(month), F.col(value).alias("previous_year")
    )
    return per_month.join(earlier, month, "left").withColumn(
        "yoy_percent", percent(F.col(value) - F.col("previous_year"), F.col("previous_year"))
    )
