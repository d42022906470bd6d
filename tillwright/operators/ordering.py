"""Sorting, limits and top-k reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.functions.dates import parse_day

# Result cap of ad-hoc SQL; chart group limit and groups kept.
RESULT_CAP = 500
MAX_SLICES = 12
KEPT_SLICES = 10
LATEST_RUNS = 25


def top(df: DataFrame, by: str, tie: list[str], n: int) -> DataFrame:
    """First n rows by a measure, greatest first; each task keeps n rows only."""
    return df.orderBy(F.col(by).desc_nulls_last(), *tie).limit(n)


def sort_by(df: DataFrame, *columns: str) -> DataFrame:
    """Sort by several columns; a leading minus means descending, nulls last."""
    order = [
        F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_first()
        for c in columns
    ]
    return df.orderBy(*order)


def sort_chronologically(df: DataFrame, name: str) -> DataFrame:
    """Sort by date if every value parses as one, otherwise by text.

    Whether all parse is a scalar subquery, so the decision stays in the plan.
    """
    text = F.col(name).cast("string")
    all_dates = df.agg(F.bool_and(parse_day(text).isNotNull())).scalar()
    return df.orderBy(F.when(all_dates, parse_day(text)).asc_nulls_first(), text, F.col(name))


def top_with_other(
    df: DataFrame, dimension: str, measure: str, limit: int = MAX_SLICES, keep: int = KEPT_SLICES
) -> DataFrame:
    """All groups up to ``limit``; beyond it the first ``keep`` and ``Other``.

    ``Other`` is the sum of all remaining groups, left out when it is zero. The
    kept groups are at most ``limit`` rows; the rest is aggregated in parallel.
    """
    label = F.col(dimension).cast("string").alias(dimension)
    ordered = [F.col(measure).desc_nulls_last(), F.col(dimension)]
    first = df.orderBy(*ordered).limit(limit + 1)
    many = first.agg(F.count(measure) + F.count_if(F.col(measure).isNull()) > limit).scalar()
    kept = df.orderBy(*ordered).limit(keep)
    rest = (
        df.join(F.broadcast(kept.select(dimension)), dimension, "left_anti")
        .agg(F.sum(measure).alias(measure))
        .filter(many & (F.coalesce(F.col(measure), F.lit(0.0)) != 0))
        .select(F.lit("Other").alias(dimension), measure)
    )
    shown = (
        df.orderBy(*ordered)
        .limit(limit)
        .join(
            F.broadcast(kept.select(dimension).withColumn("__kept", F.lit(True))),
            dimension,
            "left",
        )
        .filter(~many | F.col("__kept"))
        .select(label, measure)
    )
    return shown.unionByName(rest)


def cap_rows(df: DataFrame, n: int = RESULT_CAP) -> DataFrame:
    return df.limit(n)


def latest_runs(runs: DataFrame, n: int = LATEST_RUNS) -> DataFrame:
    return runs.orderBy(
        F.col("ingestion_time").desc_nulls_last(), F.col("run_id").desc_nulls_last()
    ).limit(n)
