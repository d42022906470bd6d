"""Date expressions; every parser returns null instead of raising."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.functions.text import col, tidy

def parse_day(c: Column | str) -> Column:
    """Text to date: year-month-day, with or without zero padding or a time part.

    The cast would take a bare year or month too; a day needs two hyphens.
    """
    text = tidy(c)
    has_day = F.substring_index(text, "-", 2) != text
    return F.when(has_day, text.try_cast("timestamp_ntz").cast("date"))


def as_day(df: DataFrame, name: str) -> Column:
    """Date from a date, timestamp or text column, chosen by the column's type."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("date")
    return parse_day(name)


def month_start(c: Column | str) -> Column:
    return F.trunc(col(c), "MM")


def shifted(
    c: Column | str, days: int | Column = 0, months: int | Column = 0, hours: int | Column = 0
) -> Column:
    """A date or timestamp moved by an interval; months first, then days and hours.

    A day that the month does not have becomes the month's last. Hours are for timestamps.
    """

    def number(n: int | Column) -> Column:
        return n if isinstance(n, Column) else F.lit(n)

    return col(c) + F.make_interval(months=number(months), days=number(days), hours=number(hours))


def whole_days(start: Column | str, end: Column | str) -> Column:
    """Days between two dates or timestamps, by the interval between them; negative if reversed."""
    return F.extract(F.lit("DAY"), col(end) - col(start)).cast("bigint")


def day_key(c: Column | str) -> Column:
    """20240131 for 2024-01-31."""
    d = col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(c: Column | str) -> list[Column]:
    """Attributes of the date dimension; weeks are ISO weeks, Monday is 1."""
    d = col(c)
    return [
        day_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
    ]
