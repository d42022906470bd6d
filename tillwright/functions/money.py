"""Money expressions. Amounts are doubles; a total is rounded once, at its end."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwright.functions.text import col


def total(c: Column | str) -> Column:
    """Sum of the values as they are, for totals that are summed further; NaN counts as missing."""
    return F.sum(F.nanvl(col(c).cast("double"), F.lit(None).cast("double")))


def money_sum(c: Column | str, places: int = 2) -> Column:
    return F.round(total(c), places)


def round2(c: Column | str) -> Column:
    """Round a double at two places, halves away from zero.

    It is first rounded at eight, so that the last bit of a quotient does not decide a half.
    """
    return F.round(F.round(col(c).cast("double"), 8), 2)


def line_amount(quantity: Column | str, price: Column | str, rounded: bool = False) -> Column:
    amount = col(quantity).cast("double") * col(price).cast("double")
    return round2(amount) if rounded else amount


def percent(part: Column | str, whole: Column | str) -> Column:
    """``part / whole * 100``; null where the whole is null or zero."""
    return F.try_divide(col(part), col(whole)) * F.lit(100.0)
