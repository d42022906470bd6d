"""Column expressions for names, codes and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the address pattern a customer e-mail has to match.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"

NULL_MARK = "<NULL>"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tidy(c: Column | str) -> Column:
    return F.trim(col(c).cast("string"))


def code(c: Column | str) -> Column:
    """Codes such as segment, state or status: trimmed upper case."""
    return F.upper(tidy(c))


def email(c: Column | str) -> Column:
    return F.lower(tidy(c))


def title(c: Column | str) -> Column:
    return F.initcap(col(c))


def whole_number(c: Column | str) -> Column:
    """Text to long; anything else than a whole number becomes null.

    The pattern comes first because a failing cast to long raises and catches an
    exception per row.
    """
    text = tidy(c)
    return F.when(text.rlike(r"^[+-]?0*[0-9]{1,19}$"), text.try_cast("bigint"))


def decimal_number(c: Column | str) -> Column:
    """Text to double; unparseable text and NaN become null."""
    return F.nanvl(tidy(c).try_cast("double"), F.lit(None).cast("double"))


def comparable(c: Column | str) -> Column:
    """Text form used to compare attributes, null shown as a mark."""
    return F.coalesce(col(c).cast("string"), F.lit(NULL_MARK))
