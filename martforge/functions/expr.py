"""Scalar expressions of the warehouse, all built from JVM-side functions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from martforge.schemas import AMOUNT, TOTAL

# Fixed value: label given to a customer whose city is missing.
UNKNOWN_CITY = "Unknown"


def line_amount(quantity: Column, unit_price: Column) -> Column:
    """Line amount rounded per row to two decimals (half away from zero)."""
    return (quantity * unit_price).cast(AMOUNT)


def calendar_key(d: Column) -> Column:
    """Smart date key yyyymmdd as an int."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def or_unknown(c: Column, default: str = UNKNOWN_CITY) -> Column:
    return F.coalesce(c, F.lit(default))


def any_null(cols: list[str]) -> Column:
    """True when any of ``cols`` is NULL (an OR-chain of IS NULL tests)."""
    return reduce(or_, [F.col(c).isNull() for c in cols])


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den in double precision; 0 when the divisor is 0 or NULL."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def to_total(c: Column) -> Column:
    """A sum of money at the width used for totals, 0 when there were no rows."""
    return F.coalesce(c, F.lit(0)).cast(TOTAL)


def abs_diff(a: Column, b: Column) -> Column:
    """|a - b| that stays defined when either side is NULL (empty table)."""
    return F.abs(F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))
