"""Contiguous calendar: one row per day between two bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions.expr import calendar_key, day_name, month_name


def day_series(bounds: DataFrame, lo: str, hi: str, name: str = "full_date") -> DataFrame:
    """Every day from ``lo`` to ``hi`` of each bounds row; NULL bounds give no rows.

    ``bounds`` is a global aggregate (one row), so the explode runs in one
    task; its output is bounded by the number of days in the range.
    """
    return bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi), F.expr("INTERVAL 1 DAY"))).alias(name))


def calendar_attributes(days: DataFrame, d: str = "full_date") -> DataFrame:
    c = F.col(d)
    return days.select(
        calendar_key(c).alias("date_key"),
        c.alias("full_date"),
        F.year(c).alias("year"),
        F.quarter(c).alias("quarter"),
        F.month(c).alias("month"),
        month_name(c).alias("month_name"),
        F.weekofyear(c).alias("week"),
        F.dayofmonth(c).alias("day"),
        day_name(c).alias("day_name"),
    )
