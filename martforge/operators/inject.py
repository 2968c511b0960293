"""Deterministic anomaly injection: flag rows by key arithmetic, not by random draws.

Used to derive a dirty staging layer from clean relational tables, so every
data-quality check has something to find at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPY_NO = "_mf_copy"


def append_copies(df: DataFrame, predicate: Column) -> DataFrame:
    """Emit every row once, and a second time where ``predicate`` holds.

    Adds ``_mf_copy`` (0 = original, 1 = copy) so later columns can differ
    between the two. Done with a generator in one scan rather than a union of
    two scans of the same input.
    """
    copies = F.when(predicate, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn(COPY_NO, F.explode(copies))


def null_where(value: Column, predicate: Column) -> Column:
    return F.when(predicate, F.lit(None)).otherwise(value)


def replace_where(value: Column, predicate: Column, replacement) -> Column:
    return F.when(predicate, F.lit(replacement)).otherwise(value)
