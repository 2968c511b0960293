"""Deterministic de-duplication: keep the first row per natural key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key_cols: list[str], order_cols: list[str]) -> DataFrame:
    """One row per ``key_cols``: the first by ``order_cols`` ascending, NULLs last.

    Same result as ``row_number() OVER (PARTITION BY key ORDER BY ... NULLS
    LAST) = 1``, expressed as ``min`` over a struct so that the aggregation is
    partial (map-side): a key repeated on a third of all rows is reduced to
    one row per task before the shuffle, instead of landing in one window
    partition. Each order column is preceded by its IS NULL flag
    (false < true), which puts NULLs last; the remaining columns break
    remaining ties, so equal structs are equal rows.
    """
    rest = [c for c in df.columns if c not in key_cols and c not in order_cols]
    fields = []
    for i, c in enumerate(order_cols):
        fields.append(F.col(c).isNull().alias(f"n{i}"))
        fields.append(F.col(c).alias(f"v{i}"))
    for j, c in enumerate(rest):
        fields.append(F.col(c).isNull().alias(f"rn{j}"))
        fields.append(F.col(c).alias(f"rv{j}"))
    picked = df.groupBy(*key_cols).agg(F.min(F.struct(*fields)).alias("_first"))
    out = [F.col(k) for k in key_cols]
    out += [F.col(f"_first.v{i}").alias(c) for i, c in enumerate(order_cols)]
    out += [F.col(f"_first.rv{j}").alias(c) for j, c in enumerate(rest)]
    return picked.select(*out).select(*df.columns)
