"""Join helpers: size-checked broadcast and orphan (anti-join) detection."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest lookup side (rows) broadcast on purpose. Lookup sides are projected
# to a couple of fixed-width columns, so this is ~64 MB of key pairs.
BROADCAST_MAX_ROWS_CONF = "martforge.broadcast.maxRows"
BROADCAST_MAX_ROWS = 2_000_000


def broadcast_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(BROADCAST_MAX_ROWS_CONF, str(BROADCAST_MAX_ROWS)))


_ROWS: "weakref.WeakKeyDictionary[DataFrame, int]" = weakref.WeakKeyDictionary()


def row_count(df: DataFrame) -> int:
    """Row count of ``df``, remembered for the DataFrame object (tables of a
    published version are immutable, and their DataFrames are reused)."""
    if df not in _ROWS:
        _ROWS[df] = df.count()
    return _ROWS[df]


def prefetch_row_counts(frames: list[DataFrame]) -> None:
    """Count several frames in ONE job (a union of one-row aggregates)."""
    todo = [f for f in dict.fromkeys(frames) if f not in _ROWS]
    if not todo:
        return
    parts = [f.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("i"), "n") for i, f in enumerate(todo)]
    u = parts[0]
    for p in parts[1:]:
        u = u.union(p)
    for r in u.collect():
        _ROWS[todo[r["i"]]] = r["n"]


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as the lookup side of a join that Spark must not broadcast by its own estimate.

    That estimate is a share of the files' compressed bytes: 8 MB for 7.2 million keys with prices, which the driver would
    collect and hash in hundreds of MB.
    """
    return df.hint("merge")


def sized_broadcast(df: DataFrame, max_rows: int | None = None, size_of: DataFrame | None = None) -> DataFrame:
    """``broadcast(df)`` when its row count is within the limit, else a shuffle join.

    ``size_of``: the table ``df`` projects (same rows), whose remembered count
    can be reused.

    The count is an action; call it on materialised (parquet) lookup tables,
    where it is answered from file footers. Past the limit both sides are
    shuffled (AQE splits hot keys), whatever Spark would estimate.
    """
    return F.broadcast(df) if fits_broadcast(df if size_of is None else size_of, max_rows) else shuffled(df)


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    limit = broadcast_limit(df) if max_rows is None else max_rows
    return row_count(df) <= limit


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Rows of ``child`` whose key has no match in ``parent``.

    Same rows as ``child LEFT JOIN parent ... WHERE parent.key IS NULL``,
    written as a left anti join (NULL child keys are orphans too). Only the
    parent key column is read.
    """
    pk = parent_key or child_key
    keys = parent.select(F.col(pk).alias("_mf_pk"))
    return child.join(keys, F.col(child_key) == F.col("_mf_pk"), "left_anti")


def count_rows(df: DataFrame, alias: str = "actual") -> DataFrame:
    """One-row global count, kept as an aggregate (not an action)."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias(alias))


def duplicate_keys(df: DataFrame, key_cols: list[str], alias: str = "actual", unlike: bool = False) -> DataFrame:
    """Number of key values held by more than one row (NULL is one value).

    ``unlike``: nearly all keys differ, as surrogate keys do. Counting them before the shuffle would fill the memory of
    each task and spill without making rows fewer, so the keys are dealt out first.
    """
    if unlike:
        df = df.select(*key_cols).repartition(*key_cols)
    dup = df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return count_rows(dup, alias)


def with_match(child: DataFrame, parent: DataFrame, child_key: str, flag: str,
               parent_key: str | None = None) -> DataFrame:
    """``child`` plus boolean ``flag``: does its key exist in ``parent``?

    A left join against the parent's DISTINCT keys, so child rows never fan
    out; NULL child keys get False. Several flags on one child let every
    orphan check of that table share a single scan of it.
    """
    pk = parent_key or child_key
    alias = f"_mf_k_{flag}"
    keys = parent.select(F.col(pk).alias(alias)).distinct().withColumn(flag, F.lit(True))
    # Decided before planning, so the child is not shuffled for a join
    # that AQE would only later turn into a broadcast.
    keys = sized_broadcast(keys, size_of=parent)
    joined = child.join(keys, F.col(child_key) == F.col(alias), "left").drop(alias)
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
