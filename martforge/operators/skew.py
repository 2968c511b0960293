"""Joins whose left side has a few keys that hold much of it.

Spark's skew join splits such a partition after the shuffle, and only where the join type and what follows allow it. Here
heavy keys are found first, by a mergeable counting sketch in one pass over the key column, and their rows never meet in
one partition: they are joined where they lie with a broadcast of the few right rows of these keys, all other rows by the
usual join.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.operators.joins import sized_broadcast
from martforge.session import materialize

#: Keys that the sketch tracks: a key's count is off by less than 4 in so many rows.
TRACKED = 10_000


def heavy_keys(df: DataFrame, key: str, share: float | None = None) -> list:
    """The values of ``key`` (nulls left out) that hold at least ``share`` of the rows, at most 1 / share of them.

    By default half of what a shuffle partition has on average.
    """
    share = share or 1 / (2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    most = math.ceil(1 / share)
    if not 0 < share <= 1 or most > TRACKED // 10:
        raise ValueError(f"a share of {10 / TRACKED} to 1 is asked for")
    found = df.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key}`, {most}, {TRACKED})").alias("top")).first()
    return sorted(r["item"] for r in found["top"] or [] if r["item"] is not None and r["count"] >= share * found["n"])


def split_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner", heavy: list | None = None) -> DataFrame:
    """``left.join(right, on, how)`` (inner or left) without a hot partition; ``heavy`` are the left side's heavy keys
    (found here if not given).

    Right rows of heavy keys are broadcast if they are few (the library's broadcast limit); a key heavy on both sides is
    left to the engine. Rows, columns and nulls are those of the plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how is 'inner' or 'left', not {how!r}")
    heavy = heavy_keys(left, on) if heavy is None else heavy
    if not heavy:
        return left.join(right, on, how)
    is_heavy = F.coalesce(F.col(on).isin(heavy), F.lit(False))
    few = materialize(right.where(is_heavy), "heavy-lookup")
    hot = left.where(is_heavy).join(sized_broadcast(few), on, how)
    return left.where(~is_heavy).join(right.where(~is_heavy), on, how).unionByName(hot)
