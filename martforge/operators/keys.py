"""Dense surrogate keys 1..N in a declared order, without a single-partition sort.

``row_number().over(Window.orderBy(...))`` moves every row into one task. Here
rows are range-partitioned on the full sort key (so even a hot leading value
is split across tasks), sorted inside each partition and tagged with
``monotonically_increasing_id`` (partition index in the upper 31 bits,
position in the lower 33). The tagged rows are materialised, because the tag
depends on the physical layout and must be read identically by both passes.
Per-partition row counts (one row per partition) give running offsets, which
are broadcast back: ``key = offset(partition) + position + 1``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.session import materialize

import math

_POS_BITS = 33
# Target rows per range partition of the key build, so that partitions stay
# within executor memory whatever the data volume.
ROWS_PER_PARTITION_CONF = "martforge.denseKey.rowsPerPartition"
ROWS_PER_PARTITION = 4_000_000
_ROW = "_mf_row"
_PART = "_mf_part"
_OFFSET = "_mf_offset"


def partitions_for(spark, rows: int) -> int:
    """Range partitions for so many rows: at least the shuffle partitions."""
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    per = int(spark.conf.get(ROWS_PER_PARTITION_CONF, str(ROWS_PER_PARTITION)))
    return max(base, math.ceil(rows / per))


def dense_key(df: DataFrame, order_cols: list[str], name: str,
              num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1..N following ``order_cols`` ascending, NULLs last.

    ``order_cols`` must order the rows totally, up to rows that are identical
    in the output; otherwise keys of tied rows are not reproducible.
    The input is stored first: drawing the range bounds and dealing the rows
    out both read it, and the joins that made it run once. Its row count, read
    from the files' footers, sizes the range partitions.
    """
    df = materialize(df, f"dense-key-{name}-input")
    n = num_partitions or partitions_for(df.sparkSession, df.count())
    order = [F.col(c).asc_nulls_last() for c in order_cols]
    tagged = (df.repartitionByRange(n, *order)
                .sortWithinPartitions(*order)
                .withColumn(_ROW, F.monotonically_increasing_id()))
    tagged = materialize(tagged, f"dense-key-{name}")
    part = F.shiftright(F.col(_ROW), _POS_BITS)
    pos = F.col(_ROW).bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    # One row per range partition: a proven bound, safe to broadcast.
    counts = tagged.groupBy(part.alias(_PART)).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(_OFFSET))
    keyed = (tagged.withColumn(_PART, part)
                   .join(F.broadcast(offsets), _PART)
                   .withColumn(name, F.col(_OFFSET) + pos + F.lit(1)))
    return keyed.drop(_ROW, _PART, _OFFSET)
