"""As-of join: each event with the last version of its key that began at or before it.

Events and versions are united and sorted by (key, time) over range partitions, and the last version seen is carried
along. No interval condition is joined, so nothing multiplies; and the ranges split on time within a key (and on a hash
within a time), so a key that holds a third of all events is spread over as many tasks as its rows fill. What a key's
rows inherit across a partition border is one row per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.operators.keys import partitions_for
from martforge.session import materialize


def last_before(events: DataFrame, versions: DataFrame, key: str, event_time: str, version_time: str,
                values: list[str], num_partitions: int | None = None) -> DataFrame:
    """``events`` with the columns ``values`` of the last of the ``versions`` of ``key`` with version_time <= event_time.

    Columns are null where there is none, also for null keys and null times. A version that begins at the time of an
    event is valid for it; of several that begin together the one of the largest ``values`` counts. ``events`` must
    not have columns named as ``values``; its other columns are kept, whatever their names.
    """
    clash = set(values) & set(events.columns)
    if clash:
        raise ValueError(f"events already have {', '.join(sorted(clash))}")
    value, event = F.struct(*values), F.struct(*events.columns)
    begun = versions.where(F.col(key).isNotNull() & F.col(version_time).isNotNull())
    begun = begun.select(F.col(key).alias("k"), F.col(version_time).alias("t"), F.lit(0).alias("kind"), value.alias("v"))
    asked = events.select(F.col(key).alias("k"), F.col(event_time).alias("t"), F.lit(1).alias("kind"), event.alias("e"))
    both = materialize(begun.unionByName(asked, allowMissingColumns=True).withColumn("tie", F.xxhash64("e")), "asof-input")
    order = [F.col(c).asc_nulls_last() for c in ("k", "t", "kind", "v", "tie")]
    parts = num_partitions or partitions_for(both.sparkSession, both.count())
    tagged = (both.repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .withColumn("row", F.monotonically_increasing_id()))
    tagged = materialize(tagged, "asof-sorted").withColumn("part", F.shiftright("row", 33))

    # Per partition its first and last key and the last version of that last key: one row each, safe to broadcast.
    ends = tagged.groupBy("part").agg(F.min_by("k", "row").alias("first_key"), F.max_by("k", "row").alias("last_key"))
    of_last = (tagged.where("kind = 0").join(F.broadcast(ends.select("part", F.col("last_key").alias("k"))), ["part", "k"])
               .groupBy("part").agg(F.max_by("v", "row").alias("v")))
    borders = ends.join(of_last, "part", "left")
    seen = Window.partitionBy("last_key").orderBy("part")
    before = Window.orderBy("part")
    carry = (borders.withColumn("v", F.last("v", ignorenulls=True).over(seen))
             .withColumn("same", F.lag("last_key").over(before) == F.col("first_key"))
             .withColumn("carried", F.lag("v").over(before))
             .where("same").select("part", F.col("first_key").alias("k"), "carried"))

    running = F.last("v", ignorenulls=True).over(
        Window.partitionBy("part", "k").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = (tagged.withColumn("v", running).where("kind = 1").join(F.broadcast(carry), ["part", "k"], "left")
             .withColumn("v", F.when(F.col("k").isNotNull() & F.col("t").isNotNull(), F.coalesce("v", "carried"))))
    return found.select("e.*", *[F.col("v")[c].alias(c) for c in values])
