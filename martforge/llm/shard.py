"""Global shuffle into shards by a two-pass external shuffle.

Pass 1 scatters the rows by a seeded hash of (id, text) into buckets that fit in memory; pass 2 reads one bucket at a
time, permutes it by Fisher-Yates from a seed of its own and writes it. The buckets one after the other are a random
order of the whole table, and shards are its equal slices: row counts differ by one at most. Where a bucket's rows
end up follows from the counts of the buckets before it, which a narrow scan finds beforehand, so texts are shuffled
once and written once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm import python_tasks
from martforge.llm.rounds import near
from martforge.session import materialize


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A uniform permutation of 0 to n - 1."""
    order = list(range(n))
    if n > 1:
        draws = np.random.Generator(np.random.PCG64(seed)).integers(0, np.arange(n, 1, -1)).tolist()
        for i, j in zip(range(n - 1, 0, -1), draws):
            order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def _permuting(shards: int, seed: int):
    def task(bucket: pa.Table) -> pa.Table:
        first, total = bucket.column("offset")[0].as_py(), bucket.column("total")[0].as_py()
        # a fixed order first, whatever order the rows came in
        bucket = bucket.take(pc.sort_indices(bucket, [("key", "ascending"), ("copy", "ascending")]))
        order = fisher_yates(len(bucket), [seed, bucket.column("bucket")[0].as_py()])
        place = first + np.arange(len(bucket), dtype=np.int64)
        shard = place * shards // total
        slot = place - -(-shard * total // shards)
        rows = bucket.column("row").combine_chunks().take(pa.array(order))
        out = pa.Table.from_arrays(rows.flatten(), names=[f.name for f in rows.type])
        return out.append_column("shard", pa.array(shard, pa.int32())).append_column("slot", pa.array(slot))

    return task


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows (key, row) with the number of the copy of their key, from 0: counted in each partition of the input, after
    the copies in those before."""
    rows = materialize(rows.withColumn("at", F.monotonically_increasing_id()), "shard-copies")
    part = F.shiftright("at", 33)
    here = F.row_number().over(Window.partitionBy("key", "part").orderBy("at"))
    counts = rows.groupBy("key", part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("key", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return (rows.withColumn("part", part).withColumn("here", here).join(counts, ["key", "part"])
            .select("key", "row", (F.col("before") + F.col("here") - 1).alias("copy")))


def shuffle_into_shards(docs: DataFrame, path: str, shards: int = 8, seed: int = 20260, bucket_bytes: int = 24 << 20,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes ``docs`` in random order to ``path``/shard=0 .. as Parquet and returns what it reads back.

    All columns are kept, whatever their names; ``shard`` and ``slot`` (the row's place in its shard, gapless from 0) are
    added, or replace older ones. Shard sizes differ by one row at most. The order of (id, text) follows from the seed
    and the (id, text) of all rows, not from how they are partitioned.

    Nulls count as values of their own and as texts of no bytes. Equal texts scatter by their ids. Rows that repeat id
    and text share a bucket; where such copies overfill one, they are numbered and scattered by their number, and no
    other row's bucket changes. An empty table writes an empty folder's schema and gives no rows.
    """
    if shards < 1:
        raise ValueError("at least one shard is asked for")
    spark = python_tasks(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 64
    total = docs.agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    buckets = max(1, -(-(total["bytes"] or 0) // bucket_bytes))
    # the table's own columns inside one struct: no name can clash
    placed = docs.select(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("key"), size.alias("size"),
                         F.struct(*names).alias("row"))
    bucket = F.pmod(F.xxhash64("key", "copy"), F.lit(buckets)).alias("bucket")
    first = F.lit(0).cast("long").alias("copy")
    sizes = placed.select("key", "size", first).groupBy(bucket).agg(F.sum("size").alias("bytes"))
    overfull = sizes.filter(F.col("bytes") > 4 * bucket_bytes).select("bucket")
    # a key of more than a bucket's bytes: fewer than there are buckets
    hot = (placed.select("key", "size", first).withColumn("bucket", bucket).join(near(overfull, buckets), "bucket", "left_semi")
           .groupBy("key").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > bucket_bytes).select("key"))
    hot = materialize(hot, "shard-hot")
    rows = placed.select("key", "row", first)
    if not hot.isEmpty():
        copies = _numbered(placed.join(near(hot, buckets), "key", "left_semi").select("key", "row"))
        rows = rows.join(near(hot, buckets), "key", "left_anti").unionByName(copies)
    counts = materialize(rows.select(bucket).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "shard-buckets")
    # one row a bucket, in one task: a hundred thousand rows for terabytes
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
                            F.lit(total["rows"]).alias("total"))
    schema = docs.select(*names).schema.add("shard", "integer").add("slot", "long")
    out = (rows.withColumn("bucket", bucket).join(near(offsets, buckets), "bucket").groupBy("bucket")
           .applyInArrow(_permuting(shards, seed), schema))
    out.write.mode("errorifexists").partitionBy("shard").parquet(path)
    return spark.read.schema(schema).parquet(path) if total["rows"] else spark.createDataFrame([], schema)
