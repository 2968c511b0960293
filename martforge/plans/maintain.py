"""A fact table that follows its source: late and changed orders replace only the order ranges that they touch.

Layout under a root folder:

    fact/order_range=<r>/       rows of the orders with id in [r * width, (r + 1) * width), with their place in it
    manifest/order_range=<r>/   per order: how many lines it has and a hash of what the fact takes from it
    landed/                     what the stream received, by batch and order range

The place counts from 1 in the fact's key order. The dense key of a full build is that place plus the rows of all ranges
before, which is one number per range: replacing a range moves the keys of later ones without rewriting them. So the
table read back equals a full build, keys included, whatever came in whichever order.

A range is replaced by dynamic partition overwrite; a marker row (place 0, no order) stands in every range that was ever
written, so that a range left without rows is overwritten too. Fact first, manifest second: a run that ends between the
two finds the same differences again and replaces the same ranges by the same rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from martforge.operators.joins import sized_broadcast
from martforge.operators.sizing import sized_shuffles
from martforge.plans.facts import FACT_KEY_ORDER, fact_rows, order_keys
from martforge.plans.publish import write_once
from martforge.schemas import FACT_SALES, STG_ORDER_ITEMS, STG_ORDERS, columns
from martforge.session import materialize

RANGE = "order_range"
#: Order ids per range: some four million lines, one file of about 100 MB.
WIDTH = 1_000_000
_ROW = [c for c in columns(FACT_SALES) if c != "sales_key"]


class MaintainedFact:
    """The maintained table under ``root``; ``width`` is fixed when the table is made."""

    def __init__(self, spark: SparkSession, root: str, width: int = WIDTH):
        self.spark, self.root = spark, root.rstrip("/")
        if width < 1:
            raise ValueError("a range holds one order id at least")
        path = f"{self.root}/layout.json"
        write_once(spark, path, json.dumps({"width": width}) + "\n")
        self.width = spark.read.schema("width long").json(path).first()["width"]

    # -- reading ------------------------------------------------------------------------------------------------

    def _read(self, part: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(f"{schema}, {RANGE} long").parquet(f"{self.root}/{part}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{schema}, {RANGE} long")

    def _stored(self) -> DataFrame:
        types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FACT_SALES.fields if f.name != "sales_key")
        return self._read("fact", f"{types}, place long")

    def read(self) -> DataFrame:
        """The fact with dense keys 1..N."""
        stored = self._stored()
        sizes = stored.groupBy(RANGE).agg(F.max("place").alias("n"))
        # one row per range
        before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select(RANGE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
        return (stored.where("place > 0").join(sized_broadcast(offsets, size_of=sizes), RANGE)
                .withColumn("sales_key", F.col("offset") + F.col("place")).select(*columns(FACT_SALES)))

    def manifest(self) -> DataFrame:
        """``order_id, n_lines, content`` of every order that the fact has."""
        return self._read("manifest", "order_id long, n_lines long, content decimal(38,0)").where("order_id is not null")

    # -- writing ------------------------------------------------------------------------------------------------

    def _range(self, order_id: str = "order_id"):
        return F.floor(F.col(order_id) / F.lit(self.width)).cast("long").alias(RANGE)

    def contents(self, lines: DataFrame, orders: DataFrame, dims: list[DataFrame]) -> DataFrame:
        """The manifest that staged tables ask for: what the star join would take from each order, hashed.

        Lines and headers are combined per order before they meet (map-side first), with the keys that they get from
        the dimensions, so a moved dimension key changes the orders that use it.
        """
        dim_customer, dim_product, dim_date = dims
        product = sized_broadcast(dim_product.select("product_id", "product_key"), size_of=dim_product)
        total = lambda *c: F.sum(F.xxhash64(*c).cast("decimal(38,0)"))
        taken = (lines.where(F.col("quantity") > 0).join(product, "product_id").groupBy("order_id")
                 .agg(F.count(F.lit(1)).alias("n"), total("product_id", "product_key", "quantity", "unit_price").alias("h")))
        heads = (order_keys(orders, dim_customer, dim_date).groupBy("order_id")
                 .agg(F.count(F.lit(1)).alias("heads"), total("customer_key", "date_key").alias("head")))
        return taken.join(heads, "order_id").select(
            "order_id", (F.col("n") * F.col("heads")).alias("n_lines"),
            F.xxhash64("n", "h", "heads", "head").cast("decimal(38,0)").alias("content"))

    def refresh(self, lines: DataFrame, orders: DataFrame, dims: list[DataFrame]) -> DataFrame:
        """Make the fact what a full build of these staged tables would be; returns the ranges replaced (one row each).

        ``dims`` are dim_customer, dim_product and dim_date. Orders that came late, lost or gained lines, changed in
        any value that the fact has, or went away are found by comparing the manifests; all other ranges are neither
        read nor written. Shuffles are sized by the lines (counted first; cheap where they are stored).
        """
        with sized_shuffles(self.spark, lines.count()):
            wanted = materialize(self.contents(lines, orders, dims), "order-contents")
            old = self.manifest().select("order_id", F.col("n_lines").alias("old_n"), F.col("content").alias("old"))
            same = F.col("content").eqNullSafe(F.col("old")) & F.col("n_lines").eqNullSafe(F.col("old_n"))
            changed = wanted.join(old, "order_id", "full").where(~same)
            ranges = materialize(changed.select(self._range()).distinct(), "order-ranges")
            self.replace(ranges, lines, orders, dims, wanted)
        return ranges

    def replace(self, ranges: DataFrame, lines: DataFrame, orders: DataFrame, dims: list[DataFrame],
                contents: DataFrame | None = None) -> None:
        """Replace the given ranges by what the staged tables have for them; tables may hold more than those."""
        if ranges.isEmpty():
            return
        these = lambda table: (table.withColumn(RANGE, self._range())
                               .join(sized_broadcast(ranges, size_of=ranges), RANGE, "left_semi"))
        lines, orders = these(lines), these(orders)
        rows = fact_rows(lines, orders, *dims).withColumn(RANGE, self._range()).withColumn("row", F.lit(1))
        # The marker is first in its range, so counting from 0 gives it place 0; rows are dealt out and sorted once.
        both = rows.unionByName(ranges.select(RANGE, F.lit(0).alias("row")), allowMissingColumns=True)
        order = [F.col("row"), *[F.col(c).asc_nulls_last() for c in FACT_KEY_ORDER]]
        place = F.row_number().over(Window.partitionBy(RANGE).orderBy(*order)) - 1
        self._overwrite(both.withColumn("place", place.cast("long")).select(RANGE, "place", *_ROW), "fact")
        contents = self.contents(lines, orders, dims) if contents is None else these(contents)
        entries = contents.select(self._range(), "order_id", "n_lines", "content")
        self._overwrite(entries.unionByName(ranges.select(RANGE), allowMissingColumns=True)
                        .repartition(RANGE).sortWithinPartitions(RANGE, "order_id"), "manifest")

    def _overwrite(self, rows: DataFrame, part: str) -> None:
        """Replace the ranges of ``rows``, of which each is in one task, sorted."""
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RANGE)
         .parquet(f"{self.root}/{part}"))

    # -- streaming ----------------------------------------------------------------------------------------------

    def _land(self, rows: DataFrame, table: str, batch: int) -> None:
        """What a batch brought, under its number: a batch that is run again lands in the same place."""
        (rows.withColumn(RANGE, self._range()).repartition(RANGE).write.mode("overwrite").partitionBy(RANGE)
         .parquet(f"{self.root}/landed/{table}/batch={batch}"))

    def _landed(self, table: str, schema) -> DataFrame:
        types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        return self._read(f"landed/{table}", f"{types}, batch long")

    def load_batch(self, orders: DataFrame, lines: DataFrame, batch: int, dims: list[DataFrame]) -> None:
        """Take in one batch of order headers and lines, and bring the ranges it touches up to date.

        Lines add to those of earlier batches. A header that comes again replaces the one before (the last batch
        counts). Lines may come before their header, or long after it. Running a batch twice changes nothing.
        """
        self._land(orders.select(*columns(STG_ORDERS)), "orders", batch)
        self._land(lines.select(*columns(STG_ORDER_ITEMS)), "order_items", batch)
        heads, items = self._landed("orders", STG_ORDERS), self._landed("order_items", STG_ORDER_ITEMS)
        here = lambda t: t.where((F.col("batch") == batch) & F.col(RANGE).isNotNull()).select(RANGE)
        ranges = materialize(here(heads).unionByName(here(items)).distinct(), "batch-ranges")
        if ranges.isEmpty():
            return
        touched = lambda t: t.join(sized_broadcast(ranges, size_of=ranges), RANGE, "left_semi")
        last = F.max("batch").over(Window.partitionBy("order_id"))
        heads = touched(heads).withColumn("last", last).where("batch = last")
        self.replace(ranges, touched(items).select(*columns(STG_ORDER_ITEMS)), heads.select(*columns(STG_ORDERS)), dims)

    def follow(self, landing: str, dims: Callable[[], list[DataFrame]], checkpoint: str, files_per_batch: int = 100) -> None:
        """Take in what is new under ``landing``/orders and ``landing``/order_items (Parquet), then return.

        A structured stream over both folders with ``availableNow``: the checkpoint remembers which files belong to
        which batch, so after a loss the unfinished batch is run again with the same files under the same number.
        ``dims`` is asked for the dimensions once per batch.
        """
        source = lambda table, schema: (self.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
                                        .parquet(f"{landing}/{table}"))
        heads = source("orders", STG_ORDERS).select(F.struct(*columns(STG_ORDERS)).alias("head"))
        items = source("order_items", STG_ORDER_ITEMS).select(F.struct(*columns(STG_ORDER_ITEMS)).alias("item"))

        def take(rows: DataFrame, batch: int) -> None:
            rows = materialize(rows, "batch")  # read once, whatever is asked of it
            self.load_batch(rows.where("head is not null").select("head.*"), rows.where("item is not null").select("item.*"),
                            batch, dims())

        query = (heads.unionByName(items, allowMissingColumns=True).writeStream.foreachBatch(take)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
