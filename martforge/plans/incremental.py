"""Incremental loading by a watermark, customer history (slowly changing dimension, type 2), and the fact against it.

Orders that come late, and lines added to loaded orders, lie before a watermark: ``load_orders`` does not see them.
``maintain`` takes them in.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions.expr import to_total
from martforge.operators.asof import last_before
from martforge.operators.dedupe import first_per_key
from martforge.operators.joins import sized_broadcast
from martforge.operators.keys import dense_key
from martforge.plans.dims import CUSTOMER_PRECEDENCE
from martforge.plans.facts import build_fact_sales
from martforge.schemas import DIM_CUSTOMER, FACT_SALES, columns
from martforge.session import materialize

#: Start of the first version of a customer.
BEGINNING = datetime.date(1900, 1, 1)


def load_orders(fact: DataFrame | None, stg_orders: DataFrame, stg_order_items: DataFrame, dim_customer: DataFrame,
                dim_product: DataFrame, dim_date: DataFrame, after: datetime.date | None = None,
                upto: datetime.date | None = None) -> DataFrame:
    """Rows to append to ``fact``: the lines of orders dated after ``after`` and not after ``upto``.

    The watermark filters orders in the scan; lines meet only those. Keys go on from the largest one of ``fact``
    (None: from 1), so what is loaded already keeps its keys and is not read but for that. Loading in steps gives
    the rows of one full load, with other keys. Orders without a date are in the first load only (``after`` None).
    Rows dated up to the watermark that were staged after it was set are not loaded (see ``maintain``).
    """
    orders = stg_orders
    if after is not None:
        orders = orders.where(F.col("order_date") > F.lit(after))
    if upto is not None:
        known = F.col("order_date") <= F.lit(upto)
        orders = orders.where(known if after is not None else known | F.col("order_date").isNull())
    new = build_fact_sales(stg_order_items, orders, dim_customer, dim_product, dim_date)
    last = fact.agg(F.max("sales_key")).first()[0] if fact is not None else None
    return new.withColumn("sales_key", F.col("sales_key") + F.lit(last or 0)).select(*columns(FACT_SALES))


def watermark(fact: DataFrame, dim_date: DataFrame) -> datetime.date | None:
    """Last order date that ``fact`` holds."""
    last = fact.agg(F.max("date_key").alias("date_key"))
    return dim_date.join(F.broadcast(last), "date_key").agg(F.max("full_date")).first()[0]


def customer_history(history: DataFrame | None, stg_customers: DataFrame, day: datetime.date) -> DataFrame:
    """Type 2 history after a snapshot of all customers: one row per version, no surrogate key.

    A customer whose attributes differ from its current version (nulls compare as values) gets a new version from
    ``day`` on, and the old one ends there; one that the snapshot lacks ends without a successor; others stay.
    Without a history every customer starts at ``BEGINNING``. Copies of a customer count as the first of them. A version
    that began on ``day`` itself (or after it) is corrected in place, or dropped if the customer is gone: a second
    snapshot of a day leaves no empty intervals, and the same one again changes nothing.
    One join by customer; ended versions are passed through.
    """
    attributes = [c for c in columns(DIM_CUSTOMER) if c not in ("customer_key", "customer_id")]
    now = first_per_key(stg_customers, ["customer_id"], CUSTOMER_PRECEDENCE)
    now = now.withColumn("city", F.coalesce("city", F.lit("Unknown"))).select("customer_id", *attributes)
    dates = lambda start, end: [start.cast("date").alias("start_date"), end.cast("date").alias("end_date"),
                                end.isNull().alias("is_current")]
    if history is None:
        return now.select("*", *dates(F.lit(BEGINNING), F.lit(None)))
    old, new = F.struct(*[F.col(f"h.{c}") for c in attributes]), F.struct(*[F.col(f"n.{c}") for c in attributes])
    both = history.where("is_current").alias("h").join(now.alias("n"), F.col("h.customer_id") == F.col("n.customer_id"), "full")
    gone, came = F.col("n.customer_id").isNull(), F.col("h.customer_id").isNull()
    changed = ~gone & ~came & ~old.eqNullSafe(new)
    row = lambda side, start, end: F.struct(F.col(f"{side}.customer_id").alias("customer_id"),
                                            *[F.col(f"{side}.{c}").alias(c) for c in attributes], *dates(start, end))
    anew = (gone | changed) & (F.col("h.start_date") >= F.lit(day))  # nothing of the version is left before the day
    before = F.when(~came & ~anew, row("h", F.col("h.start_date"), F.when(gone | changed, F.lit(day)).otherwise(F.lit(None))))
    after = F.when(came | changed, row("n", F.when(changed & anew, F.col("h.start_date")).otherwise(F.lit(day)), F.lit(None)))
    versions = both.select(F.explode(F.array_compact(F.array(before, after))).alias("v")).select("v.*")
    return versions.unionByName(history.where("not is_current").select(*versions.columns))


def customer_versions(history: DataFrame) -> DataFrame:
    """``history`` with the dense key ``customer_version_key`` 1..N by customer and start."""
    return dense_key(history, ["customer_id", "start_date"], "customer_version_key")


def fact_versions(fact: DataFrame, dim_customer: DataFrame, dim_date: DataFrame, versions: DataFrame) -> DataFrame:
    """``fact`` with ``customer_version_key``: the customer's version that was valid on the order's day.

    Null where the history has none for that day (the customer was not in the snapshots then). Each customer's days are
    looked up once, by an as-of join that splits hot customers; then lines meet them by (customer_key, date_key).
    """
    customers = sized_broadcast(dim_customer.select("customer_key", "customer_id"), size_of=dim_customer)
    days = sized_broadcast(dim_date.select("date_key", "full_date"), size_of=dim_date)
    asked = fact.select("customer_key", "date_key").distinct().join(customers, "customer_key").join(days, "date_key")
    found = last_before(asked, versions, "customer_id", "full_date", "start_date", ["customer_version_key", "end_date"])
    valid = F.col("end_date").isNull() | (F.col("full_date") < F.col("end_date"))
    found = materialize(found.select("customer_key", "date_key", F.when(valid, F.col("customer_version_key")).alias(
        "customer_version_key")), "fact-versions")
    return fact.join(sized_broadcast(found, size_of=found), ["customer_key", "date_key"], "left").select(
        *fact.columns, "customer_version_key")


def revenue_by_city_then(fact: DataFrame, versions: DataFrame) -> DataFrame:
    """Sales by the city that customers lived in on the day of the order (``fact`` of ``fact_versions``)."""
    per = fact.groupBy("customer_version_key").agg(F.sum("sales_amount").alias("sales"), F.sum("quantity").alias("quantity"))
    cities = sized_broadcast(versions.select("customer_version_key", "city"), size_of=versions)
    return (per.join(cities, "customer_version_key", "left").groupBy("city")
            .agg(to_total(F.sum("sales")).alias("total_sales"), F.sum("quantity").cast("bigint").alias("total_quantity")))
