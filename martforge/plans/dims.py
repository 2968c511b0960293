"""Dimension builders: customer (deduplicated), product, calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions.expr import or_unknown
from martforge.operators.calendar import calendar_attributes, day_series
from martforge.operators.dedupe import first_per_key
from martforge.operators.keys import dense_key
from martforge.schemas import DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, columns

# Order that decides which copy of a duplicated customer survives.
CUSTOMER_PRECEDENCE = ["signup_date", "customer_name", "city", "state", "country"]


def build_dim_customer(stg_customers: DataFrame) -> DataFrame:
    """First row per customer_id (NULLs last), missing city -> 'Unknown', dense key by id."""
    first = first_per_key(stg_customers, ["customer_id"], CUSTOMER_PRECEDENCE)
    shaped = first.withColumn("city", or_unknown(F.col("city")))
    return dense_key(shaped, ["customer_id"], "customer_key").select(*columns(DIM_CUSTOMER))


def build_dim_product(stg_products: DataFrame) -> DataFrame:
    """Products pass through (NULL prices kept, no de-duplication), dense key by id.

    The key order continues over every column so that duplicated ids, which the
    uniqueness gate reports, still receive reproducible keys.
    """
    order = ["product_id", "product_name", "category", "price"]
    return dense_key(stg_products, order, "product_key").select(*columns(DIM_PRODUCT))


def build_dim_date(stg_orders: DataFrame) -> DataFrame:
    """Every day from the first to the last order date of all staged orders."""
    bounds = stg_orders.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    return calendar_attributes(day_series(bounds, "lo", "hi")).select(*columns(DIM_DATE))
