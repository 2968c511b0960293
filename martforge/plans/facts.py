"""Sales fact: one row per valid order line, keyed against the dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions.expr import line_amount
from martforge.operators.joins import sized_broadcast
from martforge.operators.keys import dense_key
from martforge.operators.skew import split_join
from martforge.schemas import FACT_SALES, columns

# Surrogate-key order of the fact. Rows tying on all four are identical fact
# rows (every other column follows from order_id and product_id).
FACT_KEY_ORDER = ["order_id", "product_id", "quantity", "unit_price"]


def order_keys(stg_orders: DataFrame, dim_customer: DataFrame, dim_date: DataFrame,
               check_sizes: bool = True) -> DataFrame:
    """(order_id, customer_key, date_key) for orders with a known customer and day.

    Orders are a quarter of the lines, so the dimension lookups run on the
    order side before the large line-to-order join.
    """
    cust = dim_customer.select("customer_id", "customer_key")
    cal = dim_date.select(F.col("full_date").alias("order_date"), "date_key")
    if check_sizes:
        cust = sized_broadcast(cust, size_of=dim_customer)
        cal = sized_broadcast(cal, size_of=dim_date)
    return (stg_orders.select("order_id", "customer_id", "order_date")
            .join(cust, "customer_id")
            .join(cal, "order_date")
            .select("order_id", "customer_key", "date_key"))


def fact_rows(stg_order_items: DataFrame, stg_orders: DataFrame, dim_customer: DataFrame,
              dim_product: DataFrame, dim_date: DataFrame, check_sizes: bool = True,
              heavy_orders: list | None = None) -> DataFrame:
    """The fact without its key: inner star join of staged lines with quantity > 0; no status filter.

    A line is loaded once per matching order row, customer and product, as
    an inner join chain does. Lines of ``heavy_orders`` (order ids that hold
    much of all lines, see ``skew``) are joined without a shuffle.
    """
    lines = (stg_order_items.where(F.col("quantity") > 0)
             .select("order_id", "product_id", "quantity", "unit_price"))
    prod = dim_product.select("product_id", "product_key")
    if check_sizes:
        prod = sized_broadcast(prod, size_of=dim_product)
    keys = order_keys(stg_orders, dim_customer, dim_date, check_sizes)
    return (split_join(lines.join(prod, "product_id"), keys, "order_id", heavy=heavy_orders or [])
            .withColumn("sales_amount", line_amount(F.col("quantity"), F.col("unit_price"))))


def build_fact_sales(stg_order_items: DataFrame, stg_orders: DataFrame, dim_customer: DataFrame,
                     dim_product: DataFrame, dim_date: DataFrame, check_sizes: bool = True,
                     heavy_orders: list | None = None) -> DataFrame:
    """``fact_rows`` with dense keys 1..N in the order of ``FACT_KEY_ORDER``."""
    joined = fact_rows(stg_order_items, stg_orders, dim_customer, dim_product, dim_date, check_sizes, heavy_orders)
    return dense_key(joined, FACT_KEY_ORDER, "sales_key").select(*columns(FACT_SALES))
