"""Source-to-warehouse reconciliation.

The source side is recomputed from persisted staging and the dimensions with
its own join chain; the warehouse side re-reads the persisted fact. Nothing is
shared between the two, so agreement is evidence, not a tautology.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions.expr import line_amount, to_total
from martforge.operators.combine import side_by_side
from martforge.operators.joins import sized_broadcast
from martforge.operators.unpivot import unpivot_rows
from martforge.plans.staging import Staging
from martforge.schemas import TOTAL


def valid_source_lines(stg: Staging, dim_customer: DataFrame, dim_product: DataFrame,
                       dim_date: DataFrame) -> DataFrame:
    """Staged lines that qualify for the fact: the star join with quantity > 0.

    Customer and day are looked up for orders, of which there are fewer than
    lines, so that lines are shuffled for their order and product only.
    """
    items = stg.order_items.where(F.col("quantity") > 0).select("order_id", "product_id", "quantity", "unit_price")
    customers = sized_broadcast(dim_customer.select("customer_id"), size_of=dim_customer)
    days = sized_broadcast(dim_date.select(F.col("full_date").alias("order_date")), size_of=dim_date)
    products = sized_broadcast(dim_product.select("product_id"), size_of=dim_product)
    orders = (stg.orders.select("order_id", "customer_id", "order_date")
              .join(customers, "customer_id").join(days, "order_date").select("order_id"))
    return items.join(products, "product_id").join(orders, "order_id")


def source_totals(stg: Staging, dim_customer: DataFrame, dim_product: DataFrame,
                  dim_date: DataFrame) -> DataFrame:
    lines = valid_source_lines(stg, dim_customer, dim_product, dim_date)
    return lines.agg(
        F.count(F.lit(1)).cast("bigint").alias("source_valid_rows"),
        F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("source_total_quantity"),
        to_total(F.sum(line_amount(F.col("quantity"), F.col("unit_price")))).alias("source_total_sales"),
    )


def fact_totals(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).cast("bigint").alias("fact_rows"),
        F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("fact_total_quantity"),
        to_total(F.sum("sales_amount")).alias("fact_total_sales"),
    )


def recon_wide(source: DataFrame, fact: DataFrame) -> DataFrame:
    """One row: source and warehouse totals and their signed differences."""
    both = side_by_side([source, fact])
    return both.select(
        "source_valid_rows", "fact_rows",
        (F.col("source_valid_rows") - F.col("fact_rows")).cast("bigint").alias("row_difference"),
        "source_total_quantity", "fact_total_quantity",
        (F.col("source_total_quantity") - F.col("fact_total_quantity")).cast("bigint").alias("quantity_difference"),
        "source_total_sales", "fact_total_sales",
        (F.col("source_total_sales") - F.col("fact_total_sales")).cast(TOTAL).alias("sales_difference"),
    )


# Metric labels of the reconciliation display, in display order.
DISPLAY_METRICS = ("Rows", "Total Quantity", "Total Sales")


def recon_display(wide: DataFrame) -> DataFrame:
    """Unpivot the wide row into three (metric, source, warehouse, difference) rows."""
    rows = [
        (1, DISPLAY_METRICS[0], "@source_valid_rows", "@fact_rows", "@row_difference"),
        (2, DISPLAY_METRICS[1], "@source_total_quantity", "@fact_total_quantity", "@quantity_difference"),
        (3, DISPLAY_METRICS[2], "@source_total_sales", "@fact_total_sales", "@sales_difference"),
    ]
    cast = wide.select(
        *[F.col(c).cast(TOTAL).alias(c) for c in wide.columns])
    long = unpivot_rows(cast, rows, ["sort_order", "metric", "source_value", "warehouse_value", "difference"])
    return long.orderBy("sort_order").drop("sort_order")
