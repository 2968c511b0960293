"""Exclusion audit: why each staged order line is not in the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.operators.joins import sized_broadcast
from martforge.plans.staging import Staging

# Exclusion reasons, in precedence order (first = primary).
REASONS = ("null_quantity", "invalid_quantity", "orphan_product", "orphan_order",
           "orphan_customer", "no_calendar_date")


def _lookup(keys: DataFrame, dim: DataFrame) -> DataFrame:
    return sized_broadcast(keys, size_of=dim)


def order_status(stg: Staging, dim_customer: DataFrame, dim_date: DataFrame) -> DataFrame:
    """One row per staged order_id: can its lines reach the fact, and if not, why.

    Grouping by order_id makes the line-side join a lookup even when an
    order_id is staged twice (no fan-out in the audit).
    """
    cust = _lookup(dim_customer.select("customer_id").distinct().withColumn("_c", F.lit(True)), dim_customer)
    cal = _lookup(dim_date.select(F.col("full_date").alias("order_date")).distinct().withColumn("_d", F.lit(True)),
                  dim_date)
    o = (stg.orders.select("order_id", "customer_id", "order_date")
         .join(cust, "customer_id", "left")
         .join(cal, "order_date", "left"))
    c_ok = F.coalesce(F.col("_c"), F.lit(False))
    d_ok = F.coalesce(F.col("_d"), F.lit(False))
    return o.groupBy("order_id").agg(
        F.bool_or(c_ok & d_ok).alias("order_ok"),
        F.bool_or(c_ok).alias("customer_ok"),
        F.bool_or(d_ok).alias("date_ok"),
    )


def line_audit(stg: Staging, dim_customer: DataFrame, dim_product: DataFrame,
               dim_date: DataFrame) -> DataFrame:
    """Every staged line with ``reasons`` (comma list, precedence order, '' when loaded)
    and ``primary_reason`` (NULL when loaded)."""
    prod = _lookup(dim_product.select("product_id").distinct().withColumn("_p", F.lit(True)), dim_product)
    orders = order_status(stg, dim_customer, dim_date).withColumn("_o", F.lit(True))
    lines = (stg.order_items.select("order_id", "product_id", "quantity", "unit_price")
             .join(prod, "product_id", "left")
             .join(orders, "order_id", "left"))
    q = F.col("quantity")
    has_order = F.col("_o").isNotNull()
    bad_order = has_order & ~F.col("order_ok")
    flags = [
        q.isNull(),
        q <= 0,
        F.col("_p").isNull(),
        ~has_order,
        bad_order & (~F.col("customer_ok") | F.col("date_ok")),
        bad_order & ~F.col("date_ok"),
    ]
    reasons = F.concat_ws(",", *[F.when(f, F.lit(r)) for f, r in zip(flags, REASONS)])
    return lines.select(
        "order_id", "product_id", "quantity", "unit_price",
        reasons.alias("reasons"),
        F.when(reasons != "", F.split(reasons, ",").getItem(0)).alias("primary_reason"),
    )


def excluded_lines(audit: DataFrame) -> DataFrame:
    """Quarantine: the excluded lines with their reasons."""
    return audit.where(F.col("primary_reason").isNotNull())


def exclusion_summary(audit: DataFrame) -> DataFrame:
    return (excluded_lines(audit).groupBy("primary_reason")
            .agg(F.count(F.lit(1)).cast("bigint").alias("excluded_lines")))


def line_balance(audit: DataFrame) -> DataFrame:
    """staged_rows, excluded_rows and loadable_rows (lines without a reason)."""
    excluded = F.col("primary_reason").isNotNull()
    return audit.agg(
        F.count(F.lit(1)).cast("bigint").alias("staged_rows"),
        F.count_if(excluded).cast("bigint").alias("excluded_rows"),
        F.count_if(~excluded).cast("bigint").alias("loadable_rows"),
    )


def balance_from_quarantine(stg_order_items: DataFrame, quarantine: DataFrame) -> DataFrame:
    """``line_balance`` of a version whose quarantine (excluded lines) is already written:
    staged lines and quarantined lines are counted, the rest is loadable."""
    from martforge.operators.combine import side_by_side
    staged = stg_order_items.agg(F.count(F.lit(1)).cast("bigint").alias("staged_rows"))
    excluded = quarantine.agg(F.count(F.lit(1)).cast("bigint").alias("excluded_rows"))
    return side_by_side([staged, excluded]).select(
        "staged_rows", "excluded_rows", (F.col("staged_rows") - F.col("excluded_rows")).alias("loadable_rows"))
