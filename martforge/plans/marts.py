"""Measures and report marts over the star.

Additive measures are pre-aggregated on the fact by the dimension key before
meeting the dimension, so what crosses the join is one row per key, not one
per order line; small dimensions (checked by row count) are broadcast instead.
Windows run only on already-aggregated frames whose size is bounded by a
calendar or a dimension attribute (quarters, states, categories).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.functions.expr import safe_ratio, to_total
from martforge.operators.combine import side_by_side
from martforge.operators.joins import broadcast_limit, fits_broadcast, shuffled, sized_broadcast


def _sales() -> Column:
    return to_total(F.sum("sales_amount")).alias("total_sales")


def _qty() -> Column:
    return F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("total_quantity")


def _orders() -> Column:
    return F.count_distinct("order_id").cast("bigint").alias("total_orders")


def measures(fact: DataFrame, by: list[str]) -> DataFrame:
    """Total sales / quantity / orders, average order value and selling price, per ``by``."""
    grouped = fact.groupBy(*by).agg(_sales(), _qty(), _orders())
    return grouped.select(
        "*",
        safe_ratio(F.col("total_sales"), F.col("total_orders")).alias("avg_order_value"),
        safe_ratio(F.col("total_sales"), F.col("total_quantity")).alias("avg_selling_price"),
    )


def distinct_counts(fact: DataFrame, names: dict[str, str]) -> DataFrame:
    """One row with the exact distinct count of each column, as ``names[column]``.

    One aggregate per column: several distincts in one would multiply every row.
    """
    return side_by_side([fact.agg(F.count_distinct(c).cast("bigint").alias(n)) for c, n in names.items()]).select(
        *names.values())


def kpi_measures(fact: DataFrame) -> DataFrame:
    sums = fact.agg(_sales(), _qty())
    counts = distinct_counts(fact, {"order_id": "total_orders", "customer_key": "total_customers",
                                    "product_key": "total_products"})
    return side_by_side([sums, counts]).select(
        "total_sales", "total_quantity", "total_orders", "total_customers", "total_products",
        safe_ratio(F.col("total_sales"), F.col("total_orders")).alias("avg_order_value"),
        safe_ratio(F.col("total_sales"), F.col("total_quantity")).alias("avg_selling_price"))


def additive_by(fact: DataFrame, dim: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """sum(sales_amount), sum(quantity) per ``attrs`` of ``dim`` joined on ``key``."""
    lookup = dim.select(key, *attrs)
    if fits_broadcast(dim):
        joined = fact.select(key, "sales_amount", "quantity").join(F.broadcast(lookup), key)
        return joined.groupBy(*attrs).agg(_sales(), _qty())
    per_key = fact.groupBy(key).agg(F.sum("sales_amount").alias("sales_amount"),
                                    F.sum("quantity").alias("quantity"))
    return per_key.join(shuffled(lookup), key).groupBy(*attrs).agg(_sales(), _qty())


def revenue_by_category(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    cat = additive_by(fact, dim_product, "product_key", ["category"])
    grand = F.sum("total_sales").over(Window.partitionBy())
    return cat.select("category", "total_sales", "total_quantity",
                      safe_ratio(F.col("total_sales"), grand).alias("sales_share"))


def monthly_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    cal = sized_broadcast(dim_date.select("date_key", "year", "month", "month_name"), size_of=dim_date)
    return (fact.select("date_key", "order_id", "sales_amount", "quantity").join(cal, "date_key")
            .groupBy("year", "month", "month_name").agg(_sales(), _qty(), _orders()))


def quarterly_growth(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Sales of every quarter of the calendar, also those without any, next to the quarter before."""
    per_day = fact.groupBy("date_key").agg(F.sum("sales_amount").alias("sales_amount"))
    q = (dim_date.select("date_key", "year", "quarter").join(per_day, "date_key", "left")
         .groupBy("year", "quarter").agg(to_total(F.sum("sales_amount")).alias("total_sales")))
    prev = F.lag("total_sales").over(Window.orderBy("year", "quarter"))
    return q.select("year", "quarter", "total_sales", prev.alias("prev_total_sales")).select(
        "*", F.try_divide(F.col("total_sales").cast("double") - F.col("prev_total_sales").cast("double"),
                          F.col("prev_total_sales").cast("double")).alias("qoq_growth"))


def _by_customer(fact: DataFrame, dim_customer: DataFrame, attr: str) -> DataFrame:
    """Sales, distinct orders and distinct customers per customer attribute.

    Lines become one row per (customer, order), which counts once for its order and once for its customer: rows of
    (attribute, order or customer) are made distinct in one aggregate, so the fact is shuffled once and no line is
    multiplied.
    """
    per = fact.groupBy("customer_key", "order_id").agg(F.sum("sales_amount").alias("sales_amount"))
    per = per.join(sized_broadcast(dim_customer.select("customer_key", attr), size_of=dim_customer), "customer_key")
    none = F.lit(None).cast("decimal(24,2)")
    each = F.inline(F.array(F.struct(F.lit(True).alias("is_order"), F.col("order_id").alias("id"), "sales_amount"),
                            F.struct(F.lit(False).alias("is_order"), F.col("customer_key").alias("id"),
                                     none.alias("sales_amount"))))
    once = per.select(attr, each).groupBy(attr, "is_order", "id").agg(F.sum("sales_amount").alias("sales_amount"))
    return once.groupBy(attr).agg(
        to_total(F.sum("sales_amount")).alias("total_sales"),
        F.count_if(F.col("is_order") & F.col("id").isNotNull()).cast("bigint").alias("total_orders"),
        F.count_if(~F.col("is_order")).cast("bigint").alias("total_customers"))


def revenue_by_state(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    st = _by_customer(fact, dim_customer, "state")
    rank = F.row_number().over(Window.orderBy(F.col("total_sales").desc(), F.col("state").asc_nulls_last()))
    return st.select("state", "total_sales", "total_orders", "total_customers", rank.cast("bigint").alias("revenue_rank"))


def city_performance(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return _by_customer(fact, dim_customer, "city").select("city", "total_orders", "total_customers", "total_sales")


def customer_acquisition(dim_customer: DataFrame) -> DataFrame:
    """New customers per signup year and month (signups may precede the calendar)."""
    return (dim_customer.groupBy(F.year("signup_date").alias("signup_year"),
                                 F.month("signup_date").alias("signup_month"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("new_customers")))


def top_products(fact: DataFrame, dim_product: DataFrame, k: int = 10) -> DataFrame:
    per = fact.groupBy("product_key").agg(_sales(), _qty())
    # rows with names are several times as large as the pairs of keys that the limit is meant for
    names = sized_broadcast(dim_product.select("product_key", "product_id", "product_name", "category"),
                            broadcast_limit(dim_product) // 8, size_of=dim_product)
    top = (per.join(names, "product_key")
              .orderBy(F.col("total_sales").desc(), F.col("product_id").asc())
              .limit(k))
    rank = F.row_number().over(Window.orderBy(F.col("total_sales").desc(), F.col("product_id").asc()))
    return top.select(rank.cast("bigint").alias("product_rank"), "product_id", "product_name", "category",
                      "total_sales", "total_quantity")


def asp_by_category(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    cat = additive_by(fact, dim_product, "product_key", ["category"])
    return cat.select("category", "total_sales", "total_quantity",
                      safe_ratio(F.col("total_sales"), F.col("total_quantity")).alias("avg_selling_price"))


def measures_by_category_month(fact: DataFrame, dim_product: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The measure set sliced by category, year and month (report filter context)."""
    prod = sized_broadcast(dim_product.select("product_key", "category"), size_of=dim_product)
    cal = sized_broadcast(dim_date.select("date_key", "year", "month"), size_of=dim_date)
    sliced = fact.join(prod, "product_key").join(cal, "date_key")
    return measures(sliced, ["category", "year", "month"])
