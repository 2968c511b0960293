"""Dirty staging tables derived from the TPC-H-like test tables.

The relational test tables are clean (no NULLs, duplicates or orphans), which
would make every data-quality check trivially 0. These derivations plant the
same kinds of anomaly the extracts of an e-commerce shop carry: duplicated
customers (one copy with a missing city), missing prices and payment methods,
orphan customer and product references, zero and negative quantities.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.operators.inject import COPY_NO, append_copies, null_where, replace_where
from martforge.operators.joins import sized_broadcast
from martforge.schemas import PRICE

# Fixed values of the derived fixture (they define the test data).
SIGNUP_EPOCH = _dt.date(1994, 1, 1)
ORPHAN_CUSTOMER_ID = 999999999
ORPHAN_PRODUCT_ID = 999999999


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stg_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("c_custkey")
    base = (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
             .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    rows = append_copies(base, (k % 101 == 3) | (k % 485 == 7))
    original = F.col(COPY_NO) == 0
    return rows.select(
        k.cast("long").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        null_where(F.col("n_name"), original & (k % 97 == 7)).alias("city"),
        F.col("r_name").alias("state"),
        F.when(k % 200 == 1, F.lit("OTHER")).otherwise(F.lit("HOME")).alias("country"),
        F.date_add(F.lit(SIGNUP_EPOCH), (k % 365).cast("int")).alias("signup_date"),
    )


def stg_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.cast("long").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        null_where(F.col("p_retailprice").cast(PRICE), k % 50 == 9).alias("price"),
    )


def stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.cast("long").alias("order_id"),
        replace_where(F.col("o_custkey").cast("long"), k % 200 == 11, ORPHAN_CUSTOMER_ID)
        .cast("long").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        null_where(F.col("o_orderpriority"), k % 166 == 5).alias("payment_method"),
        F.col("o_orderstatus").alias("order_status"),
    )


def stg_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    rows = li.join(sized_broadcast(p), F.col("l_partkey") == F.col("p_partkey"))
    ok, pk = F.col("l_orderkey"), F.col("l_partkey")
    q_hash = ok * 3 + pk
    quantity = (F.when(q_hash % 220 == 1, F.lit(0))
                 .when(q_hash % 440 == 2, F.lit(-1))
                 .otherwise(F.col("l_quantity").cast("int")))
    return rows.select(
        ok.cast("long").alias("order_id"),
        replace_where(pk.cast("long"), (ok * 7 + F.col("l_linenumber")) % 183 == 5, ORPHAN_PRODUCT_ID)
        .cast("long").alias("product_id"),
        quantity.cast("int").alias("quantity"),
        F.col("p_retailprice").cast(PRICE).alias("unit_price"),
    )


# --- mutated variants: break the "must be 0" integrity rules on purpose ------

def stg_customers_mut(customers: DataFrame) -> DataFrame:
    """Some signups moved to 2000-01-01, after their orders (order-before-signup)."""
    cid = F.col("customer_id")
    return customers.withColumn(
        "signup_date", F.when(cid % 150 == 0, F.lit(_dt.date(2000, 1, 1))).otherwise(F.col("signup_date")))


def stg_order_items_mut(items: DataFrame) -> DataFrame:
    """Some lines point at missing orders; some carry a price one cent off."""
    oid = F.col("order_id")
    return items.select(
        F.when(oid % 2000 == 3, oid + 1000000000).otherwise(oid).alias("order_id"),
        "product_id", "quantity",
        F.when(oid % 1000 == 1, (F.col("unit_price") + F.lit(0.01)).cast(PRICE))
         .otherwise(F.col("unit_price")).alias("unit_price"),
    )


def fact_sales_mut(fact: DataFrame) -> DataFrame:
    """Duplicate keys, NULL/dangling foreign keys, bad quantities and amounts."""
    sk = F.col("sales_key")
    return fact.select(
        F.when(sk % 1009 == 0, sk - 1).otherwise(sk).alias("sales_key"),
        "order_id",
        F.when(sk % 983 == 0, F.lit(None)).otherwise(F.col("customer_key")).cast("long").alias("customer_key"),
        F.when(sk % 977 == 0, F.lit(-1)).otherwise(F.col("product_key")).cast("long").alias("product_key"),
        F.when(sk % 971 == 0, F.lit(19000101)).otherwise(F.col("date_key")).cast("int").alias("date_key"),
        F.when(sk % 997 == 0, F.lit(0)).otherwise(F.col("quantity")).cast("int").alias("quantity"),
        "unit_price",
        F.when(sk % 991 == 0, (F.col("sales_amount") + F.lit(0.01)).cast("decimal(14,2)"))
         .otherwise(F.col("sales_amount")).alias("sales_amount"),
    )
