"""Heavy keys and the split join: rows of the plain join, and no partition that one key fills."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from martforge.operators.skew import heavy_keys, split_join
from martforge.plans.dims import build_dim_customer, build_dim_date, build_dim_product
from martforge.plans.facts import build_fact_sales
from martforge.plans.staging import derived_staging
from martforge.session import materialize


@pytest.fixture()
def plain_joins(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def hot_lines(spark, n=24_000):
    """A third of all rows on one key, some nulls, unmatched keys."""
    key = (F.when(F.col("id") % 3 == 0, 77).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 5000)).alias("k")
    return materialize(spark.range(n, numPartitions=8).select(key.cast("long").alias("k"), F.col("id").alias("v")), "hot")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_rows_of_the_plain_join(spark, plain_joins, how):
    left = hot_lines(spark)
    right = spark.createDataFrame([(i, f"r{i}") for i in range(0, 4000, 2)] + [(77, "a"), (77, "b"), (None, "n")], "k long, w string")
    assert heavy_keys(left, "k") == [77]
    got, want = split_join(left, right, "k", how), left.join(right, "k", how)
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 2.5 * statistics.median(sizes)
    skewed = [r["count"] for r in want.groupBy(F.spark_partition_id()).count().collect()]
    assert max(skewed) > 4 * statistics.median(skewed)


def test_heavy_keys(spark):
    rnd = random.Random(1)
    keys = ["x"] * 300 + ["y"] * 200 + [f"z{rnd.randrange(10 ** 6)}" for _ in range(3000)] + [None] * 900
    rnd.shuffle(keys)
    frame = spark.createDataFrame([(k,) for k in keys], "k string")
    assert heavy_keys(frame, "k", 0.04) == ["x", "y"] and heavy_keys(frame, "k", 0.06) == ["x"]
    assert heavy_keys(frame.limit(0), "k", 0.1) == [] and heavy_keys(frame.where("k is null"), "k", 0.1) == []
    with pytest.raises(ValueError):
        heavy_keys(frame, "k", 1e-9)


def test_fact_with_a_hot_order(spark, plain_joins):
    s = derived_staging(spark, SF001)
    hot = s.orders.where("customer_id < 99999").agg(F.min("order_id")).first()[0]
    lines = materialize(s.order_items.withColumn("order_id", F.when(F.col("product_id") % 3 == 0, F.lit(hot)).otherwise(
        F.col("order_id"))), "hot-lines")
    dims = [materialize(d, "dims") for d in (build_dim_customer(s.customers), build_dim_product(s.products),
                                             build_dim_date(s.orders))]
    heavy = heavy_keys(lines, "order_id")
    assert heavy == [hot]
    got = build_fact_sales(lines, s.orders, *dims, heavy_orders=heavy)
    want = build_fact_sales(lines, s.orders, *dims)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and want.count() > 5000
