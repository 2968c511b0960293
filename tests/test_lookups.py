"""Lookups past the broadcast limit are never broadcast, whatever Spark estimates from compressed files."""

import datetime

import pytest

from conftest import SF001
from martforge.operators import joins
from martforge.plans import audit, checks, facts, incremental, marts, reconcile
from martforge.plans.staging import Staging
from martforge.sources import tpch

DAY = datetime.date(2024, 1, 1)


@pytest.fixture()
def low_limit(spark):
    spark.conf.set(joins.BROADCAST_MAX_ROWS_CONF, "1")
    yield
    spark.conf.unset(joins.BROADCAST_MAX_ROWS_CONF)


@pytest.fixture(scope="module")
def star(spark):
    make = spark.createDataFrame
    customers = make([(1, "a", "x", "S", "HOME", DAY), (2, "b", None, "S", "HOME", DAY)],
                     "customer_id long, customer_name string, city string, state string, country string, signup_date date")
    products = make([(1, "p", "c", 1), (2, "q", "d", 2)], "product_id long, product_name string, category string, price int")
    orders = make([(1, 1, DAY), (2, 2, DAY), (3, 9, DAY)], "order_id long, customer_id long, order_date date")
    items = make([(1, 1, 1, 1), (2, 2, 2, 3), (3, 1, 1, 1), (4, 8, 1, 1)],
                 "order_id long, product_id long, quantity int, unit_price int")
    dims = [customers.selectExpr("customer_id as customer_key", "*"), products.selectExpr("product_id as product_key", "*"),
            make([(20240101, DAY), (20240102, datetime.date(2024, 1, 2))], "date_key int, full_date date")]
    fact = make([(1, 1, 1, 1, 1), (2, 2, 2, 2, 6)], "order_id long, customer_key long, product_key long, quantity int, sales_amount int")
    return Staging(customers, products, orders, items), dims, fact


CASES = {
    "audit": lambda s, d, f: audit.line_audit(s, *d),
    "fact": lambda s, d, f: facts.fact_rows(s.order_items, s.orders, *d),
    "source": lambda s, d, f: reconcile.valid_source_lines(s, *d),
    "signup": lambda s, d, f: checks._order_before_signup(s.tables()),
    "price": lambda s, d, f: checks._price_mismatch(s.tables()),
    "flags": lambda s, d, f: joins.with_match(s.orders, s.customers, "customer_id", "ok"),
    "category": lambda s, d, f: marts.revenue_by_category(f, d[1]),
    "state": lambda s, d, f: marts.revenue_by_state(f, d[0]),
    "top": lambda s, d, f: marts.top_products(f, d[1]),
    "city": lambda s, d, f: incremental.revenue_by_city_then(f.withColumnRenamed("customer_key", "customer_version_key"),
                                                            d[0].withColumnRenamed("customer_key", "customer_version_key")),
}


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("case", CASES)
def test_large_lookups_are_shuffled(spark, star, low_limit, case):
    found = CASES[case](*star)
    assert "BroadcastHashJoin" not in planned(found) and "BroadcastExchange" not in planned(found)
    rows = sorted(map(str, found.collect()))
    spark.conf.unset(joins.BROADCAST_MAX_ROWS_CONF)
    within = CASES[case](*star)
    assert "BroadcastHashJoin" in planned(within) and sorted(map(str, within.collect())) == rows


def test_staged_lines_meet_prices_by_shuffle(spark, low_limit):
    lines = tpch.stg_order_items(spark, SF001)
    assert "SortMergeJoin" in planned(lines) and "BroadcastHashJoin" not in planned(lines)
    spark.conf.unset(joins.BROADCAST_MAX_ROWS_CONF)
    within = tpch.stg_order_items(spark, SF001)
    assert "BroadcastHashJoin" in planned(within) and lines.count() == within.count() and lines.exceptAll(within).isEmpty()
