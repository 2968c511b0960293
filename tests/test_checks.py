"""Check semantics on hand-made frames."""

import datetime as dt
from decimal import Decimal

import pytest

from martforge.plans import checks, marts, reconcile
from martforge.plans.audit import line_audit
from martforge.plans.dims import build_dim_customer, build_dim_date, build_dim_product
from martforge.plans.facts import build_fact_sales
from martforge.plans.staging import Staging
from martforge.plans.warehouse import check_tables
from martforge.schemas import (DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, FACT_SALES, STG_CUSTOMERS, STG_ORDER_ITEMS,
                               STG_ORDERS, STG_PRODUCTS)

D = dt.date
P = Decimal


def _staging(spark, customers, products, orders, items):
    return Staging(spark.createDataFrame(customers, STG_CUSTOMERS), spark.createDataFrame(products, STG_PRODUCTS),
                   spark.createDataFrame(orders, STG_ORDERS), spark.createDataFrame(items, STG_ORDER_ITEMS))


@pytest.fixture()
def small(spark):
    customers = [(1, "Ann", "Oslo", "S", "C", D(2022, 1, 1)), (1, "Ann", "Oslo", "S", "C", D(2022, 1, 1)),
                 (1, "Ann", "Oslo", "S", "C", D(2022, 1, 1)), (2, "Bob", None, "S", "C", D(2022, 1, 5))]
    products = [(10, "p10", "A", P("2.00")), (11, "p11", "B", None)]
    orders = [(100, 1, D(2022, 1, 2), "card", "Completed"), (101, 2, D(2022, 1, 4), None, "Cancelled"),
              (102, 99999, D(2022, 1, 3), "cash", "Completed")]
    items = [(100, 10, 2, P("2.00")), (100, 11, None, P("3.00")), (101, 10, 0, P("2.00")),
             (101, 9999, 1, P("1.00")), (102, 10, 1, P("2.00")), (101, 11, 3, P("3.00"))]
    return _staging(spark, customers, products, orders, items)


def _values(df):
    return {r["check"]: r for r in df.collect()}


def test_staging_checks(spark, small):
    rep = _values(checks.report(checks.staging_checks(), small.tables()))
    assert rep["duplicate_customer_ids"]["actual"] == "1"       # a triple counts once
    assert rep["missing_customer_cities"]["actual"] == "1"
    assert rep["missing_product_prices"]["actual"] == "1"
    assert rep["missing_payment_methods"]["actual"] == "1"
    assert rep["orphan_customer_ids"]["actual"] == "1"
    assert rep["orphan_product_ids"]["actual"] == "1"
    assert rep["invalid_quantities"]["actual"] == "1"           # NULL quantity is not <= 0
    assert rep["invalid_quantities"]["status"] == "WARN"
    # customer 2 signed up 2022-01-05 and ordered 2022-01-04
    assert rep["order_before_signup"]["actual"] == "1" and rep["order_before_signup"]["status"] == "FAIL"
    assert rep["stg_order_items_rows"]["status"] == "PASS"


def test_order_before_signup_fans_out_over_duplicates(spark, small):
    dup = small.replace(customers=small.customers.unionByName(small.customers.where("customer_id = 2")))
    assert checks.measure_one(checks.by_name("order_before_signup"), dup.tables()).first()["actual"] == 2


def test_configured_expectation(spark, small):
    cs = checks.configure(checks.staging_checks(), checks.Expectations({"invalid_quantities": 5,
                                                                         "stg_orders_rows": 3}))
    rep = _values(checks.report(cs, small.tables()))
    assert rep["invalid_quantities"]["status"] == "FAIL" and rep["invalid_quantities"]["expected"] == "5"
    assert rep["stg_orders_rows"]["status"] == "PASS" and rep["stg_orders_rows"]["expected"] == "3"


def _build(stg):
    dims = {"dim_customer": build_dim_customer(stg.customers), "dim_product": build_dim_product(stg.products),
            "dim_date": build_dim_date(stg.orders)}
    fact = build_fact_sales(stg.order_items, stg.orders, dims["dim_customer"], dims["dim_product"],
                            dims["dim_date"])
    return dims, fact


def test_fact_audit_and_recon(spark, small):
    dims, fact = _build(small)
    rows = sorted((r["order_id"], r["quantity"]) for r in fact.collect())
    # NULL quantity is neither flagged nor loaded; qty 0, orphan product, orphan customer excluded
    assert rows == [(100, 2), (101, 3)]
    audit = {(r["order_id"], r["product_id"], r["quantity"]): r for r in line_audit(
        small, dims["dim_customer"], dims["dim_product"], dims["dim_date"]).collect()}
    assert audit[(100, 11, None)]["primary_reason"] == "null_quantity"
    assert audit[(101, 10, 0)]["primary_reason"] == "invalid_quantity"
    assert audit[(101, 9999, 1)]["primary_reason"] == "orphan_product"
    assert audit[(102, 10, 1)]["primary_reason"] == "orphan_customer"
    assert audit[(100, 10, 2)]["primary_reason"] is None
    rep = _values(checks.report(checks.warehouse_checks(), check_tables(small, dims, fact)))
    failed = {k: v for k, v in rep.items() if v["status"] == "FAIL"}
    assert not failed, failed
    assert rep["unknown_cities"]["actual"] == "1"
    assert rep["null_prices"]["actual"] == "1"


def test_corrupted_fact_fails_gates(spark, small):
    dims, fact = _build(small)
    bad = fact.withColumn("sales_amount", fact.sales_amount + 1).unionByName(
        fact.limit(1).withColumn("customer_key", fact.customer_key * 0 - 7))
    rep = _values(checks.report(checks.warehouse_checks(), check_tables(small, dims, bad)))
    for name in ("sales_amount_mismatches", "orphan_customer_keys", "duplicate_sales_keys", "row_difference",
                 "sales_difference", "fact_rows"):
        assert rep[name]["status"] == "FAIL", name


def test_broken_dimensions_fail(spark):
    cust = spark.createDataFrame([(1, 1, "a", "Unknown", "s", "c", D(2022, 1, 1)),
                                  (2, 1, "a", None, "s", "c", D(2022, 1, 1))], DIM_CUSTOMER)
    prod = spark.createDataFrame([(1, 5, None, "x", None), (2, 5, "b", "x", P("1.00"))], DIM_PRODUCT)
    dates = spark.createDataFrame([(20220101, D(2022, 1, 1), 2022, 1, 1, "January", 52, 1, "Saturday"),
                                   (20220101, D(2022, 1, 1), 2022, 1, 1, "January", 52, 1, "Saturday"),
                                   (20220199, D(2022, 1, 3), 2022, 1, 1, "January", 1, 3, "Monday")], DIM_DATE)
    t = {"dim_customer": cust, "dim_product": prod, "dim_date": dates}
    m = lambda n: checks.measure_one(checks.by_name(n), t).first()["actual"]
    assert m("dim_customer_duplicate_ids") == 1
    assert m("dim_customer_nulls") == 1
    assert m("unknown_cities") == 1
    assert m("dim_product_duplicate_ids") == 1
    assert m("dim_product_nulls") == 1
    assert m("dim_date_duplicate_dates") == 1
    assert m("missing_calendar_dates") == 1
    assert m("date_key_mismatches") == 1


def test_empty_fact_measures_and_differences(spark):
    fact = spark.createDataFrame([], FACT_SALES)
    k = marts.kpi_measures(fact).first()
    assert k["total_sales"] == 0 and k["total_orders"] == 0 and k["avg_order_value"] == 0.0
    src = spark.createDataFrame([(0, 0, P("0.00"))],
                                "source_valid_rows bigint, source_total_quantity bigint, "
                                "source_total_sales decimal(24,2)")
    w = reconcile.recon_wide(src, reconcile.fact_totals(fact)).first()
    assert (w["row_difference"], w["quantity_difference"], w["sales_difference"]) == (0, 0, 0)
