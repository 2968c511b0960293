"""Dimension builders on hand-made frames."""

import datetime as dt

from pyspark.sql import functions as F

from martforge.operators.dedupe import first_per_key
from martforge.plans.dims import build_dim_customer, build_dim_date
from martforge.schemas import STG_CUSTOMERS, STG_ORDERS

D = dt.date


def _cust(spark, rows):
    return spark.createDataFrame(rows, STG_CUSTOMERS)


def test_dedupe_keeps_real_city_over_null(spark):
    rows = [(1, "Ann", None, "S", "C", D(2022, 1, 1)), (1, "Ann", "Oslo", "S", "C", D(2022, 1, 1)),
            (2, "Bob", None, "S", "C", D(2022, 1, 2))]
    dim = {r["customer_id"]: r for r in build_dim_customer(_cust(spark, rows)).collect()}
    assert dim[1]["city"] == "Oslo"           # NULLS LAST in the dedupe order
    assert dim[2]["city"] == "Unknown"        # lone NULL city -> Unknown
    assert sorted(r["customer_key"] for r in dim.values()) == [1, 2]


def test_dedupe_order_precedence(spark):
    rows = [(5, "Zed", "A", "S", "C", D(2022, 3, 1)), (5, "Amy", "B", "S", "C", D(2022, 3, 1)),
            (5, "Bea", "C", "S", "C", D(2022, 2, 1)), (5, "Cal", "D", "S", "C", None)]
    out = first_per_key(_cust(spark, rows), ["customer_id"],
                        ["signup_date", "customer_name", "city", "state", "country"]).collect()
    assert len(out) == 1 and out[0]["customer_name"] == "Bea"


def test_calendar_iso_week_and_names(spark):
    orders = spark.createDataFrame([(1, 1, D(2021, 12, 30), "x", "y"), (2, 1, D(2022, 1, 3), "x", "y")],
                                   STG_ORDERS)
    cal = {r["full_date"]: r for r in build_dim_date(orders).collect()}
    assert len(cal) == 5
    assert cal[D(2022, 1, 1)]["year"] == 2022 and cal[D(2022, 1, 1)]["week"] == 52
    assert cal[D(2022, 1, 3)]["week"] == 1
    assert cal[D(2022, 1, 1)]["date_key"] == 20220101
    assert cal[D(2022, 1, 1)]["month_name"] == "January" and cal[D(2022, 1, 1)]["day_name"] == "Saturday"
    assert cal[D(2021, 12, 30)]["quarter"] == 4


def test_empty_orders_give_empty_calendar(spark):
    orders = spark.createDataFrame([], STG_ORDERS)
    assert build_dim_date(orders).count() == 0
    nulls = spark.createDataFrame([(1, 1, None, "x", "y")], STG_ORDERS)
    assert build_dim_date(nulls).where(F.lit(True)).count() == 0
