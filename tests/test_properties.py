"""Invariants over random anomaly mixes: loaded + excluded = staged, recon differences 0."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martforge.plans import audit, reconcile
from martforge.plans.dims import build_dim_customer, build_dim_date, build_dim_product
from martforge.plans.facts import build_fact_sales
from martforge.plans.staging import Staging
from martforge.schemas import STG_CUSTOMERS, STG_ORDER_ITEMS, STG_ORDERS, STG_PRODUCTS

ids = st.integers(min_value=1, max_value=6)
maybe_id = st.one_of(ids, st.just(99), st.none())
qty = st.one_of(st.integers(min_value=-2, max_value=5), st.none())
day = st.one_of(st.dates(min_value=dt.date(2022, 1, 1), max_value=dt.date(2022, 3, 1)), st.none())

customers = st.lists(st.tuples(ids, st.sampled_from(["a", "b"]), st.sampled_from(["x", None]), day), max_size=8)
products = st.lists(st.tuples(ids, st.sampled_from(["1.00", "2.50", None])), max_size=6)
orders = st.lists(st.tuples(ids, maybe_id, day), max_size=8)
items = st.lists(st.tuples(maybe_id, maybe_id, qty, st.sampled_from(["1.00", "2.55"])), max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(customers, products, orders, items)
def test_balance_and_reconciliation(spark, cs, ps, os_, its):
    # unique order and product ids (as the staging gates require), everything else dirty
    os_ = list({o[0]: o for o in os_}.values())
    ps = list({p[0]: p for p in ps}.values())
    stg = Staging(
        spark.createDataFrame([(c[0], c[1], c[2], "s", "c", c[3]) for c in cs], STG_CUSTOMERS),
        spark.createDataFrame([(p[0], f"p{p[0]}", "cat", Decimal(p[1]) if p[1] else None) for p in ps],
                              STG_PRODUCTS),
        spark.createDataFrame([(o[0], o[1], o[2], None, "x") for o in os_], STG_ORDERS),
        spark.createDataFrame([(i[0], i[1], i[2], Decimal(i[3])) for i in its], STG_ORDER_ITEMS),
    )
    dc, dp, dd = build_dim_customer(stg.customers), build_dim_product(stg.products), build_dim_date(stg.orders)
    fact = build_fact_sales(stg.order_items, stg.orders, dc, dp, dd, check_sizes=False)
    bal = audit.line_balance(audit.line_audit(stg, dc, dp, dd)).first()
    n_fact = fact.count()
    assert bal["staged_rows"] == len(its)
    assert bal["loadable_rows"] + bal["excluded_rows"] == bal["staged_rows"]
    assert bal["loadable_rows"] == n_fact
    wide = reconcile.recon_wide(reconcile.source_totals(stg, dc, dp, dd), reconcile.fact_totals(fact)).first()
    assert (wide["row_difference"], wide["quantity_difference"], wide["sales_difference"]) == (0, 0, 0)
    keys = sorted(r["sales_key"] for r in fact.select("sales_key").collect())
    assert keys == list(range(1, n_fact + 1))
