"""Whole build: cold start, re-run, failed gate, what readers see."""

import pytest

from conftest import SF001
from martforge.plans import checks
from martforge.plans.publish import Store
from martforge.plans.staging import derived_staging
from martforge.plans.warehouse import build, current

TABLES = ("dim_customer", "dim_product", "dim_date", "fact_sales")


def test_cold_start_rerun_and_failed_gate(spark, tmp_root):
    st = derived_staging(spark, SF001)
    assert current(spark, tmp_root) is None
    first = build(spark, st, tmp_root)
    assert Store(spark, tmp_root).current() == first.run_id
    counts = {t: first.table(t).count() for t in TABLES}
    assert counts == {"dim_customer": 150, "dim_product": 200, "dim_date": 2405, "fact_sales": 5912}
    report = {r["check"]: r["status"] for r in first.store.read("validation_report", first.run_id).collect()}
    assert "FAIL" not in report.values()

    second = build(spark, st, tmp_root)
    assert current(spark, tmp_root).run_id == second.run_id != first.run_id
    for t in TABLES:
        a, b = first.table(t), second.table(t)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, t

    # An expectation that cannot hold fails the staging gate: nothing is published.
    with pytest.raises(checks.GateFailed) as e:
        build(spark, st, tmp_root, expectations=checks.Expectations({"stg_orders_rows": 1}))
    assert "stg_orders_rows" in str(e.value)
    assert Store(spark, tmp_root).current() == second.run_id


def test_integrity_violation_blocks_publish(spark, tmp_root):
    from martforge.plans.staging import mutated_staging
    st = mutated_staging(derived_staging(spark, SF001))
    with pytest.raises(checks.GateFailed) as e:
        build(spark, st, tmp_root)
    msg = str(e.value)
    assert "orphan_order_references" in msg and "order_before_signup" in msg and "unit_price_mismatches" in msg
    assert Store(spark, tmp_root).current() is None


def test_views_and_run_from_extracts(spark, tmp_root):
    from martforge.plans import views
    from martforge.plans.warehouse import run_from_extracts
    from martforge.sources.extracts import write_extracts
    src = tmp_root + "/raw"
    write_extracts(derived_staging(spark, SF001), src)
    wh = run_from_extracts(spark, src, tmp_root + "/wh")
    names = views.register(wh, prefix="t_")
    assert "t_vw_warehouse_reconciliation_display" in names
    disp = spark.sql("SELECT metric, difference FROM t_vw_warehouse_reconciliation_display").collect()
    assert [r["metric"] for r in disp] == ["Rows", "Total Quantity", "Total Sales"]
    assert all(r["difference"] == 0 for r in disp)
    dq = {r["issue"]: r["issue_count"] for r in spark.sql("SELECT * FROM t_vw_data_quality_issues").collect()}
    assert dq == {"Duplicate Customer IDs": 3, "Missing Customer Cities": 2, "Missing Product Prices": 4,
                  "Missing Payment Methods": 10, "Orphan Customer IDs": 8, "Orphan Product IDs": 28,
                  "Invalid Quantities": 39}
    assert spark.sql("SELECT COUNT(*) AS n FROM t_fact_sales").first()["n"] == 5912


def test_malformed_extract_aborts_before_publish(spark, tmp_root):
    import glob
    from martforge.plans.warehouse import run_from_extracts
    from martforge.sources.extracts import write_extracts
    src = tmp_root + "/raw"
    write_extracts(derived_staging(spark, SF001), src)
    part = sorted(glob.glob(src + "/orders.csv/part-*.csv"))[0]
    lines = open(part).read().splitlines()
    lines[1] = "not-a-number," + lines[1].split(",", 1)[1]
    open(part, "w").write("\n".join(lines) + "\n")
    with pytest.raises(Exception):
        run_from_extracts(spark, src, tmp_root + "/wh")
    assert Store(spark, tmp_root + "/wh").current() is None


def test_fixture_expectations_pin_known_anomalies(spark, tmp_root):
    from fixture_expectations import for_fixture
    wh = build(spark, derived_staging(spark, SF001), tmp_root, expectations=for_fixture(SF001))
    rep = {r["check"]: r for r in wh.store.read("validation_report", wh.run_id).collect()}
    assert rep["invalid_quantities"]["status"] == "WARN" and rep["invalid_quantities"]["expected"] == "39"
    assert rep["unknown_cities"]["status"] == "PASS" and rep["unknown_cities"]["expected"] == "0"
    assert rep["stg_order_items_rows"]["status"] == "PASS" and rep["stg_order_items_rows"]["expected"] == "6000"
    assert "FAIL" not in {r["status"] for r in rep.values()}
