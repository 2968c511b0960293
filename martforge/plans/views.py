"""Named views over a warehouse version, for SQL users and BI tools.

Registered as session temp views; each is the lazy DataFrame of the builder
functions, so a query against a view re-plans from the published tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from martforge.plans import reconcile
from martforge.plans.warehouse import Warehouse

# Issue labels of the data-quality view, in its order.
DQ_ISSUES = (
    ("duplicate_customer_ids", "Duplicate Customer IDs"),
    ("missing_customer_cities", "Missing Customer Cities"),
    ("missing_product_prices", "Missing Product Prices"),
    ("missing_payment_methods", "Missing Payment Methods"),
    ("orphan_customer_ids", "Orphan Customer IDs"),
    ("orphan_product_ids", "Orphan Product IDs"),
    ("invalid_quantities", "Invalid Quantities"),
)


def dq_issues(stg_tables):
    from martforge.plans import checks
    cs = [checks.by_name(n) for n, _ in DQ_ISSUES]
    raw = checks.measure_all(cs, stg_tables)
    label = F.col("check")
    for name, text in DQ_ISSUES:
        label = F.when(F.col("check") == name, F.lit(text)).otherwise(label)
    return raw.select(label.alias("issue"), F.col("value").cast("bigint").alias("issue_count"))


def register(wh: Warehouse, prefix: str = "") -> list[str]:
    """Register the star tables, staging tables and the three monitoring views."""
    names = []
    tables = wh.tables()
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    stg = wh.staging()
    dims = {n: tables[n] for n in ("dim_customer", "dim_product", "dim_date")}
    src = reconcile.source_totals(stg, dims["dim_customer"], dims["dim_product"], dims["dim_date"])
    wide = reconcile.recon_wide(src, reconcile.fact_totals(tables["fact_sales"]))
    views = {
        "vw_data_quality_issues": dq_issues(stg.tables()),
        "vw_warehouse_reconciliation": wide,
        "vw_warehouse_reconciliation_display": reconcile.recon_display(wide),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
