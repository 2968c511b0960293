"""Every query of the library by name: (spark, sf_dir) -> DataFrame.

Operator queries (staging, dimensions, fact) build their table from the test
tables under ``sf_dir``. Report queries (checks, reconciliation, marts) run
over a published warehouse version built from the same tables; the version is
built once per source fingerprint and reused, as reports over a warehouse are.
"""

from __future__ import annotations

import datetime
import hashlib
import os
import threading
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.operators.combine import side_by_side
from martforge.operators.joins import row_count
from martforge.operators.sizing import sized_shuffles
from martforge.plans import audit, checks, marts, reconcile, views
from martforge.plans.dims import build_dim_customer, build_dim_date, build_dim_product
from martforge.plans.facts import build_fact_sales
from martforge.plans.incremental import (BEGINNING, customer_history, customer_versions, fact_versions, load_orders,
                                         revenue_by_city_then)
from martforge.plans.maintain import MaintainedFact
from martforge.plans.months import read_months, replace_months, write_months
from martforge.plans.publish import CommitConflict, Store
from martforge.plans.staging import Staging, derived_staging, mutated_staging
from martforge.plans.warehouse import Warehouse, build, check_tables
from martforge.schemas import STG_ORDER_ITEMS, STG_PRODUCTS, columns
from martforge.session import materialize, scratch_path, scratch_root
from martforge.sources import tpch
from martforge.sources.extracts import read_extract, take_in, write_extract

SOURCE_TABLES = ("customer", "nation", "region", "part", "orders", "lineitem")

_LOCK = threading.RLock()
_MEMO: dict[tuple, Warehouse] = {}


def _code_hash() -> str:
    h = hashlib.sha1()
    base = os.path.dirname(__file__)
    for dirpath, _, files in sorted(os.walk(base)):
        if os.path.basename(dirpath) == "llm":  # has no part in the warehouse
            continue
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(dirpath, f), "rb") as fh:
                    h.update(fh.read())
    return h.hexdigest()[:12]


def source_fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Identity of the inputs: file names, sizes, modification times, code version.

    All tables, each a single file or a folder of part files, are listed anew in one job and aggregated in Spark to
    one row a table; a table without files raises.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load([f"{sf_dir}/{t}.parquet" for t in SOURCE_TABLES]).select("path", "length", "modificationTime"))
    table = F.regexp_extract("path", f".*/({'|'.join(SOURCE_TABLES)})[.]parquet(/|$)", 1)
    found = files.groupBy(table.alias("name")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
        F.bit_xor(F.xxhash64(F.substring_index("path", "/", -1), "length", "modificationTime")).alias("hash"))
    rows = sorted(tuple(r) for r in found.collect())
    empty = sorted(set(SOURCE_TABLES) - {r[0] for r in rows})
    if empty:
        raise FileNotFoundError(f"no files of {', '.join(empty)} under {sf_dir}")
    return hashlib.sha1(repr((rows, _code_hash())).encode()).hexdigest()[:16]


def _app_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # sessions without a SparkContext
        return str(id(spark))


def published_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    sf_dir = sf_dir.rstrip("/")
    with _LOCK:
        fp = source_fingerprint(spark, sf_dir)
        key = (_app_id(spark), sf_dir, fp)
        if key in _MEMO:
            return _MEMO[key]
        root = f"{scratch_root(spark)}/martforge/warehouse-{hashlib.sha1(sf_dir.encode()).hexdigest()[:12]}"
        rid = Store(spark, root).current(fingerprint=fp)
        with sized_shuffles(spark, 0 if rid else tpch.read_table(spark, sf_dir, "lineitem").count()):
            try:
                wh = Warehouse(spark, root, rid) if rid else build(spark, derived_staging(spark, sf_dir), root,
                                                                   fingerprint=fp)
            except CommitConflict:  # another session published meanwhile, perhaps from the same inputs
                rid = Store(spark, root).current(fingerprint=fp)
                wh = Warehouse(spark, root, rid) if rid else build(spark, derived_staging(spark, sf_dir), root,
                                                                   fingerprint=fp)
        _MEMO[key] = wh
        return wh


def use_warehouse(spark: SparkSession, sf_dir: str, wh: Warehouse) -> None:
    """Serve report queries for ``sf_dir`` from an already built version."""
    sf_dir = sf_dir.rstrip("/")
    with _LOCK:
        _MEMO[(_app_id(spark), sf_dir, source_fingerprint(spark, sf_dir))] = wh


# --- operator queries ------------------------------------------------------------

def _stg(spark, sf_dir) -> Staging:
    return derived_staging(spark, sf_dir)


def q_dim_customer(spark, sf_dir):
    return build_dim_customer(_stg(spark, sf_dir).customers)


def q_dim_product(spark, sf_dir):
    return build_dim_product(_stg(spark, sf_dir).products)


def q_dim_date(spark, sf_dir):
    return build_dim_date(_stg(spark, sf_dir).orders)


def q_fact_sales(spark, sf_dir):
    s = _stg(spark, sf_dir)
    return build_fact_sales(s.order_items, s.orders, build_dim_customer(s.customers),
                            build_dim_product(s.products), build_dim_date(s.orders))


def q_fact_sales_incremental(spark, sf_dir):
    """The fact loaded up to the middle of the calendar, then the rest after that watermark."""
    s = _stg(spark, sf_dir)
    dims = [materialize(d, "dims") for d in (build_dim_customer(s.customers), build_dim_product(s.products),
                                             build_dim_date(s.orders))]
    span = dims[2].agg(F.min("full_date").alias("lo"), F.max("full_date").alias("hi")).first()
    middle = span["lo"] + (span["hi"] - span["lo"]) / 2
    fact = materialize(load_orders(None, s.orders, s.order_items, *dims, upto=middle), "fact-first")
    more = load_orders(fact, s.orders, s.order_items, *dims, after=middle)
    return fact.unionByName(more).drop("sales_key")


def q_dim_customer_scd2(spark, sf_dir):
    """Customer history after two snapshots: some customers moved, some left in between."""
    first = _stg(spark, sf_dir).customers
    second = (first.where("customer_id % 50 <> 7")
              .withColumn("city", F.when(F.col("customer_id") % 10 == 3,
                                         F.concat(F.coalesce("city", F.lit("Unknown")), F.lit(" (moved)")))
                          .otherwise(F.col("city"))))
    return customer_history(customer_history(None, first, BEGINNING), second, datetime.date(1998, 1, 1))


def _star(spark, sf_dir) -> tuple[Staging, list[DataFrame]]:
    """Staged tables and dimensions; orders and lines are stored, as they are read several times."""
    s = _stg(spark, sf_dir)
    s = s.replace(orders=materialize(s.orders, "orders"), order_items=materialize(s.order_items, "lines"))
    return s, [materialize(d, "dims") for d in (build_dim_customer(s.customers), build_dim_product(s.products),
                                                build_dim_date(s.orders))]


def q_fact_sales_refreshed(spark, sf_dir):
    """The fact kept by change capture: loaded with orders and lines missing and a changed price, then refreshed."""
    s, dims = _star(spark, sf_dir)
    fact = MaintainedFact(spark, scratch_path(spark, "maintained"), width=10_000)
    early = s.orders.where("order_id % 7 <> 3")  # whatever their dates
    lines = (s.order_items.where("product_id % 11 <> 5")
             .withColumn("unit_price", F.when(F.col("order_id") % 13 == 1, F.col("unit_price") + 1)
                         .otherwise(F.col("unit_price")).cast(s.order_items.schema["unit_price"].dataType)))
    fact.refresh(lines, early, dims)
    fact.refresh(s.order_items, s.orders, dims)
    return fact.read()


def q_fact_sales_streamed(spark, sf_dir):
    """The fact from a stream of files: lines of which some come before and some long after their orders."""
    s, dims = _star(spark, sf_dir)
    root = scratch_path(spark, "streamed")
    fact = MaintainedFact(spark, f"{root}/table", width=10_000)
    lines = s.order_items
    for orders, items in ((s.orders.where("order_id % 3 <> 1"), lines.where("product_id % 5 <> 2")),
                          (s.orders.where("order_id % 3 = 1"), lines.where("product_id % 5 = 2 or product_id is null"))):
        orders.coalesce(2).write.mode("append").parquet(f"{root}/landing/orders")
        items.coalesce(2).write.mode("append").parquet(f"{root}/landing/order_items")
        fact.follow(f"{root}/landing", lambda: dims, f"{root}/checkpoint", files_per_batch=2)
    return fact.read()


def q_fact_sales_months(spark, sf_dir):
    """The published fact laid out by month, its first and last month loaded with wrong amounts and then replaced."""
    wh = _wh(spark, sf_dir)
    fact, path = wh.table("fact_sales"), scratch_path(spark, "fact-months")
    span = fact.agg(F.min(F.expr("date_key DIV 100")).alias("lo"), F.max(F.expr("date_key DIV 100")).alias("hi")).first()
    edge = F.expr("date_key DIV 100").isin(span["lo"], span["hi"])
    amount = fact.schema["sales_amount"].dataType
    write_months(fact.withColumn("sales_amount", F.when(edge, F.lit(0)).otherwise(F.col("sales_amount")).cast(amount)), path)
    replace_months(fact.where(edge), path)
    return read_months(spark, path)


def _versions(spark, sf_dir) -> DataFrame:
    return materialize(customer_versions(q_dim_customer_scd2(spark, sf_dir)), "versions")


def q_fact_sales_versions(spark, sf_dir):
    """The published fact with the customer's version valid on the day of each order."""
    wh = _wh(spark, sf_dir)
    return fact_versions(wh.table("fact_sales"), wh.table("dim_customer"), wh.table("dim_date"), _versions(spark, sf_dir))


def q_revenue_by_city_then(spark, sf_dir):
    wh, versions = _wh(spark, sf_dir), _versions(spark, sf_dir)
    return revenue_by_city_then(fact_versions(wh.table("fact_sales"), wh.table("dim_customer"), wh.table("dim_date"),
                                              versions), versions)


def q_csv_roundtrip(spark, sf_dir):
    """Staged products written as CSV extract and read back by header name."""
    path = scratch_path(spark, "products.csv")
    write_extract(_stg(spark, sf_dir).products, path)
    return read_extract(spark, path, STG_PRODUCTS)


def q_csv_rejects(spark, sf_dir):
    """Staged order lines written as text, some with values that do not parse: rejects by reason, and the rows loaded."""
    path = scratch_path(spark, "order_items.csv")
    text = _stg(spark, sf_dir).order_items.select(*[F.col(c).cast("string").alias(c) for c in columns(STG_ORDER_ITEMS)])
    key = F.col("order_id").cast("long")
    text = (text.withColumn("quantity", F.when(key % 97 == 5, "many").otherwise(F.col("quantity")))
            .withColumn("unit_price", F.when(key % 89 == 7, "3.00 each").otherwise(F.col("unit_price"))))
    write_extract(text, path)
    taken = take_in(spark, path, "order_items.csv", STG_ORDER_ITEMS)
    rows, rejects = materialize(taken.rows, "csv-rows"), materialize(taken.rejects, "csv-rejects")
    loaded = rows.select(F.lit("loaded").alias("reasons"))
    return (rejects.select(F.concat_ws(",", "reasons").alias("reasons")).unionByName(loaded)
            .groupBy("reasons").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")))


# --- report queries over the published warehouse ------------------------------------

def _wh(spark, sf_dir) -> Warehouse:
    return published_warehouse(spark, sf_dir)


def _sized(wh: Warehouse):
    """Shuffles sized by the largest staged table, whose rows the files' footers tell."""
    return sized_shuffles(wh.spark, row_count(wh.table("stg_order_items")))


def _few(wh: Warehouse, rows: Callable[[], DataFrame], label: str) -> DataFrame:
    """A result of few rows over large tables, computed and stored here, where its shuffles can be sized."""
    with _sized(wh):
        return materialize(rows(), label)


def _dims(wh: Warehouse) -> dict[str, DataFrame]:
    return {n: wh.table(n) for n in ("dim_customer", "dim_product", "dim_date")}


def _counts(tables: dict[str, DataFrame], names: list[str]) -> DataFrame:
    parts = [tables[n].agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
             .select(F.lit(n).alias("table_name"), "row_count") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_row_counts(spark, sf_dir):
    return _counts(_wh(spark, sf_dir).staging().tables(),
                   ["stg_customers", "stg_products", "stg_orders", "stg_order_items"])


def q_wh_dim_counts(spark, sf_dir):
    return _counts(_dims(_wh(spark, sf_dir)), ["dim_customer", "dim_product", "dim_date"])


def _single(check_name: str, mutated: bool = False):
    def q(spark, sf_dir):
        wh = _wh(spark, sf_dir)
        stg = wh.staging()
        if mutated:
            stg = mutated_staging(stg)
        t = dict(stg.tables())
        t.update(_dims(wh))
        t["fact_sales"] = wh.table("fact_sales")
        return _few(wh, lambda: checks.measure_one(checks.by_name(check_name), t), "check")
    return q


def q_dq_issues(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return _few(wh, lambda: views.dq_issues(wh.staging().tables()), "dq-issues")


def q_dim_date_bounds(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    cal = wh.table("dim_date").agg(F.min("full_date").alias("calendar_start"),
                                   F.max("full_date").alias("calendar_end"),
                                   F.count(F.lit(1)).cast("bigint").alias("calendar_days"))
    org = wh.staging().orders.agg(F.min("order_date").alias("order_start"),
                                  F.max("order_date").alias("order_end"))
    return side_by_side([cal, org]).select("calendar_start", "calendar_end", "calendar_days",
                                           "order_start", "order_end")


def q_fact_metrics(spark, sf_dir):
    fact = _wh(spark, sf_dir).table("fact_sales")
    return fact.agg(F.count(F.lit(1)).cast("bigint").alias("fact_rows"),
                    F.count_distinct("order_id").cast("bigint").alias("distinct_orders"),
                    F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("total_quantity"),
                    F.coalesce(F.sum("sales_amount"), F.lit(0)).cast("decimal(24,2)").alias("total_sales"))


def _source_totals(wh: Warehouse) -> DataFrame:
    d = _dims(wh)
    return _few(wh, lambda: reconcile.source_totals(wh.staging(), d["dim_customer"], d["dim_product"], d["dim_date"]),
                "source-totals")


def q_recon_source_totals(spark, sf_dir):
    return _source_totals(_wh(spark, sf_dir))


def q_valid_source_rows(spark, sf_dir):
    return _source_totals(_wh(spark, sf_dir)).select(F.col("source_valid_rows").alias("valid_rows"))


def _audit(wh: Warehouse) -> DataFrame:
    d = _dims(wh)
    return audit.line_audit(wh.staging(), d["dim_customer"], d["dim_product"], d["dim_date"])


def q_excluded_rows(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    bal = _few(wh, lambda: audit.line_balance(_audit(wh)), "line-balance")
    return bal.select("staged_rows", F.col("loadable_rows").alias("valid_rows"), "excluded_rows")


def q_exclusion_audit(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return _few(wh, lambda: audit.exclusion_summary(_audit(wh)), "exclusions")


def q_quarantine_lines(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return _few(wh, lambda: audit.excluded_lines(_audit(wh)), "excluded-lines")


def _recon_wide(wh: Warehouse) -> DataFrame:
    return reconcile.recon_wide(_source_totals(wh), reconcile.fact_totals(wh.table("fact_sales")))


def q_recon_wide(spark, sf_dir):
    return _recon_wide(_wh(spark, sf_dir))


def q_recon_display(spark, sf_dir):
    return reconcile.recon_display(_recon_wide(_wh(spark, sf_dir)))


def q_wh_coverage(spark, sf_dir):
    return marts.distinct_counts(_wh(spark, sf_dir).table("fact_sales"), {
        "customer_key": "distinct_customers", "product_key": "distinct_products", "date_key": "distinct_dates"})


def _report(wh: Warehouse, mutated: bool = False) -> DataFrame:
    stg = wh.staging()
    fact = wh.table("fact_sales")
    with _sized(wh):
        if mutated:
            # the written quarantine belongs to the clean staging: audit the mutated lines afresh
            return checks.evaluate(checks.all_checks(), check_tables(mutated_staging(stg), _dims(wh),
                                                                     tpch.fact_sales_mut(fact)))
        return checks.evaluate(checks.all_checks(), check_tables(stg, _dims(wh), fact, wh.table("quarantine")))


def q_validation_report(spark, sf_dir):
    return _report(_wh(spark, sf_dir))


def q_validation_report_mutated(spark, sf_dir):
    return _report(_wh(spark, sf_dir), mutated=True)


def q_pipeline_health(spark, sf_dir):
    """Health card of the published run: pass share of the gate report it wrote."""
    return checks.health(_wh(spark, sf_dir).table("validation_report"))


def _mart(fn: Callable, *dims: str):
    def q(spark, sf_dir):
        wh = _wh(spark, sf_dir)
        return fn(wh.table("fact_sales"), *[wh.table(d) for d in dims])
    return q


def q_customer_acquisition(spark, sf_dir):
    return marts.customer_acquisition(_wh(spark, sf_dir).table("dim_customer"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stg_customers": lambda s, d: _stg(s, d).customers,
    "stg_products": lambda s, d: _stg(s, d).products,
    "stg_orders": lambda s, d: _stg(s, d).orders,
    "stg_order_items": lambda s, d: _stg(s, d).order_items,
    "dim_customer": q_dim_customer,
    "dim_product": q_dim_product,
    "dim_date": q_dim_date,
    "fact_sales": q_fact_sales,
    "fact_sales_incremental": q_fact_sales_incremental,
    "dim_customer_scd2": q_dim_customer_scd2,
    "fact_sales_refreshed": q_fact_sales_refreshed,
    "fact_sales_streamed": q_fact_sales_streamed,
    "fact_sales_months": q_fact_sales_months,
    "fact_sales_versions": q_fact_sales_versions,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_rejects": q_csv_rejects,
    "row_counts": q_row_counts,
    "dq_duplicate_customers": _single("duplicate_customer_ids"),
    "dq_missing_city": _single("missing_customer_cities"),
    "dq_missing_price": _single("missing_product_prices"),
    "dq_missing_payment": _single("missing_payment_methods"),
    "dq_orphan_customers": _single("orphan_customer_ids"),
    "dq_orphan_products": _single("orphan_product_ids"),
    "dq_invalid_quantity": _single("invalid_quantities"),
    "dq_issues": q_dq_issues,
    "int_orphan_orders": _single("orphan_order_references"),
    "int_order_before_signup": _single("order_before_signup"),
    "int_price_mismatch": _single("unit_price_mismatches"),
    "int_orphan_orders_mutated": _single("orphan_order_references", mutated=True),
    "int_order_before_signup_mutated": _single("order_before_signup", mutated=True),
    "int_price_mismatch_mutated": _single("unit_price_mismatches", mutated=True),
    "dim_date_bounds": q_dim_date_bounds,
    "fact_metrics": q_fact_metrics,
    "valid_source_rows": q_valid_source_rows,
    "excluded_rows": q_excluded_rows,
    "exclusion_audit": q_exclusion_audit,
    "quarantine_lines": q_quarantine_lines,
    "recon_source_totals": q_recon_source_totals,
    "recon_wide": q_recon_wide,
    "recon_display": q_recon_display,
    "wh_dim_counts": q_wh_dim_counts,
    "wh_unknown_cities": _single("unknown_cities"),
    "wh_customer_dups": _single("dim_customer_duplicate_ids"),
    "wh_customer_nulls": _single("dim_customer_nulls"),
    "wh_product_dups": _single("dim_product_duplicate_ids"),
    "wh_product_nulls": _single("dim_product_nulls"),
    "wh_null_prices": _single("null_prices"),
    "wh_date_dups": _single("dim_date_duplicate_dates"),
    "wh_missing_calendar_dates": _single("missing_calendar_dates"),
    "wh_date_key_mismatch": _single("date_key_mismatches"),
    "wh_sales_key_dups": _single("duplicate_sales_keys"),
    "wh_fact_nulls": _single("fact_nulls"),
    "wh_invalid_quantity": _single("fact_invalid_quantities"),
    "wh_sales_mismatch": _single("sales_amount_mismatches"),
    "wh_orphan_customer_keys": _single("orphan_customer_keys"),
    "wh_orphan_product_keys": _single("orphan_product_keys"),
    "wh_orphan_date_keys": _single("orphan_date_keys"),
    "wh_coverage": q_wh_coverage,
    "validation_report": q_validation_report,
    "validation_report_mutated": q_validation_report_mutated,
    "pipeline_health": q_pipeline_health,
    "kpi_measures": _mart(marts.kpi_measures),
    "mart_revenue_by_category": _mart(marts.revenue_by_category, "dim_product"),
    "mart_monthly_revenue": _mart(marts.monthly_revenue, "dim_date"),
    "mart_quarterly_growth": _mart(marts.quarterly_growth, "dim_date"),
    "mart_revenue_by_state": _mart(marts.revenue_by_state, "dim_customer"),
    "mart_customer_acquisition": q_customer_acquisition,
    "mart_top_products": _mart(marts.top_products, "dim_product"),
    "mart_asp_by_category": _mart(marts.asp_by_category, "dim_product"),
    "mart_city_performance": _mart(marts.city_performance, "dim_customer"),
    "mart_revenue_by_city_then": q_revenue_by_city_then,
    "measures_by_category_month": _mart(marts.measures_by_category_month, "dim_product", "dim_date"),
}
