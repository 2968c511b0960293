"""Declarative data-quality and integrity checks, evaluated in few passes.

A check measures one number. Checks that only need a row predicate or a row
count of one table are fused: every such check of a table becomes a column of
ONE aggregate over that table (``count_if`` per predicate), which is then
unpivoted to rows. Checks that need joins or grouping build their own one-row
aggregate. Results never leave the cluster except as the small report.

Rules decide the status of a measured value:
  zero      must be 0                          PASS / FAIL
  positive  must be > 0                        PASS / FAIL
  equals    must equal the expected value      PASS / FAIL
  anomaly   known issue; without an expectation WARN when > 0, PASS at 0;
            with one, WARN (or PASS at 0) when equal, FAIL otherwise
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.functions.expr import abs_diff, any_null
from martforge.functions.expr import UNKNOWN_CITY
from martforge.operators.calendar import day_series
from martforge.operators.combine import side_by_side
from martforge.operators.joins import count_rows, duplicate_keys, orphans, sized_broadcast, with_match
from martforge.plans.marts import distinct_counts
from martforge.schemas import REQUIRED, TOTAL

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Check:
    name: str
    stage: str
    rule: str
    table: str | None = None                  # fused checks: the table scanned
    predicate: Callable[[], Column] | None = None   # count_if(predicate); None = row count
    frame: Callable[[Tables], DataFrame] | None = None  # one row: actual [, expected]
    money: bool = False                       # value is an amount, not a count
    expected: int | None = None               # configured expectation
    column: str = "actual"                    # frame column holding the value
    expected_column: str | None = None        # frame column holding a measured expectation


@dataclass
class Expectations:
    """Per-dataset expected values (anomaly counts, staging row counts)."""
    values: dict[str, int] = field(default_factory=dict)


# --- frames for checks that need more than one predicate ------------------------

def _dup(table: str, keys: list[str], unlike: bool = False):
    return lambda t: duplicate_keys(t[table], keys, unlike=unlike)


def _order_before_signup(t: Tables) -> DataFrame:
    o, c = t["stg_orders"], t["stg_customers"]
    j = (o.select("customer_id", "order_date")
          .join(sized_broadcast(c.select("customer_id", "signup_date"), size_of=c), "customer_id")
          .where(F.col("order_date") < F.col("signup_date")))
    return count_rows(j)


def _price_mismatch(t: Tables) -> DataFrame:
    i, p = t["stg_order_items"], t["stg_products"]
    j = (i.select("product_id", "unit_price")
          .join(sized_broadcast(p.select("product_id", "price"), size_of=p), "product_id")
          .where(F.col("price").isNotNull() & (F.col("unit_price") != F.col("price"))))
    return count_rows(j)


def _missing_calendar_dates(t: Tables) -> DataFrame:
    d = t["dim_date"]
    bounds = d.agg(F.min("full_date").alias("lo"), F.max("full_date").alias("hi"))
    return count_rows(orphans(day_series(bounds, "lo", "hi", "d"), d, "d", "full_date"))


def _dims_vs_staging(t: Tables) -> DataFrame:
    """Dimension sizes and calendar bounds next to what staging says they must be."""
    dc = t["dim_customer"].agg(F.count(F.lit(1)).cast("bigint").alias("dim_customer_rows"))
    dp = t["dim_product"].agg(F.count(F.lit(1)).cast("bigint").alias("dim_product_rows"))
    dd = t["dim_date"].agg(F.count(F.lit(1)).cast("bigint").alias("dim_date_rows"),
                           F.min("full_date").alias("c_lo"), F.max("full_date").alias("c_hi"))
    sc = t["stg_customers"].agg(F.count_distinct("customer_id").cast("bigint").alias("stg_customer_ids"))
    sp = t["stg_products"].agg(F.count(F.lit(1)).cast("bigint").alias("stg_product_rows"))
    so = t["stg_orders"].agg(F.min("order_date").alias("o_lo"), F.max("order_date").alias("o_hi"))
    row = side_by_side([dc, dp, dd, sc, sp, so])
    differs = lambda a, b: F.when(F.col(a).eqNullSafe(F.col(b)), 0).otherwise(1)
    return row.select(
        "dim_customer_rows", "stg_customer_ids", "dim_product_rows", "stg_product_rows", "dim_date_rows",
        F.coalesce(F.datediff("o_hi", "o_lo") + 1, F.lit(0)).cast("bigint").alias("calendar_days"),
        (differs("c_lo", "o_lo") + differs("c_hi", "o_hi")).cast("bigint").alias("bound_mismatches"))


def _recon_frame(t: Tables) -> DataFrame:
    """Reconciliation differences and the line balance of the exclusion audit, in one row."""
    both = side_by_side([t["recon"], t["line_balance"]])
    balance = (abs_diff(F.col("staged_rows"), F.col("loadable_rows") + F.col("excluded_rows"))
               + abs_diff(F.col("loadable_rows"), F.col("source_valid_rows")))
    return both.select(F.abs("row_difference").alias("rows"), F.abs("quantity_difference").alias("quantity"),
                       F.abs("sales_difference").alias("sales"), "fact_rows", "source_valid_rows",
                       balance.cast("bigint").alias("balance"))


def _flags(name: str, t: Tables) -> DataFrame:
    """Child tables with one match flag per parent, so that all orphan checks of
    a child table fuse into its single aggregate."""
    if name == "stg_orders_flags":
        return with_match(t["stg_orders"], t["stg_customers"], "customer_id", "_cust_ok")
    if name == "stg_items_flags":
        i = with_match(t["stg_order_items"], t["stg_products"], "product_id", "_prod_ok")
        return with_match(i, t["stg_orders"], "order_id", "_order_ok")
    if name == "fact_flags":
        f = with_match(t["fact_sales"], t["dim_customer"], "customer_key", "_cust_ok")
        f = with_match(f, t["dim_product"], "product_key", "_prod_ok")
        return with_match(f, t["dim_date"], "date_key", "_date_ok")
    raise KeyError(name)


def table_for(name: str, t: Tables) -> DataFrame:
    return t[name] if name in t else _flags(name, t)


def _coverage(t: Tables) -> DataFrame:
    return distinct_counts(t["fact_sales"], {"customer_key": "customers", "product_key": "products",
                                             "date_key": "dates"})


# --- the catalogue ---------------------------------------------------------------

def _col(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


def staging_checks() -> list[Check]:
    return [
        Check("duplicate_customer_ids", "staging", "anomaly", frame=_dup("stg_customers", ["customer_id"])),
        Check("missing_customer_cities", "staging", "anomaly", "stg_customers", lambda: F.col("city").isNull()),
        Check("missing_product_prices", "staging", "anomaly", "stg_products", lambda: F.col("price").isNull()),
        Check("missing_payment_methods", "staging", "anomaly", "stg_orders_flags",
              lambda: F.col("payment_method").isNull()),
        Check("orphan_customer_ids", "staging", "anomaly", "stg_orders_flags", lambda: ~F.col("_cust_ok")),
        Check("orphan_product_ids", "staging", "anomaly", "stg_items_flags", lambda: ~F.col("_prod_ok")),
        Check("invalid_quantities", "staging", "anomaly", "stg_items_flags", lambda: F.col("quantity") <= 0),
        Check("orphan_order_references", "staging", "zero", "stg_items_flags", lambda: ~F.col("_order_ok")),
        Check("order_before_signup", "staging", "zero", frame=_order_before_signup),
        Check("unit_price_mismatches", "staging", "zero", frame=_price_mismatch),
        # a repeated header would load its lines once per header
        Check("duplicate_order_ids", "staging", "zero", frame=_dup("stg_orders", ["order_id"])),
        Check("stg_customers_rows", "staging", "positive", "stg_customers"),
        Check("stg_products_rows", "staging", "positive", "stg_products"),
        Check("stg_orders_rows", "staging", "positive", "stg_orders_flags"),
        Check("stg_order_items_rows", "staging", "positive", "stg_items_flags"),
    ]


def warehouse_checks() -> list[Check]:
    # written apart from the builders' formulas, so that a wrong one shows
    wrong_amount = lambda: F.abs(F.col("sales_amount") - F.col("unit_price") * F.col("quantity")) >= F.lit(0.005)
    wrong_day = lambda: F.col("date_key").cast("string") != F.date_format("full_date", "yyyyMMdd")
    return [
        Check("dim_customer_rows", "dimensions", "equals", frame=_dims_vs_staging, column="dim_customer_rows",
              expected_column="stg_customer_ids"),
        Check("unknown_cities", "dimensions", "anomaly", "dim_customer", lambda: F.col("city") == UNKNOWN_CITY),
        Check("dim_customer_duplicate_ids", "dimensions", "zero", frame=_dup("dim_customer", ["customer_id"])),
        Check("dim_customer_nulls", "dimensions", "zero", "dim_customer",
              lambda: any_null(REQUIRED["dim_customer"])),
        Check("dim_product_rows", "dimensions", "equals", frame=_dims_vs_staging, column="dim_product_rows",
              expected_column="stg_product_rows"),
        Check("null_prices", "dimensions", "anomaly", "dim_product", lambda: F.col("price").isNull()),
        Check("dim_product_duplicate_ids", "dimensions", "zero", frame=_dup("dim_product", ["product_id"])),
        Check("dim_product_nulls", "dimensions", "zero", "dim_product", lambda: any_null(REQUIRED["dim_product"])),
        Check("dim_date_rows", "dimensions", "equals", frame=_dims_vs_staging, column="dim_date_rows",
              expected_column="calendar_days"),
        Check("dim_date_duplicate_dates", "dimensions", "zero", frame=_dup("dim_date", ["full_date"])),
        Check("missing_calendar_dates", "dimensions", "zero", frame=_missing_calendar_dates),
        Check("date_key_mismatches", "dimensions", "zero", "dim_date", wrong_day),
        Check("calendar_bounds_mismatches", "dimensions", "zero", frame=_dims_vs_staging, column="bound_mismatches"),
        Check("fact_rows", "fact", "equals", frame=_recon_frame, column="fact_rows",
              expected_column="source_valid_rows"),
        Check("duplicate_sales_keys", "fact", "zero", frame=_dup("fact_sales", ["sales_key"], unlike=True)),
        Check("fact_nulls", "fact", "zero", "fact_flags", lambda: any_null(REQUIRED["fact_sales"])),
        Check("fact_invalid_quantities", "fact", "zero", "fact_flags", lambda: F.col("quantity") <= 0),
        Check("sales_amount_mismatches", "fact", "zero", "fact_flags", wrong_amount),
        Check("orphan_customer_keys", "fact", "zero", "fact_flags", lambda: ~F.col("_cust_ok")),
        Check("orphan_product_keys", "fact", "zero", "fact_flags", lambda: ~F.col("_prod_ok")),
        Check("orphan_date_keys", "fact", "zero", "fact_flags", lambda: ~F.col("_date_ok")),
        Check("covered_customers", "fact", "positive", frame=_coverage, column="customers"),
        Check("covered_products", "fact", "positive", frame=_coverage, column="products"),
        Check("covered_dates", "fact", "positive", frame=_coverage, column="dates"),
        Check("row_difference", "reconciliation", "zero", frame=_recon_frame, column="rows"),
        Check("quantity_difference", "reconciliation", "zero", frame=_recon_frame, column="quantity"),
        Check("sales_difference", "reconciliation", "zero", frame=_recon_frame, column="sales", money=True),
        Check("exclusion_balance", "reconciliation", "zero", frame=_recon_frame, column="balance"),
    ]


def all_checks(expectations: Expectations | None = None) -> list[Check]:
    return configure(staging_checks() + warehouse_checks(), expectations)


def configure(checks: list[Check], expectations: Expectations | None) -> list[Check]:
    vals = (expectations or Expectations()).values
    out = []
    for c in checks:
        if c.name in vals:
            rule = "equals" if c.rule == "positive" else c.rule
            c = Check(c.name, c.stage, rule, c.table, c.predicate, c.frame, c.money, vals[c.name],
                      c.column, c.expected_column)
        out.append(c)
    return out


def by_name(name: str) -> Check:
    for c in staging_checks() + warehouse_checks():
        if c.name == name:
            return c
    raise KeyError(name)


# --- evaluation ------------------------------------------------------------------

_VALUE = "value"
_EXPECTED = "expected_value"


def _measure(c: Check) -> Column:
    if c.predicate is None:
        return F.count(F.lit(1))
    return F.count_if(c.predicate())


def measure_one(check: Check, tables: Tables) -> DataFrame:
    """One row ``(check, actual)`` for a single check."""
    if check.frame is not None:
        m = check.frame(tables).select(F.col(check.column).alias("actual"))
    else:
        m = table_for(check.table, tables).agg(_measure(check).alias("actual"))
    actual = F.col("actual").cast(TOTAL if check.money else "bigint")
    return m.select(F.lit(check.name).alias("check"), actual.alias("actual"))


def report_parts(checks: list[Check], tables: Tables) -> list[DataFrame]:
    """Raw report rows, one small DataFrame per scan: one aggregate per table for
    predicate checks, one evaluation per distinct frame for frame checks."""
    parts: list[DataFrame] = []
    fused: dict[str, list[Check]] = {}
    framed: dict[Callable, list[Check]] = {}
    for c in checks:
        if c.frame is None:
            fused.setdefault(c.table, []).append(c)
        else:
            framed.setdefault(c.frame, []).append(c)
    for table, cs in fused.items():
        agg = table_for(table, tables).agg(*[_measure(c).alias(f"m{i}") for i, c in enumerate(cs)])
        parts.append(_stacked(cs, agg))
    for frame, cs in framed.items():
        m = frame(tables)
        cols = []
        for i, c in enumerate(cs):
            cols.append(F.col(c.column).alias(f"m{i}"))
            if c.expected_column:
                cols.append(F.col(c.expected_column).alias(f"e{i}"))
        parts.append(_stacked(cs, m.select(*cols)))
    return [_with_configured(p, checks) for p in parts]


def _with_configured(raw: DataFrame, checks: list[Check]) -> DataFrame:
    """Configured expectations apply where none was measured."""
    conf = {c.name: c.expected for c in checks if c.expected is not None}
    if not conf:
        return raw
    e = F.col(_EXPECTED)
    for name, v in conf.items():
        e = F.when((F.col("check") == name) & F.col(_EXPECTED).isNull(), F.lit(v).cast(TOTAL)).otherwise(e)
    return raw.withColumn(_EXPECTED, e)


def measure_all(checks: list[Check], tables: Tables) -> DataFrame:
    parts = report_parts(checks, tables)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def evaluate(checks: list[Check], tables: Tables, threads: int = 8) -> DataFrame:
    """The report, computed part by part as concurrent small jobs.

    Same rows as ``report``; each part is one aggregate (a few rows), so only
    check results reach the driver. Small plans per job keep planning time
    flat, where one union of every part is re-planned after each stage.
    """
    from concurrent.futures import ThreadPoolExecutor

    parts = report_parts(checks, tables)
    with ThreadPoolExecutor(max_workers=threads) as pool:
        rows = [r for rs in pool.map(lambda p: p.collect(), parts) for r in rs]
    spark = parts[0].sparkSession
    raw = spark.createDataFrame(rows, parts[0].schema)
    return finish(raw)


def _sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _stacked(cs: list[Check], frame: DataFrame) -> DataFrame:
    """Unpivot the one-row ``frame`` (m0..mk [, e0..ek]) into one report row per check."""
    have = set(frame.columns)
    rows = []
    for i, c in enumerate(cs):
        exp = f"CAST(e{i} AS {TOTAL.simpleString()})" if f"e{i}" in have else f"CAST(NULL AS {TOTAL.simpleString()})"
        rows.append(f"named_struct('check', {_sql_str(c.name)}, 'stage', {_sql_str(c.stage)}, "
                    f"'rule', {_sql_str(c.rule)}, 'money', {str(c.money).lower()}, "
                    f"'{_VALUE}', CAST(m{i} AS {TOTAL.simpleString()}), '{_EXPECTED}', {exp})")
    return frame.selectExpr(f"inline(array({', '.join(rows)}))")


def _text(v: Column, money: Column) -> Column:
    return F.when(money, v.cast("string")).otherwise(v.cast("bigint").cast("string"))


def finish(raw: DataFrame) -> DataFrame:
    """Report columns: check, stage, actual, expected, status."""
    v, e, r, money = F.col(_VALUE), F.col(_EXPECTED), F.col("rule"), F.col("money")
    status = (F.when(r == "zero", F.when(v == 0, "PASS").otherwise("FAIL"))
              .when(r == "positive", F.when(v > 0, "PASS").otherwise("FAIL"))
              .when(r == "equals", F.when(v == e, "PASS").otherwise("FAIL"))
              .when(e.isNull(), F.when(v > 0, "WARN").otherwise("PASS"))
              .when(v == e, F.when(v > 0, "WARN").otherwise("PASS"))
              .otherwise("FAIL"))
    expected = (F.when(r == "zero", F.lit("0"))
                .when(r == "positive", F.lit(">0"))
                .otherwise(_text(e, money)))
    return raw.select("check", "stage", _text(v, money).alias("actual"), expected.alias("expected"),
                      status.alias("status"))


def report(checks: list[Check], tables: Tables) -> DataFrame:
    return finish(measure_all(checks, tables))


class GateFailed(ValueError):
    """Raised after ALL checks ran, listing every failed one."""


#: Share of a staging table's rows that an anomaly without a configured count may have.
ANOMALY_SHARE = 0.2

#: Staging table whose rows an anomaly counts.
ANOMALY_OF = {"duplicate_customer_ids": "stg_customers", "missing_customer_cities": "stg_customers",
              "missing_product_prices": "stg_products", "missing_payment_methods": "stg_orders",
              "orphan_customer_ids": "stg_orders", "orphan_product_ids": "stg_order_items",
              "invalid_quantities": "stg_order_items"}


def too_frequent(report_rows: list, row_counts: dict[str, int], share: float = ANOMALY_SHARE) -> list[str]:
    """Anomalies without a configured count that more than ``share`` of their table's rows have."""
    out = []
    for r in report_rows:
        table = ANOMALY_OF.get(r["check"])
        if table and r["expected"] is None and int(r["actual"]) > share * row_counts[table]:
            out.append(f"{r['check']}: actual={r['actual']} expected<={share:.0%} of {row_counts[table]} rows")
    return out


def raise_on_failures(report_rows: list, more: list[str] | None = None) -> None:
    failed = [f"{r['check']}: actual={r['actual']} expected={r['expected']}"
              for r in report_rows if r["status"] == "FAIL"] + (more or [])
    if failed:
        raise GateFailed(f"{len(failed)} check(s) failed: " + "; ".join(failed))


def health(report_df: DataFrame) -> DataFrame:
    s = F.col("status")
    return report_df.agg(
        F.count(F.lit(1)).cast("bigint").alias("checks_total"),
        F.count_if(s == "PASS").cast("bigint").alias("checks_passed"),
        F.count_if(s == "WARN").cast("bigint").alias("checks_warned"),
        F.count_if(s == "FAIL").cast("bigint").alias("checks_failed"),
    ).withColumn("pass_rate", F.coalesce(
        F.try_divide(F.col("checks_passed").cast("double"),
                     F.col("checks_total").cast("double")), F.lit(0.0)))
