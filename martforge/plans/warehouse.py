"""End-to-end build: staging -> gates -> dimensions -> fact -> gates -> publish."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.operators.combine import side_by_side
from martforge.operators.joins import prefetch_row_counts
from martforge.operators.sizing import sized_shuffles
from martforge.operators.skew import heavy_keys
from martforge.plans import audit, checks, reconcile
from martforge.plans.dims import build_dim_customer, build_dim_date, build_dim_product
from martforge.plans.facts import build_fact_sales
from martforge.plans.months import write_months
from martforge.plans.publish import Store, new_run_id
from martforge.plans.staging import Staging, read_staging
from martforge.schemas import FACT_SALES, STAGING, columns

log = logging.getLogger(__name__)


class _Steps:
    """Wall-clock per build step, kept on the returned handle (and logged)."""

    def __init__(self):
        self.t = time.time()
        self.times: dict[str, float] = {}

    def __call__(self, name: str) -> None:
        now = time.time()
        self.times[name] = round(now - self.t, 3)
        log.info("%s: %.2fs", name, now - self.t)
        self.t = now

#: Largest share of an extract's rows that may not parse.
REJECT_SHARE = 0.01
INTAKE = "table string, read_rows long, rejected_rows long, staged_rows long"
DIMENSIONS = ("dim_customer", "dim_product", "dim_date")


@dataclass
class Warehouse:
    """Handle on one version of the warehouse (published or candidate)."""
    spark: SparkSession
    root: str
    run_id: str
    step_seconds: dict | None = None
    _reads: dict = field(default_factory=dict, repr=False)

    @property
    def store(self) -> Store:
        return Store(self.spark, self.root)

    def table(self, name: str) -> DataFrame:
        """A table of this version (the DataFrame is reused: versions are immutable)."""
        if name not in self._reads:
            df = self.store.read(name, self.run_id)
            self._reads[name] = df.select(*columns(FACT_SALES)) if name == "fact_sales" else df
        return self._reads[name]

    def staging(self) -> Staging:
        return Staging(*[self.table(n) for n in ("stg_customers", "stg_products", "stg_orders",
                                                   "stg_order_items")])

    def tables(self) -> dict[str, DataFrame]:
        t = dict(self.staging().tables())
        for n in DIMENSIONS + ("fact_sales",):
            t[n] = self.table(n)
        return t


def check_tables(stg: Staging, dims: dict[str, DataFrame], fact: DataFrame | None,
                 quarantine: DataFrame | None = None) -> dict[str, DataFrame]:
    """Everything the check catalogue reads, derived from persisted tables.

    With the version's written ``quarantine`` the line balance counts it instead
    of recomputing the exclusion audit (one join of lines with orders fewer).
    """
    t: dict[str, DataFrame] = dict(stg.tables())
    t.update(dims)
    # lookup sides whose size decides broadcast vs shuffle, counted in one job
    prefetch_row_counts([stg.customers, stg.products, stg.orders, *dims.values()])
    if fact is not None:
        t["fact_sales"] = fact
        src = reconcile.source_totals(stg, dims["dim_customer"], dims["dim_product"], dims["dim_date"])
        t["recon"] = reconcile.recon_wide(src, reconcile.fact_totals(fact))
        if quarantine is not None:
            t["line_balance"] = audit.balance_from_quarantine(stg.order_items, quarantine)
        else:
            lines = audit.line_audit(stg, dims["dim_customer"], dims["dim_product"], dims["dim_date"])
            t["line_balance"] = audit.line_balance(lines)
    return t


def _collect_report(report: DataFrame, path: str) -> list:
    report.coalesce(1).write.mode("errorifexists").parquet(path)
    return report.sparkSession.read.parquet(path).collect()


def build(spark: SparkSession, staging: Staging, root: str,
          expectations: checks.Expectations | None = None, fingerprint: str = "",
          run_id: str | None = None, month_partitions: bool = False,
          anomaly_share: float = checks.ANOMALY_SHARE, intake: dict | None = None,
          reject_share: float = REJECT_SHARE) -> Warehouse:
    """Build and publish one version; raise ``GateFailed`` (nothing published) on a failed gate.

    A run is published only on top of the commit that it began from: of two that race, the later one to finish gets
    ``CommitConflict`` (its version folder stays unpublished) and may be run again.

    The fact is written in its key order: each file holds a contiguous range of
    sales keys (range partitions of the key build), so file and row-group
    statistics on ``sales_key``/``order_id`` prune order lookups. Shuffles are
    sized by the staged rows (see ``sizing``). With
    ``month_partitions`` it is clustered into ``year_month=`` folders instead
    (see ``months``), for date pruning and month-wise replacement.
    """
    step = _Steps()
    store = Store(spark, root)
    parent = store.latest()
    run_id = run_id or new_run_id()
    vdir = store.version_dir(run_id)

    _concurrently([lambda n=n, df=df: df.write.mode("errorifexists").parquet(f"{vdir}/{n}")
                   for n, df in _conformed(staging).items()])
    stg = read_staging(spark, vdir)
    pre, pre_content = _staging_counts(stg), _content(stg.tables())
    if intake:
        _write_rejects(spark, intake, pre, vdir, reject_share)
    step("staging")

    with sized_shuffles(spark, max(pre.values())):
        stg_checks = checks.configure(checks.staging_checks(), expectations)
        rows = _collect_report(checks.evaluate(stg_checks, stg.tables()), f"{vdir}/_staging_report")
        checks.raise_on_failures(rows, checks.too_frequent(rows, pre, anomaly_share))
        staging_rows = rows
        step("staging_gate")

        _concurrently([
            lambda: build_dim_customer(stg.customers).write.mode("errorifexists").parquet(f"{vdir}/dim_customer"),
            lambda: build_dim_product(stg.products).write.mode("errorifexists").parquet(f"{vdir}/dim_product"),
            lambda: build_dim_date(stg.orders).write.mode("errorifexists").parquet(f"{vdir}/dim_date"),
        ])
        dims = {n: spark.read.parquet(f"{vdir}/{n}") for n in DIMENSIONS}
        step("dimensions")

        dims_before = _content(dims)
        fact = build_fact_sales(stg.order_items, stg.orders, dims["dim_customer"], dims["dim_product"],
                                dims["dim_date"], heavy_orders=heavy_keys(stg.order_items, "order_id"))
        if month_partitions:
            write_months(fact, f"{vdir}/fact_sales")
        else:
            fact.write.mode("errorifexists").parquet(f"{vdir}/fact_sales")
        fact = spark.read.parquet(f"{vdir}/fact_sales").select(*columns(FACT_SALES))
        step("fact")

        lines = audit.line_audit(stg, dims["dim_customer"], dims["dim_product"], dims["dim_date"])
        audit.excluded_lines(lines).write.mode("errorifexists").parquet(f"{vdir}/quarantine")
        step("quarantine")

        # staging is immutable, so its checks hold as they were; the rest is measured now
        measured = {r["check"] for r in staging_rows}
        all_checks = [c for c in checks.all_checks(expectations) if c.name not in measured]
        quarantine = spark.read.parquet(f"{vdir}/quarantine")
        found = checks.evaluate(all_checks, check_tables(stg, dims, fact, quarantine))
        rows = _collect_report(spark.read.parquet(f"{vdir}/_staging_report").unionByName(found),
                               f"{vdir}/validation_report")
        post = _content(read_staging(spark, vdir).tables())
        if pre_content != post:
            raise checks.GateFailed(f"staging changed during the build: {pre_content} -> {post}")
        dims_after = _content({n: spark.read.parquet(f"{vdir}/{n}") for n in DIMENSIONS})
        if dims_before != dims_after:
            raise checks.GateFailed(f"dimensions changed during the fact load: {dims_before} -> {dims_after}")
        checks.raise_on_failures(rows)
        step("warehouse_gate")

    store.commit(run_id, fingerprint, parent)
    step("commit")
    log.info("published %s", run_id)
    return Warehouse(spark, root, run_id, step.times)


def _write_rejects(spark: SparkSession, intake: dict, staged: dict[str, int], vdir: str, share: float) -> None:
    """``rejects`` (raw lines that do not parse, with file and reasons) and ``intake`` (counts per table) of a version.

    Rows read and rejected were counted while staging was written. What was read must be what is staged plus what was
    rejected, and no table may lose more than ``share`` of its rows.
    """
    counts = {table: taken.counts() for table, taken in intake.items()}
    rows = [(table, read, rejected, staged[table]) for table, (read, rejected) in sorted(counts.items())]
    spark.createDataFrame(rows, INTAKE).coalesce(1).write.mode("errorifexists").parquet(f"{vdir}/intake")
    parts = [intake[t].rejects for t, (_, rejected) in counts.items() if rejected] or [next(iter(intake.values())).rejects.limit(0)]
    reduce(DataFrame.unionByName, parts).write.mode("errorifexists").parquet(f"{vdir}/rejects")
    written = {r["extract"]: r["count"] for r in spark.read.parquet(f"{vdir}/rejects").groupBy("extract").count().collect()}
    problems = []
    for table, read, rejected, kept in rows:
        if read != kept + rejected or written.get(intake[table].name, 0) != rejected:
            problems.append(f"{table}: {read} rows read, but {kept} staged and {rejected} rejected")
        if rejected > share * read:
            problems.append(f"{table}: {rejected} of {read} rows do not parse")
    if problems:
        raise checks.GateFailed("; ".join(problems))


def line_intake(wh: Warehouse) -> DataFrame:
    """Where the order lines of the extract went: read = rejected + excluded + loaded."""
    of_lines = wh.store.read("intake", wh.run_id).where("table = 'stg_order_items'").select("read_rows", "rejected_rows")
    count = lambda table, name: wh.store.read(table, wh.run_id).agg(F.count(F.lit(1)).alias(name))
    return side_by_side([of_lines, count("quarantine", "excluded_rows"), count("fact_sales", "loaded_rows")]).select(
        "read_rows", "rejected_rows", "excluded_rows", "loaded_rows")


def _concurrently(jobs: list) -> None:
    """Run independent Spark jobs (e.g. writes of different tables) at the same
    time, so small tables do not leave the cluster idle one after another."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for f in [pool.submit(j) for j in jobs]:
            f.result()


def _conformed(staging: Staging) -> dict[str, DataFrame]:
    return {n: df.select(*columns(STAGING[n])) for n, df in staging.tables().items()}


def _staging_counts(stg: Staging) -> dict[str, int]:
    return _counts(stg.tables())


def _counts(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Row counts of several tables in one job (one small row per table)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("t"), "n")
             for name, df in tables.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return {r["t"]: r["n"] for r in u.collect()}


def _content(tables: dict[str, DataFrame]) -> dict[str, tuple]:
    """Row count and an order-free hash over all values of several tables, in one job."""
    parts = [df.select(F.xxhash64(*df.columns).cast("decimal(38,0)").alias("h"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("h"))
             .select(F.lit(name).alias("t"), "n", "h") for name, df in tables.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return {r["t"]: (r["n"], r["h"]) for r in u.collect()}


def current(spark: SparkSession, root: str) -> Warehouse | None:
    rid = Store(spark, root).current()
    return Warehouse(spark, root, rid) if rid else None


def run_from_extracts(spark: SparkSession, source_dir: str, root: str,
                      expectations: checks.Expectations | None = None, strict: bool = True,
                      reject_share: float = REJECT_SHARE) -> Warehouse:
    """The whole job from raw CSV extracts: validate source, ingest, build, gate, publish.

    A row that does not parse ends a ``strict`` run. Otherwise it is written to the version's ``rejects`` and the rest
    is loaded, unless a table loses more than ``reject_share`` of its rows.
    """
    from martforge.sources.extracts import ingest, ingest_with_rejects
    if strict:
        return build(spark, ingest(spark, source_dir), root, expectations=expectations)
    staging, intake = ingest_with_rejects(spark, source_dir)
    return build(spark, staging, root, expectations=expectations, intake=intake, reject_share=reject_share)
