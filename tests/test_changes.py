"""Folder tables, part files of different headers, commit order, scratch folder, marts on odd data, incremental loads."""

import datetime
import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from martforge import catalog, session
from martforge.plans import checks, incremental, marts
from martforge.plans.publish import Store
from martforge.plans.staging import Staging, derived_staging
from martforge.plans.warehouse import build
from martforge.schemas import STG_PRODUCTS
from martforge.sources import extracts as X


def test_added_part_file_changes_every_report(spark, tmp_root):
    for t in catalog.SOURCE_TABLES:
        spark.read.parquet(f"{SF001}/{t}.parquet").repartition(2).write.parquet(f"{tmp_root}/{t}.parquet")
    rows = {r["table_name"]: r["row_count"] for r in catalog.QUERIES["row_counts"](spark, tmp_root).collect()}
    sales = catalog.QUERIES["fact_metrics"](spark, tmp_root).first()["fact_rows"]
    assert rows["stg_order_items"] == 6000
    spark.read.parquet(f"{SF001}/lineitem.parquet").limit(500).write.mode("append").parquet(f"{tmp_root}/lineitem.parquet")
    rows = {r["table_name"]: r["row_count"] for r in catalog.QUERIES["row_counts"](spark, tmp_root).collect()}
    assert rows["stg_order_items"] == 6500
    assert catalog.QUERIES["fact_metrics"](spark, tmp_root).first()["fact_rows"] > sales
    wide = catalog.QUERIES["recon_wide"](spark, tmp_root).first()
    assert wide["row_difference"] == 0 and wide["fact_rows"] > sales


def test_table_without_files_raises(spark, tmp_root):
    for t in catalog.SOURCE_TABLES[1:]:
        shutil.copy(f"{SF001}/{t}.parquet", tmp_root)
    os.mkdir(f"{tmp_root}/{catalog.SOURCE_TABLES[0]}.parquet")
    with pytest.raises(FileNotFoundError):
        catalog.source_fingerprint(spark, tmp_root)


def parts(folder, *texts):
    os.makedirs(folder)
    for i, text in enumerate(texts):
        with open(f"{folder}/part-{i}.csv", "w") as f:
            f.write(text)


def test_part_files_are_read_by_their_own_headers(spark, tmp_root):
    path = f"{tmp_root}/products.csv"
    parts(path, "product_id,product_name,category,price\n1,alpha,tools,2.50\n",
          "product_id,category,more,product_name,price\n2,books,x,beta,3.00\n3,toys,y,\"gamma, big\",4.00\n")
    got = sorted(map(tuple, X.read_extract(spark, path, STG_PRODUCTS).collect()))
    assert [(r[0], r[1], r[2], str(r[3])) for r in got] == [
        (1, "alpha", "tools", "2.50"), (2, "beta", "books", "3.00"), (3, "gamma, big", "toys", "4.00")]


def test_column_missing_in_one_part_raises(spark, tmp_root):
    path = f"{tmp_root}/products.csv"
    parts(path, "product_id,product_name,category,price\n1,alpha,tools,2.50\n", "product_id,product_name,price\n2,beta,3.00\n")
    with pytest.raises(X.SourceError):
        X.read_extract(spark, path, STG_PRODUCTS)
    status = X.check_extract(spark, tmp_root, "products.csv", X.list_extracts(spark, tmp_root))
    assert status.missing_columns == ("category",) and not status.ok


def test_last_commit_wins(spark, tmp_root):
    store = Store(spark, tmp_root)
    assert store.current() is None
    for run in ("nightly", "20200101T000000-early", "b-started-first", "a-committed-last"):
        store.commit(run, fingerprint=run[0])
        assert store.current() == run
    assert store.current(fingerprint="n") == "nightly"


def test_cluster_without_shared_folder_raises(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        applicationId, master = "app-other", "spark://host:7077"
        getConf = lambda self: Conf()
        getCheckpointDir = lambda self: None

    class Session:
        sparkContext = Context()

    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        Context.master = master
        with pytest.raises(RuntimeError):
            session.scratch_root(Session())


def fact_rows(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "sales_key long, order_id long, customer_key long, "
                                 "product_key long, date_key int, quantity int, sales_amount double").withColumn(
        "sales_amount", F.col("sales_amount").cast("decimal(14,2)"))


def test_repeated_orders_count_once(spark):
    from martforge.operators.calendar import calendar_attributes, day_series
    bounds = spark.createDataFrame([(datetime.date(2024, 1, 1), datetime.date(2024, 9, 30))], "lo date, hi date")
    days = calendar_attributes(day_series(bounds, "lo", "hi"))
    customers = spark.createDataFrame([(1, "S", "A"), (2, "S", "B"), (3, None, "C")], "customer_key long, state string, city string")
    fact = fact_rows(spark, [(7, 1, 1, 20240101, 1, 10.0), (7, 2, 1, 20240102, 1, 5.0), (8, 3, 2, 20240901, 2, 30.0)])
    months = {r["month"]: (r["total_orders"], float(r["total_sales"])) for r in marts.monthly_revenue(fact, days).collect()}
    assert months == {1: (1, 15.0), 9: (1, 30.0)}
    states = {r["state"]: (r["total_orders"], r["total_customers"]) for r in marts.revenue_by_state(fact, customers).collect()}
    assert states == {"S": (1, 2), None: (1, 1)}
    cities = {r["city"]: r["total_orders"] for r in marts.city_performance(fact, customers).collect()}
    assert cities == {"A": 1, "B": 1, "C": 1}
    quarters = [(r["quarter"], float(r["total_sales"]), r["qoq_growth"]) for r in
                marts.quarterly_growth(fact, days).orderBy("quarter").collect()]
    assert quarters == [(1, 15.0, None), (2, 0.0, -1.0), (3, 30.0, None)]
    kpi = marts.kpi_measures(fact).first()
    assert (kpi["total_orders"], kpi["total_customers"], kpi["total_products"]) == (2, 3, 2)


def test_frequent_anomalies_and_repeated_headers_stop_the_build(spark, tmp_root):
    s = derived_staging(spark, SF001)
    half = s.order_items.withColumn("product_id", F.when(F.col("order_id") % 2 == 0, F.lit(999999999).cast("long"))
                                    .otherwise(F.col("product_id")))
    with pytest.raises(checks.GateFailed, match="orphan_product_ids"):
        build(spark, Staging(s.customers, s.products, s.orders, half), f"{tmp_root}/a")
    twice = s.orders.unionByName(s.orders.where("order_id = 1"))
    with pytest.raises(checks.GateFailed, match="duplicate_order_ids"):
        build(spark, Staging(s.customers, s.products, twice, s.order_items), f"{tmp_root}/b")
    assert Store(spark, f"{tmp_root}/a").current() is None


def test_incremental_keys_go_on(spark):
    s = derived_staging(spark, SF001)
    dims = [catalog.QUERIES[d](spark, SF001) for d in ("dim_customer", "dim_product", "dim_date")]
    day = datetime.date(1995, 6, 1)
    first = session.materialize(incremental.load_orders(None, s.orders, s.order_items, *dims, upto=day), "t")
    more = incremental.load_orders(first, s.orders, s.order_items, *dims, after=day)
    n = first.count()
    keys = more.agg(F.min("sales_key").alias("lo"), F.max("sales_key").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    assert (keys["lo"], keys["hi"]) == (n + 1, n + keys["n"])
    assert incremental.watermark(first, dims[2]) <= day < incremental.watermark(more, dims[2])


def test_customer_history(spark):
    schema = "customer_id long, customer_name string, city string, state string, country string, signup_date date"
    row = lambda i, city: (i, f"c{i}", city, "S", "H", datetime.date(2020, 1, 1))
    days = [datetime.date(2024, m, 1) for m in (1, 2, 3)]
    h = None
    for day, rows in zip(days, ([row(1, "a"), row(2, None), row(3, "c"), row(1, "a")], [row(1, "b"), row(2, None)],
                                [row(1, "b"), row(2, "x"), row(3, "c")])):
        h = session.materialize(incremental.customer_history(h, spark.createDataFrame(rows, schema), day), "history")
    got = sorted((r["customer_id"], r["city"], r["start_date"], r["end_date"], r["is_current"]) for r in h.collect())
    start = incremental.BEGINNING
    assert got == [(1, "a", start, days[1], False), (1, "b", days[1], None, True), (2, "Unknown", start, days[2], False),
                   (2, "x", days[2], None, True), (3, "c", start, days[1], False), (3, "c", days[2], None, True)]
