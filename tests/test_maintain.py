"""Change capture, streaming loads, months, numbered commits and as-of joins."""

import datetime
import glob
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from martforge.operators.asof import last_before
from martforge.plans import incremental
from martforge.plans.dims import build_dim_customer, build_dim_date, build_dim_product
from martforge.plans.facts import build_fact_sales
from martforge.plans.maintain import MaintainedFact
from martforge.plans.months import read_months, replace_months, write_months
from martforge.plans.publish import CommitConflict, Store
from martforge.plans.staging import derived_staging
from martforge.session import materialize


@pytest.fixture(scope="module")
def star(spark):
    s = derived_staging(spark, SF001)
    orders, lines = materialize(s.orders, "t-orders"), materialize(s.order_items, "t-lines")
    dims = [materialize(d, "t-dims") for d in (build_dim_customer(s.customers), build_dim_product(s.products),
                                               build_dim_date(s.orders))]
    return orders, lines, dims


def rows(df):
    return sorted(map(tuple, df.collect()))


def full(orders, lines, dims):
    return rows(build_fact_sales(lines, orders, *dims))


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_late_order_and_extra_line(spark, star, tmp_root):
    orders, lines, dims = star
    fact = MaintainedFact(spark, tmp_root, width=300)
    ids = sorted(r[0] for r in build_fact_sales(lines, orders, *dims).select("order_id").distinct().collect())
    late, grown = ids[len(ids) // 3], ids[-1]  # dated long before the last order that is loaded
    extra = lines.where(F.col("order_id") == grown).limit(1).withColumn("quantity", F.lit(77))
    more = materialize(lines.unionByName(extra), "t-more")
    fact.refresh(lines, orders.where(F.col("order_id") != late), dims)
    assert rows(fact.read()) == full(orders.where(F.col("order_id") != late), lines, dims)
    before = files(f"{tmp_root}/fact")
    ranges = {r[0] for r in fact.refresh(more, orders, dims).collect()}
    assert ranges == {late // 300, grown // 300}
    assert rows(fact.read()) == full(orders, more, dims)
    after = files(f"{tmp_root}/fact")
    touched = {f.split("order_range=")[1].split("/")[0] for f, _ in set(before.items()) ^ set(after.items())}
    assert touched == {str(r) for r in ranges} and len(before) == 5
    assert fact.refresh(more, orders, dims).isEmpty() and files(f"{tmp_root}/fact") == after


def test_removed_orders_and_moved_keys(spark, star, tmp_root):
    orders, lines, dims = star
    fact = MaintainedFact(spark, tmp_root, width=500)
    fact.refresh(lines, orders, dims)
    fewer = orders.where("order_id >= 1000")  # leaves whole ranges without rows
    fact.refresh(lines, fewer, dims)
    assert rows(fact.read()) == full(fewer, lines, dims)
    moved = [dims[0].where("customer_id % 9 <> 4").withColumn("customer_key", F.col("customer_key") + 1000), *dims[1:]]
    fact.refresh(lines, fewer, moved)
    assert rows(fact.read()) == full(fewer, lines, moved)
    fact.refresh(lines.limit(0), fewer, moved)
    assert rows(fact.read()) == []
    fact.refresh(lines, orders, dims)
    assert rows(fact.read()) == full(orders, lines, dims)


def test_empty_table_and_layout(spark, star, tmp_root):
    _, _, dims = star
    fact = MaintainedFact(spark, tmp_root, width=50)
    assert rows(fact.read()) == [] and rows(fact.manifest()) == []
    assert MaintainedFact(spark, tmp_root, width=999).width == 50  # the table's own
    with pytest.raises(ValueError):
        MaintainedFact(spark, tmp_root, width=0)


def test_interrupted_refresh_is_repeated(spark, star, tmp_root, monkeypatch):
    orders, lines, dims = star
    fact = MaintainedFact(spark, tmp_root, width=400)
    fact.refresh(lines, orders.where("order_id % 5 <> 2"), dims)
    whole = fact._overwrite

    def lost(df, part):
        whole(df, part)
        if part == "fact":
            raise RuntimeError("driver lost")

    monkeypatch.setattr(fact, "_overwrite", lost)
    with pytest.raises(RuntimeError):
        fact.refresh(lines, orders, dims)
    again = MaintainedFact(spark, tmp_root)
    again.refresh(lines, orders, dims)
    assert rows(again.read()) == full(orders, lines, dims)


def test_stream_killed_and_restarted(spark, star, tmp_root, monkeypatch):
    orders, lines, dims = star
    land = lambda i: (F.col("order_id") % 4 == i)
    for i in range(4):  # lines of an order land one file later than their header, those of the last one before
        orders.where(land(i)).coalesce(1).write.mode("append").parquet(f"{tmp_root}/in/orders")
        lines.where(land((i + 1) % 4) | (F.col("order_id").isNull() & F.lit(i == 0))).coalesce(1).write.mode(
            "append").parquet(f"{tmp_root}/in/order_items")
    fact = MaintainedFact(spark, f"{tmp_root}/t", width=300)
    whole, seen = fact.load_batch, []

    def lost(o, i, batch, d):
        seen.append(batch)
        whole(o, i, batch, d)
        if batch == 1:
            raise RuntimeError("driver lost")  # after the work, before the checkpoint knows

    monkeypatch.setattr(fact, "load_batch", lost)
    with pytest.raises(Exception, match="driver lost"):
        fact.follow(f"{tmp_root}/in", lambda: dims, f"{tmp_root}/check", files_per_batch=1)
    assert seen == [0, 1]
    again = MaintainedFact(spark, f"{tmp_root}/t")
    batches, other = [], again.load_batch
    monkeypatch.setattr(again, "load_batch", lambda o, i, b, d: (batches.append(b), other(o, i, b, d)))
    again.follow(f"{tmp_root}/in", lambda: dims, f"{tmp_root}/check", files_per_batch=1)
    assert batches[0] == 1 and len(batches) >= 3  # the unfinished batch first, under its number
    assert rows(again.read()) == full(orders, lines, dims)
    again.follow(f"{tmp_root}/in", lambda: dims, f"{tmp_root}/check")
    assert rows(again.read()) == full(orders, lines, dims)


def test_header_that_comes_again_replaces(spark, star, tmp_root):
    orders, lines, dims = star
    fact = MaintainedFact(spark, tmp_root, width=300)
    one = orders.where("order_id % 6 = 1")
    wrong = one.withColumn("order_date", F.date_add("order_date", 1))
    fact.load_batch(wrong, lines, 0, dims)
    fact.load_batch(orders, lines.limit(0), 1, dims)
    assert rows(fact.read()) == full(orders, lines, dims)
    fact.load_batch(orders.limit(0), lines.limit(0), 2, dims)
    assert rows(fact.read()) == full(orders, lines, dims)


def test_months_are_replaced_one_by_one(spark, star, tmp_root):
    orders, lines, dims = star
    fact = materialize(build_fact_sales(lines, orders, *dims), "t-fact")
    path = f"{tmp_root}/months"
    write_months(fact, path)
    before = files(path)
    months = {r[0] for r in fact.select(F.expr("date_key DIV 100")).distinct().collect()}
    assert len(before) == len(months)  # not tasks times months
    month = sorted(months)[len(months) // 2]
    new = fact.where(F.expr("date_key DIV 100") == month).withColumn("quantity", F.col("quantity") + 1)
    replace_months(new, path)
    after = files(path)
    gone, come = set(before) - set(after), set(after) - set(before)
    assert all(f"year_month={month}/" in f for f in gone | come) and gone and come
    assert all(before[f] == after[f] for f in set(before) & set(after))
    assert rows(read_months(spark, path, month, month)) == rows(new.select(*fact.columns))
    others = fact.where(F.expr("date_key DIV 100") != month)
    assert rows(read_months(spark, path)) == sorted(rows(others) + rows(new))
    plan = read_months(spark, path, month, month)._jdf.queryExecution().executedPlan().toString()
    assert f"(year_month#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_of_two_runs_from_one_commit_one_is_refused(spark, tmp_root):
    store = Store(spark, tmp_root)
    assert store.latest() == 0 and store.commit("first", parent=0) == 1
    done, start = [], threading.Barrier(6)

    def race(name):
        start.wait()
        try:
            done.append(store.commit(name, parent=1))
        except CommitConflict:
            done.append(None)

    threads = [threading.Thread(target=race, args=(f"run{i}",)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(done, key=str) == [2] + [None] * 5
    log = store.commits().collect()
    assert sorted(r.number for r in log) == [1, 2] and store.current() == max(log, key=lambda r: r.number).run_id
    assert store.commit("late") == 3 and store.current() == "late"
    assert not glob.glob(f"{tmp_root}/_commits/.0*.json-*")


def test_clock_does_not_order_commits(spark, tmp_root, monkeypatch):
    store = Store(spark, tmp_root)
    store.commit("now")

    class Early(datetime.datetime):
        @classmethod
        def now(cls, tz=None):
            return cls(2001, 1, 1, tzinfo=tz)

    monkeypatch.setattr("martforge.plans.publish._dt.datetime", Early)
    store.commit("by a host with a slow clock")
    assert store.current() == "by a host with a slow clock"


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_as_of_equals_plain(spark, parts):
    rng = random.Random(4)
    day = lambda n: datetime.date(2020, 1, 1) + datetime.timedelta(days=n)
    versions = [(k, day(rng.randint(0, 60)), i) for i, k in enumerate(rng.choices([1, 2, 3, None], [8, 1, 1, 1], k=40))]
    versions.append((2, None, 99))
    events = [(rng.choices([1, 2, 3, 4, None], [30, 1, 1, 1, 1])[0], rng.choice([None, *map(day, range(70))]), i, "x")
              for i in range(400)]
    got = last_before(spark.createDataFrame(events, "k int, t date, id int, v string"),
                      spark.createDataFrame(versions, "k int, since date, version int"), "k", "t", "since", ["version"], parts)
    want = []
    for k, t, i, x in events:
        of = [(s, v) for c, s, v in versions if c == k and s is not None and t is not None and k is not None and s <= t]
        want.append((i, k, t, x, max(of)[1] if of else None))
    assert sorted((r.id, r.k, r.t, r.v, r.version) for r in got.collect()) == sorted(want)


def test_snapshot_of_the_same_day_again(spark):
    schema = "customer_id long, customer_name string, city string, state string, country string, signup_date date"
    born, day = datetime.date(2019, 5, 1), datetime.date(2020, 3, 1)
    snap = lambda *c: spark.createDataFrame([(i, f"n{i}", city, "s", "c", born) for i, city in c], schema)
    history = incremental.customer_history(None, snap((1, "A"), (2, "A")), day)
    first = materialize(incremental.customer_history(history, snap((1, "B"), (2, "A"), (3, "A")), day), "h")
    same = incremental.customer_history(first, snap((1, "B"), (2, "A"), (3, "A")), day)
    assert sorted(map(str, same.collect())) == sorted(map(str, first.collect()))
    second = incremental.customer_history(first, snap((1, "C"), (2, "A")), day)
    got = {(r.customer_id, r.city, r.start_date, r.end_date) for r in second.collect()}
    begin = incremental.BEGINNING
    assert got == {(1, "A", begin, day), (1, "C", day, None), (2, "A", begin, None)}
    assert all(r.end_date is None or r.start_date < r.end_date for r in second.collect())
