"""Small operators: match flags, side-by-side fold, unpivot, copies."""

from pyspark.sql import functions as F

from martforge.operators.combine import side_by_side
from martforge.operators.inject import COPY_NO, append_copies
from martforge.operators.joins import duplicate_keys, orphans, with_match
from martforge.operators.unpivot import unpivot_rows


def test_with_match_no_fanout_and_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (2,)], "k int")
    parent = spark.createDataFrame([(2,), (2,), (3,), (None,)], "k int")
    out = sorted((r["k"] is None, r["k"], r["ok"]) for r in with_match(child, parent, "k", "ok").collect())
    assert out == [(False, 1, False), (False, 2, True), (False, 2, True), (True, None, False)]
    assert orphans(child, parent, "k").count() == 2          # 1 and NULL


def test_duplicate_keys_counts_keys_not_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k int")
    assert duplicate_keys(df, ["k"]).first()["actual"] == 2  # key 1 and the NULL key


def test_side_by_side_and_unpivot(spark):
    a = spark.createDataFrame([(3, "x")], "n bigint, s string")
    b = spark.range(5).agg(F.sum("id").alias("total"))
    row = side_by_side([a, b]).first()
    assert (row["n"], row["s"], row["total"]) == (3, "x", 10)
    long = unpivot_rows(side_by_side([a, b]), [(1, "n", "@n"), (2, "total", "@total")], ["o", "name", "v"])
    assert sorted(tuple(r) for r in long.collect()) == [(1, "n", 3), (2, "total", 10)]


def test_append_copies(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    out = sorted((r["k"], r[COPY_NO]) for r in append_copies(df, F.col("k") >= 2).collect())
    assert out == [(1, 0), (2, 0), (2, 1), (3, 0), (3, 1)]
