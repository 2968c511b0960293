"""Shuffles follow the rows: tasks stay as large as they are when the input grows."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from martforge import catalog
from martforge.operators import sizing
from martforge.operators.joins import duplicate_keys
from martforge.operators.sizing import sized_shuffles

PARTITIONS = "spark.sql.shuffle.partitions"


@pytest.fixture()
def small_tasks(spark):
    spark.conf.set(sizing.ROWS_PER_TASK_CONF, "100")
    yield
    spark.conf.unset(sizing.ROWS_PER_TASK_CONF)


def test_partitions_follow_rows_and_come_back(spark, small_tasks):
    old = spark.conf.get(PARTITIONS)
    counted = lambda: spark.range(5000).groupBy((F.col("id") % 2000).alias("k")).count().rdd.getNumPartitions()
    with sized_shuffles(spark, 5000) as n:
        assert n == 50 and counted() == 50
        with sized_shuffles(spark, 300):
            assert spark.conf.get(PARTITIONS) == "50"
    with pytest.raises(ValueError), sized_shuffles(spark, 5000):
        raise ValueError
    assert spark.conf.get(PARTITIONS) == old and counted() <= int(old)


@pytest.mark.parametrize("name", ["exclusion_audit", "dq_missing_city", "validation_report_mutated", "fact_sales_refreshed"])
def test_queries_size_their_shuffles(spark, small_tasks, monkeypatch, name):
    most = []
    inside = sizing.sized_shuffles

    def seen(session, rows):
        most.append(rows)
        return inside(session, rows)

    from martforge.plans import maintain, warehouse
    for module in (catalog, maintain, warehouse):
        monkeypatch.setattr(module, "sized_shuffles", seen)
    assert catalog.QUERIES[name](spark, SF001).count() > 0
    assert max(most) > 4000  # the staged lines


def test_duplicate_keys_dealt_out_first(spark):
    rows = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,), (3,), (3,), (3,)], "k long")
    for unlike in (False, True):
        assert duplicate_keys(rows, ["k"], unlike=unlike).first()["actual"] == 3
    plan = duplicate_keys(rows, ["k"], unlike=True)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan and plan.count("Exchange hashpartitioning") == 1
