"""Operators of a training-data pipeline: sharding, deduplication, tokenising, decontamination, quality, chat."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from martforge import session

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Rows that Spark hands to a Python task at once: whole texts, so far fewer than Spark's default of 10,000.
BATCH_ROWS = "1000"
#: Removes the shuffle files of an execution when it ends; else they stay until the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: What tasks leave in their Python worker for later ones of the same operator.
KEPT: list[dict] = []


def forget() -> None:
    """Drops what other operators' tasks left in this Python worker: Spark hands workers on from job to job."""
    for kept in KEPT:
        kept.clear()


def python_tasks(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it, and keeps their batches small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), _ROOT])
    return spark


def materialize(df: DataFrame, label: str) -> DataFrame:
    """``session.materialize``; the files that this write shuffled serve nothing else and go as soon as it has ended."""
    spark = df.sparkSession
    old = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return session.materialize(df, label)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, old)
