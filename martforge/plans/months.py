"""The fact by month: one folder per order month, replaced one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.schemas import FACT_SALES, columns

FACT_PARTITION = "year_month"


def _clustered(fact: DataFrame) -> DataFrame:
    """Rows of a month side by side, as many partitions per month as its size asks for.

    REBALANCE shuffles by month, splits months over ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` (so a month
    that holds a third of all lines is no single task) and joins small ones: files are bounded by months and size, not
    by tasks times months. Inside a file rows follow the key, so its statistics prune order lookups.
    """
    month = fact.withColumn(FACT_PARTITION, F.expr("date_key DIV 100").cast("int"))
    return month.hint("rebalance", F.col(FACT_PARTITION)).sortWithinPartitions(FACT_PARTITION, "sales_key")


def write_months(fact: DataFrame, path: str) -> None:
    """A new fact table with a ``year_month=`` folder for each month."""
    _clustered(fact).write.mode("errorifexists").partitionBy(FACT_PARTITION).parquet(path)


def replace_months(rows: DataFrame, path: str) -> None:
    """Replace the months that ``rows`` have by them; folders of other months are not touched.

    ``rows`` must not be read from the months that they replace (materialise them before). A month without rows stays.
    """
    (_clustered(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(FACT_PARTITION).parquet(path))


def read_months(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The fact of months ``first`` to ``last`` (as yyyymm, both included); only their folders are read."""
    fact = spark.read.parquet(path)
    if first is not None:
        fact = fact.where(F.col(FACT_PARTITION) >= first)
    if last is not None:
        fact = fact.where(F.col(FACT_PARTITION) <= last)
    return fact.select(*columns(FACT_SALES))
