"""Shuffles whose tasks stay as large as they are, whatever the input's size."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Rows of one task of a sized shuffle: some 100 MB where they are sorted.
ROWS_PER_TASK_CONF = "martforge.shuffle.rowsPerTask"
ROWS_PER_TASK = 1_000_000
_PARTITIONS = "spark.sql.shuffle.partitions"
_COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"


@contextmanager
def sized_shuffles(spark: SparkSession, rows: int) -> Iterator[int]:
    """Actions inside deal shuffles of up to ``rows`` rows out to as many partitions as these rows fill.

    With a fixed number of partitions each task's rows grow with the input, until sorts and hash tables spill. AQE would
    merge partitions by their compressed bytes, which for sorted keys are a twentieth of what they take in memory, so it
    does not where there are more partitions than the session asks for; it still broadcasts and splits skewed ones. The
    session's settings come back afterwards. For actions, or results written inside: a frame that is returned unread is
    planned with the settings that then hold.
    """
    old = {k: spark.conf.get(k) for k in (_PARTITIONS, _COALESCE)}
    n = math.ceil(rows / int(spark.conf.get(ROWS_PER_TASK_CONF, str(ROWS_PER_TASK))))
    if n <= int(old[_PARTITIONS]):
        yield int(old[_PARTITIONS])
        return
    try:
        spark.conf.set(_PARTITIONS, str(n))
        spark.conf.set(_COALESCE, "false")
        yield n
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
