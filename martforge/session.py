"""Session defaults and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library should run with. AQE re-plans joins
# from runtime sizes and splits skewed shuffle partitions; ANSI mode makes
# decimal overflow and division by zero raise instead of returning NULL.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_LOCAL_SCRATCH: dict[str, str] = {}


def get_spark(master: str = "local[8]", app: str = "martforge",
              shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for materialised intermediates.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (or the
    one set with ``setCheckpointDir``), which every executor can reach. Only
    when the session names none and runs in one JVM (master ``local[...]``) is
    a fresh local folder created and registered as the checkpoint dir; on a
    cluster a missing setting raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a SparkContext (e.g. Spark Connect)
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        return configured.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = sc.applicationId
    if app not in _LOCAL_SCRATCH:
        path = tempfile.mkdtemp(prefix="martforge-scratch-")
        sc.setCheckpointDir(path)
        _LOCAL_SCRATCH[app] = sc.getCheckpointDir().rstrip("/")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/martforge/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet under the shared scratch folder and read it back.

    This cuts the lineage (a lost executor re-reads files instead of
    recomputing the upstream joins) and freezes values that depend on the
    physical layout, such as ``monotonically_increasing_id``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
