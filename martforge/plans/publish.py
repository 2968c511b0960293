"""Versioned, all-or-nothing publication of the warehouse tables.

Layout under a root folder (any Hadoop file system):

    <root>/v=<run_id>/<table>/          one folder per table of that run
    <root>/_commits/<number>.json       one write-once file per published run, numbered from 1

A run writes its tables into its own version folder and, only after every gate
passed on what was written, adds the next numbered commit file. That file comes
into being at once and never replaces another one (a hard link on local disks,
a rename that refuses an existing name elsewhere), so of two runs that began
from the same commit one is refused: compare-and-set by number, no clocks.
Readers resolve the current version as the highest number, so they see all
tables of one run or none; a failed or refused run leaves the log untouched and
its folder stays for inspection. Old versions are kept; removing them is a
separate decision.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

COMMITS = "_commits"
COMMIT_SCHEMA = "number long, run_id string, fingerprint string, parent long, committed_at timestamp"


class CommitConflict(RuntimeError):
    """Another run was published since this one began."""


def new_run_id() -> str:
    now = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{now}-{uuid.uuid4().hex[:8]}"


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its whole content, or return False where one of that name exists.

    The content is written under a hidden name (which readers skip) and then gets its name in one step that fails if
    it is taken. On HDFS and local disks that step is atomic; an object store must offer a rename or put that refuses
    existing names.
    """
    folder, _, name = path.rpartition("/")
    hidden = f"{folder}/.{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(hadoop)
    if fs.getScheme() == "file":
        local = lambda p: jvm.org.apache.hadoop.fs.Path(p).toUri().getPath()
        os.makedirs(local(folder), exist_ok=True)
        with open(local(hidden), "x", encoding="utf-8") as file:
            file.write(text)
            file.flush()
            os.fsync(file.fileno())
        try:
            os.link(local(hidden), local(path))
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(local(hidden))
    source = jvm.org.apache.hadoop.fs.Path(hidden)
    out = fs.create(source, False)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if not fs.exists(target):
        try:  # refuses an existing name
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), hadoop).rename(
                source, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
            return True
        except Exception as e:
            if "FileAlreadyExistsException" not in str(e):
                raise
    fs.delete(source, False)
    return False


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def version_dir(self, run_id: str) -> str:
        return f"{self.root}/v={run_id}"

    def table_path(self, run_id: str, table: str) -> str:
        return f"{self.version_dir(run_id)}/{table}"

    def commit(self, run_id: str, fingerprint: str = "", parent: int | None = None) -> int:
        """Publish a run as commit ``parent`` + 1 and return that number.

        ``parent`` is the commit that the run began from (``latest()`` at its start); if another run was published
        since, ``CommitConflict`` is raised and nothing changes. Without a parent the run comes after whatever is the
        latest, with retries.
        """
        while True:
            number = (self.latest() if parent is None else parent) + 1
            row = {"number": number, "run_id": run_id, "fingerprint": fingerprint, "parent": number - 1,
                   "committed_at": _dt.datetime.now(_dt.timezone.utc).isoformat()}
            if write_once(self.spark, f"{self.root}/{COMMITS}/{number:020d}.json", json.dumps(row) + "\n"):
                return number
            if parent is not None:
                raise CommitConflict(f"run {run_id} began from commit {parent}, but commit {number} exists")

    def commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.root}/{COMMITS}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def latest(self) -> int:
        """Number of the latest commit, 0 if there is none."""
        log = self.commits()
        return (log.agg(F.max("number")).first()[0] or 0) if log is not None else 0

    def current(self, fingerprint: str | None = None) -> str | None:
        """Run id committed last (optionally only runs built from ``fingerprint``).

        The number of the commit decides, not the name, start or clock of the run.
        """
        log = self.commits()
        if log is None:
            return None
        if fingerprint is not None:
            log = log.where(F.col("fingerprint") == fingerprint)
        return log.agg(F.max(F.struct("number", "run_id")).alias("last")).select("last.run_id").first()[0]

    def read(self, table: str, run_id: str | None = None) -> DataFrame:
        rid = run_id or self.current()
        if rid is None:
            raise FileNotFoundError(f"no committed version under {self.root}")
        return self.spark.read.parquet(self.table_path(rid, table))
