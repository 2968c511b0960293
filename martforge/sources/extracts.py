"""Raw CSV extracts: presence, non-empty, header contract, typed by-name read, CSV sink.

An extract is either a single file ``<name>.csv`` or a folder ``<name>.csv/`` of
part files (what ``write_extract`` produces), each with a header line.
"""

from __future__ import annotations

import csv
import re
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from martforge.plans.staging import Staging
from martforge.schemas import RAW_FILES, STAGING


#: Different headers that the part files of one extract may have.
MOST_HEADERS = 20


class SourceError(ValueError):
    """The source folder does not meet the extract contract."""


@dataclass(frozen=True)
class ExtractStatus:
    name: str
    exists: bool
    bytes: int
    missing_columns: tuple[str, ...]
    extra_columns: tuple[str, ...]

    @property
    def ok(self) -> bool:
        return self.exists and self.bytes > 0 and not self.missing_columns


def list_extracts(spark: SparkSession, source_dir: str) -> dict[str, int]:
    """Extract name -> total bytes of the contract's extracts that are there (contents and file names are not read).

    Whether an extract is there is asked by its path; sizes are summed in Spark from the binary-file listing of all of
    them, one row per extract. That listing leaves zero-length files out: an extract of such files alone has 0 bytes.
    """
    root = source_dir.rstrip("/")
    found = []
    for name in RAW_FILES:
        try:
            spark.read.schema("value string").text(f"{root}/{name}")
            found.append(name)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    sizes = dict.fromkeys(found, 0)
    if not found:
        return sizes
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load([f"{root}/{name}" for name in found]).select("path", "length"))
    name = F.regexp_extract("path", f".*/({'|'.join(re.escape(n) for n in found)})(/|$)", 1)
    for r in files.groupBy(name.alias("name")).agg(F.sum("length").alias("bytes")).collect():  # a row per extract
        sizes[r["name"]] = int(r["bytes"])
    return sizes


def _files_by_header(spark: SparkSession, path: str) -> DataFrame:
    """``header, file`` of every part file of an extract (files without a line have none).

    The first line of a file is the one read first in its first block.
    """
    lines = (spark.read.option("recursiveFileLookup", "true").text(path)
             .select("value", F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block")).where("block = 0"))
    return (lines.withColumn("at", F.monotonically_increasing_id()).groupBy("file")
            .agg(F.min_by("value", "at").alias("header")))


def header_lines(spark: SparkSession, path: str) -> list[str]:
    """The distinct header lines of an extract's part files: one, unless their writers differ."""
    rows = _files_by_header(spark, path).select("header").distinct().limit(MOST_HEADERS + 1).collect()
    if len(rows) > MOST_HEADERS:
        raise SourceError(f"{path}: more than {MOST_HEADERS} different headers; are the header lines missing?")
    return sorted(r["header"] for r in rows)


def columns_of(header: str) -> list[str]:
    """Column names of a header line as written."""
    return next(csv.reader([header]), [])


def check_extract(spark: SparkSession, source_dir: str, name: str, sizes: dict[str, int]) -> ExtractStatus:
    table = RAW_FILES[name]
    expected = [f.name for f in STAGING[table].fields]
    if name not in sizes:
        return ExtractStatus(name, False, 0, tuple(expected), ())
    if sizes[name] == 0:
        return ExtractStatus(name, True, 0, tuple(expected), ())
    headers = [[c.strip() for c in columns_of(h)] for h in header_lines(spark, f"{source_dir.rstrip('/')}/{name}")]
    missing = tuple(c for c in expected if any(c not in h for h in headers) or not headers)
    extra = tuple(dict.fromkeys(c for h in headers for c in h if c not in expected))
    return ExtractStatus(name, True, sizes[name], missing, extra)


def validate_source(spark: SparkSession, source_dir: str) -> list[ExtractStatus]:
    """Every extract present, non-empty, with all contract columns (any order, extras allowed).

    Checks all extracts, then raises once listing every problem.
    """
    sizes = list_extracts(spark, source_dir)
    statuses = [check_extract(spark, source_dir, n, sizes) for n in RAW_FILES]
    problems = []
    for s in statuses:
        if not s.exists:
            problems.append(f"{s.name}: missing")
        elif s.bytes == 0:
            problems.append(f"{s.name}: empty")
        elif s.missing_columns:
            problems.append(f"{s.name}: missing columns {list(s.missing_columns)}")
    if problems:
        raise SourceError("; ".join(problems))
    return statuses


def _parsed(spark: SparkSession, path: str, schema: T.StructType, mode: str) -> DataFrame:
    """The contract columns by the header name of each part file; PERMISSIVE adds ``_corrupt`` (the raw line of a row
    that does not parse), ``_file`` and ``_texts`` (its fields as written)."""
    headers = header_lines(spark, path)
    wanted = {f.name: f.dataType for f in schema.fields}
    parts = []
    for header in headers:
        raw = columns_of(header)
        by_name = {h.strip(): h for h in raw}
        missing = [c for c in wanted if c not in by_name]
        if missing:
            raise SourceError(f"{path}: missing columns {missing}")
        fields = [T.StructField(h, wanted.get(h.strip(), T.StringType()), True) for h in raw]
        files = [path] if len(headers) == 1 else [
            r["file"] for r in _files_by_header(spark, path).where(F.col("header") == header).collect()]
        reader = spark.read.option("header", True).option("mode", mode).option("enforceSchema", True)
        columns = [F.col(f"`{by_name[c]}`").alias(c) for c in wanted]
        if mode == "PERMISSIVE":
            # all columns are parsed, so that rows with too few or too many fields are found too
            reader = reader.option("columnNameOfCorruptRecord", "_corrupt").option("columnPruning", False)
            fields.append(T.StructField("_corrupt", T.StringType(), True))
            texts = ", ".join(f"c{i} string" for i in range(len(raw)))
            places = [next(i for i, h in enumerate(raw) if h.strip() == c) for c in wanted]
            text = F.from_csv("_corrupt", texts)
            columns += ["_corrupt", F.col("_metadata.file_path").alias("_file"),
                        F.array(*[text[f"c{i}"] for i in places]).alias("_texts")]
        parts.append(reader.schema(T.StructType(fields)).csv(files).select(*columns))
    if not parts:
        raise SourceError(f"{path}: empty")
    return reduce(DataFrame.unionByName, parts)


def read_extract(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed read that maps columns by the header name of each part file, not by position.

    Files of one header are read together: the file schema is built in header
    order (contract types for contract columns, string for extras), so the
    positional CSV reader lines up; then the contract columns are selected in
    contract order. FAILFAST makes a malformed value raise once the column is
    parsed (the ingest writes every column, so every value is parsed). Only
    where part files differ in their headers are files listed by name.
    """
    return _parsed(spark, path, schema, "FAILFAST")


@dataclass(frozen=True)
class Intake:
    """One extract, read so that rows which do not parse are set apart.

    ``rows`` are the rows that parse, ``rejects`` the others (extract, file, reasons, line). ``seen`` counts both while
    ``rows`` is written, without a pass of its own; it has no result before.
    """
    name: str
    rows: DataFrame
    rejects: DataFrame
    seen: Observation

    def counts(self) -> tuple[int, int]:
        """Rows read and rows rejected."""
        found = self.seen.get
        return found["read"], found["rejected"]


def take_in(spark: SparkSession, path: str, name: str, schema: T.StructType) -> Intake:
    """Read one extract by header name and set apart what does not parse: a bad value loads the rest.

    The reasons of a reject name the columns whose text has no value of the contract's type (``bad_<column>``);
    a line with too few or too many fields has ``field_count``.
    """
    parsed = _parsed(spark, path, schema, "PERMISSIVE")
    columns = [f.name for f in schema.fields]
    bad = F.col("_corrupt").isNotNull()
    seen = Observation(f"intake {name} {uuid.uuid4().hex[:8]}")
    rows = parsed.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(bad).alias("rejected")).where(~bad)
    reasons = F.array_compact(F.array(*[
        F.when(F.col(c).isNull() & F.col("_texts")[i].isNotNull(), F.lit(f"bad_{c}")) for i, c in enumerate(columns)]))
    reasons = F.when(F.size(reasons) > 0, reasons).otherwise(F.array(F.lit("field_count")))
    rejects = parsed.where(bad).select(F.lit(name).alias("extract"), F.col("_file").alias("file"),
                                       reasons.alias("reasons"), F.col("_corrupt").alias("line"))
    return Intake(name, rows.select(*columns), rejects, seen)


def ingest_with_rejects(spark: SparkSession, source_dir: str) -> tuple[Staging, dict[str, Intake]]:
    """Like ``ingest``, but rows that do not parse are set apart per staging table instead of ending the load."""
    validate_source(spark, source_dir)
    root = source_dir.rstrip("/")
    taken = {table: take_in(spark, f"{root}/{name}", name, STAGING[table]) for name, table in RAW_FILES.items()}
    return Staging(*[taken[t].rows for t in ("stg_customers", "stg_products", "stg_orders", "stg_order_items")]), taken


def ingest(spark: SparkSession, source_dir: str) -> Staging:
    """Validate the source folder and read the four extracts as typed staging frames."""
    validate_source(spark, source_dir)
    root = source_dir.rstrip("/")
    t = {table: read_extract(spark, f"{root}/{name}", STAGING[table]) for name, table in RAW_FILES.items()}
    return Staging(t["stg_customers"], t["stg_products"], t["stg_orders"], t["stg_order_items"])


def write_extract(df: DataFrame, path: str) -> None:
    """CSV sink: header line, no index column; bare empty field = NULL."""
    df.write.option("header", True).mode("errorifexists").csv(path)


def write_extracts(staging: Staging, source_dir: str) -> None:
    tables = staging.tables()
    for name, table in RAW_FILES.items():
        write_extract(tables[table], f"{source_dir.rstrip('/')}/{name}")
