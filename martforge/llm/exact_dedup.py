"""Exact deduplication by skew-safe combining (native DataFrame operations only).

The rows of equal content meet in three steps, each of which compares the whole content beside its digest:

1. each map task merges its own equal rows (the partial aggregate of step 2 runs before the shuffle);
2. what is left is merged within ``(digest, salt, content)``, so a content that fills a third of the table is
   spread over ``salts`` reducers;
3. the salt winners are merged within ``(digest, content)`` - at most ``salts`` rows for each content.

Texts never travel back to the rows: these find their winner by digest. Only if a digest turns out to stand for
several contents do the rows of that digest look it up by ``(digest, content)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.session import materialize

def normalised(text: Column) -> Column:
    """Runs of ASCII white space become one space; null becomes the empty string.

    Byte searches do most of it; the pattern runs only on texts that still have two spaces in a row.
    """
    spaced = F.coalesce(text, F.lit(""))
    for white in "\t\n\x0b\x0c\r":
        spaced = F.replace(spaced, F.lit(white), F.lit(" "))
    return F.when(spaced.contains("  "), F.regexp_replace(spaced, " +", " ")).otherwise(spaced)


def sha256(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 32,
                digest=sha256) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Equal are texts whose normalised forms are identical; of equal texts the row with the smallest id stays.

    Nulls: a null text counts as empty; null ids come after all others (``keep_id`` is null only if every id of the
    group is). Ties: of rows that repeat both id and text, exactly one is ``kept``. An empty table gives no rows.
    Other columns of ``docs``, whatever their names, are not read. ``digest`` maps the content column to the
    grouping digest; any function is right, as contents are compared as well (tests pass a colliding one).
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("content"))
    rows = rows.withColumn("digest", digest(F.col("content")))

    salted = (rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
              .groupBy("digest", "salt", "content")
              .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")))
    merged = (salted.groupBy("digest", "content")
              .agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size")))
    winners = materialize(merged.select("digest", "keep_id", "group_size",
                                        sha256(F.col("content")).alias("text_sha256")), "exact-winners")

    row = F.monotonically_increasing_id().alias("row")
    if winners.groupBy("digest").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").isEmpty():
        keys, of_content = materialize(rows.select("doc_id", "digest", row), "exact-keys"), "digest"
        found = keys.join(winners, "digest")
    else:
        found = materialize(rows.select("*", row).join(merged, ["digest", "content"])
                            .withColumn("text_sha256", sha256(F.col("content"))).drop("content"), "exact-keys")
        keys, of_content = found, "text_sha256"

    # Rows that repeat id and content: the first of them stands for all.
    first = (keys.groupBy(F.col(of_content).alias("content_key"), F.col("doc_id").alias("id"))
             .agg(F.min("row").alias("first_row"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c"))
    same = (F.col(of_content) == F.col("content_key")) & F.col("doc_id").eqNullSafe(F.col("id"))
    return found.join(first, same, "left").select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id"))
         & (F.col("first_row").isNull() | (F.col("first_row") == F.col("row")))).alias("kept"),
        "text_sha256")
