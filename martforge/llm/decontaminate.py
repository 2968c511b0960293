"""Benchmark decontamination: scan token windows of the corpus against the n-grams of a benchmark (native only).

The benchmark's windows (``n`` consecutive item words; a shorter item is one window) are the small side. The corpus
is scanned once, in blocks of ``m`` words at every ``m``-th word: whatever its place, a window of at least ``2m - 1``
words covers one whole block whose offset in it is below ``m``. So the set that is broadcast holds the hashes of each
window's first ``m`` m-grams, the scan hashes one block in ``m`` words, and each block found proposes one start of
one window, whose words are then compared one by one with the text's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What is no word character once A-Z are lower case: ASCII but for digits and a-z.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Most m-grams that are broadcast (about 50 bytes each); a larger benchmark is joined by shuffle.
BROADCAST_GRAMS = 4_000_000


def words_of(text: Column) -> Column:
    """Words of a text as an array, A-Z in lower case; null and texts without words give an empty one."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NO_WORD), "")


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = 10) -> DataFrame:
    """Windows of the benchmark: ``item_id, window, length`` (``n`` words, or all words of a shorter item)."""
    words = items.select(F.col(id_col).cast("string").alias("item_id"), words_of(F.col(text_col)).alias("w"))
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - n, F.lit(0))))
    return (words.filter(F.size("w") > 0).select("item_id", "w", starts.alias("s"))
            .select("item_id", F.slice("w", F.col("s") + 1, n).alias("w"))
            .select("item_id", F.concat_ws(" ", "w").alias("window"), F.size("w").alias("length")).distinct())


def _gram(words: Column, start: Column, m: Column | None, sizes: list[int]) -> Column:
    """Hash of the ``m`` words from ``start``; ``sizes`` lists what ``m`` can be."""
    of = lambda k: F.xxhash64(F.lit(k), *[F.get(words, start + i) for i in range(k)])
    out = F.when(m == sizes[0], of(sizes[0]))
    for k in sizes[1:]:
        out = out.when(m == k, of(k))
    return out


def _codes(n_words: Column, sizes: list[int]) -> list[Column]:
    """Block starts, as start * 256 + m, for each m; as longs, since a text may have more than 2^31 / 256 words."""
    long = lambda x: F.lit(x).cast("long")
    return [F.when(n_words >= m, F.sequence(long(m), (n_words.cast("long") - m) * 256 + m, long(256 * m)))
            .otherwise(F.array().cast("array<long>")) for m in sizes]


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", n: int = 10,
         broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_key, n_words, hit, items``.

    ``hit`` lists the positions (from 0, ascending) of the words inside any occurrence of a benchmark window,
    ``items`` the ids of the items with such windows, as strings in ascending order, ``text_key`` is a hash of the
    text that tells apart rows of the same id.

    Nulls: a null text has no words; null ids are kept as they are. Items without words have no window. Repeated rows
    give repeated results; an empty table gives no rows, an empty benchmark empty hits. Other columns are not read.
    """
    if not 1 <= n <= 500:
        raise ValueError("n must be 1 to 500")
    windows = materialize(benchmark_windows(benchmark, item_col, item_text_col, n), "benchmark-windows")
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())  # at most n values
    sizes = sorted({(x + 1) // 2 for x in lengths}) or [1]
    small = windows.count() * sizes[-1] <= broadcast_grams
    near = F.broadcast if small else (lambda x: x)
    grams = (windows.select("window", "length").distinct()
             .select("*", F.split("window", " ").alias("w"), F.shiftright(F.col("length") + 1, 1).alias("m"))
             .select("*", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("offset"))
             .select("window", "length", "offset", _gram(F.col("w"), F.col("offset"), F.col("m"), sizes).alias("gram")))

    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                       words_of(F.col(text_col)).alias("words")).withColumn("n_words", F.size("words"))
    # Block starts, as start * 256 + m, for each m; -1 stands for the row itself, with or without blocks.
    at = F.explode(F.concat(F.array(F.lit(-1).cast("long")), *_codes(F.col("n_words"), sizes))).alias("code")
    blocks = (base.select("*", at)
              .withColumn("at", F.shiftright("code", 8).cast("int"))
              .withColumn("gram", F.when(F.col("code") >= 0, _gram(F.col("words"), F.col("at"),
                                                                  F.col("code").bitwiseAND(255), sizes))))
    start = F.col("at") - F.col("offset")
    is_window = F.concat_ws(" ", F.slice("words", start + 1, F.col("length"))) == F.col("window")
    key = ["doc_id", "text_key", "n_words"]
    if small:
        found = (blocks.join(near(grams), "gram", "left")
                 .filter((F.col("code") < 0) | (F.when(start >= 0, is_window).otherwise(False)))
                 .select(*key, "code", start.alias("start"), "length", "window"))
    else:  # the words stay behind; only (key, start) travel, and each text is met again by its key
        starts_at = (blocks.drop("words").join(grams, "gram").filter(start >= 0)
                     .select(*key, start.alias("start"), "length", "window").distinct())
        met = starts_at.alias("s").join(base.distinct().alias("b"), (F.col("s.text_key") == F.col("b.text_key"))
                                        & F.col("s.doc_id").eqNullSafe(F.col("b.doc_id")))
        found = (met.filter(F.concat_ws(" ", F.slice("b.words", F.col("start") + 1, F.col("length"))) == F.col("window"))
                 .select(*[F.col(f"s.{c}").alias(c) for c in key], F.lit(0).alias("code"), "start", "length", "window")
                 .unionByName(base.select(*key, F.lit(-1).alias("code"), F.lit(None).cast("int").alias("start"),
                                          F.lit(None).cast("int").alias("length"),
                                          F.lit(None).cast("string").alias("window"))))

    place = F.when(F.col("code") >= 0, F.struct("start", "length"))
    per_row = (found.join(near(windows.select("window", "item_id")), "window", "left")
               .groupBy(*key)
               .agg(F.count_if(F.col("code") < 0).alias("copies"), F.collect_set(place).alias("places"),
                    F.sort_array(F.collect_set("item_id")).alias("items")))
    inside = F.transform("places", lambda p: F.sequence(p["start"], p["start"] + p["length"] - 1))
    return per_row.select(
        "doc_id", "text_key", F.col("n_words").cast("long").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(inside))).alias("hit"), "items",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", id_col: str = "doc_id",
                  text_col: str = "text", n: int = 10, **more) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) without the words that were hit.

    Removing spans cuts each hit word together with what separates it from the next word; the rest of the text stays
    as it is. All columns and all other rows stay, nulls as in ``scan``.
    """
    hits = (scan(docs, benchmark, id_col, text_col, n=n, **more).filter(F.size("hit") > 0)
            .select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), "hit")
            .dropDuplicates(["hit_id", "hit_key"]))
    # the table's own columns inside one struct: no name can clash
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"),
                       F.xxhash64(F.col(text_col)).alias("text_key"))
    same = F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key"))
    if remove == "documents":
        return rows.join(hits, same, "left_anti").select("row.*")
    if remove != "spans":
        raise ValueError(f"remove is 'documents' or 'spans', not {remove!r}")
    # the text before the first word, then each word with what follows it
    apart = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    word = rf"[^{apart[1:-1]}]+{apart}*"
    text = F.col("row")[text_col]
    pieces = F.regexp_extract_all(text, F.lit(word), F.lit(0))
    left = F.filter(pieces, lambda p, i: ~F.array_contains(F.col("hit"), i))
    cut = F.concat(F.regexp_extract(text, rf"^{apart}*", 0), F.concat_ws("", left))
    kept = F.when(F.col("hit").isNull(), text).otherwise(cut)
    return rows.join(hits, same, "left").select(
        *[kept.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
