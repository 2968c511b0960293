"""Registered queries of the llm operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.llm.shard import shuffle_into_shards
    from martforge.session import scratch_path
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return shuffle_into_shards(docs, scratch_path(spark, "shards"), shards=8).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.llm.ngram_join import jaccard_components
    found = jaccard_components(_read(spark, sf_dir, "documents"), k=3, num=90, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.llm.token_files import token_digests
    return token_digests(_read(spark, sf_dir, "documents"), vocabulary_path(), end_id=2)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.llm.exact_dedup import exact_dedup
    return exact_dedup(_read(spark, sf_dir, "documents"))


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.llm.substring_dedup import passage_classes
    return passage_classes(_read(spark, sf_dir, "documents"), least=50, similarity=0.8)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.llm.chat import format_chats
    return format_chats(_read(spark, sf_dir, "conversations"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.llm.line_dedup import fuzzy_line_dedup
    found = fuzzy_line_dedup(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", F.col("n_lines").cast("long").alias("n_lines"),
                        F.size("cut_lines").cast("long").alias("n_cut"), "cut_lines")


def vocabulary_path() -> str:
    """The byte-level BPE file of the public tokenizers package, at the same place on every node."""
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.llm.bpe import decode_documents, encode_documents
    path = vocabulary_path()
    encoded = encode_documents(_read(spark, sf_dir, "documents").select("doc_id", "text"), path).drop("text")
    return decode_documents(encoded, path).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.llm.decontaminate import scan
    found = scan(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", F.size("hit").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.llm.quality import fit_on_corpus, held_out
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_on_corpus(docs, _read(spark, sf_dir, "labels"))
    return model.score(docs).select("doc_id", held_out().alias("held_out"), "score",
                                    F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.llm.spelling import spelling_variants
    return spelling_variants(_read(spark, sf_dir, "documents"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.llm.suffix_dedup import remove_repeats
    length = lambda span: span["end"] - span["start"]
    return remove_repeats(_read(spark, sf_dir, "documents"), least=50).select(
        "doc_id", "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + length(span)).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from martforge.llm.collocations import collocations
    return collocations(_read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_shard": op1_shard,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_token_files": op3_token_files,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_passages": op5_passages,
    "op6_chat": op6_chat,
    "op7_line_dedup": op7_line_dedup,
    "op8_bpe": op8_bpe,
    "op9_decontaminate": op9_decontaminate,
    "op10_quality": op10_quality,
    "op11_spelling": op11_spelling,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_collocations": op13_collocations,
}

ORACLE = {
    "op4_exact_dedup": r"""
        WITH n AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM n""",
    "op9_decontaminate": r"""
        WITH d AS (
          SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
          FROM documents),
        b AS (
          SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
          FROM benchmark),
        bw AS (
          SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS g
          FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(s) WHERE len(w) > 0),
        ks AS (SELECT DISTINCT k FROM bw),
        dw AS (
          SELECT doc_id, s, k, array_to_string(w[s:s + k - 1], ' ') AS g
          FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, ks WHERE len(w) >= k)),
        h AS (SELECT DISTINCT dw.doc_id, dw.s, dw.k, bw.item_id FROM dw JOIN bw USING (k, g)),
        p AS (SELECT doc_id, count(DISTINCT q) AS n_hit
              FROM (SELECT doc_id, unnest(range(s, s + k)) AS q FROM h) GROUP BY doc_id),
        i AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                     string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM h GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN p USING (doc_id) LEFT JOIN i USING (doc_id)""",
}
