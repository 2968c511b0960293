"""Exact dedup and decontamination against DuckDB and on odd rows."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from martforge.llm.decontaminate import decontaminate, scan
from martforge.llm.exact_dedup import exact_dedup
from martforge.llm.queries import ORACLE, QUERIES

SF001 = "/root/testdata/sf0.001"

ROWS = [(3, "a  b"), (1, "a\tb"), (2, "a b"), (2, "a b"), (4, None), (5, ""), (6, " "), (None, "a b"), (None, None),
        (7, "x" * 50_000), (8, "x" * 50_000), (9, "a b ")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("digest", F.lit("clash")).withColumn(
        "content", F.lit(1)).repartition(5)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF001}/{t}.parquet'")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF001).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def plain_dedup(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (doc_id, _), n in zip(rows, norm):
        ids = [d for (d, _), m in zip(rows, norm) if m == n]
        out.append((doc_id, min((d for d in ids if d is not None), default=None), len(ids)))
    return out


@pytest.mark.parametrize("digest", [None, lambda c: F.pmod(F.length(c), F.lit(2))])
def test_exact_dedup_on_odd_rows(odd, digest):
    got = exact_dedup(odd, salts=3, **({"digest": digest} if digest else {})).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=key) == sorted(plain_dedup(ROWS), key=key)
    kept = {}
    for r in got:
        kept[r.text_sha256] = kept.get(r.text_sha256, 0) + r.kept
    assert set(kept.values()) == {1}


def test_exact_dedup_of_nothing(odd):
    assert exact_dedup(odd.limit(0)).count() == 0


ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "short item"), (3, None), (4, "..."),
         (5, "Solo"), (6, "three four five six seven eight nine ten eleven twelve")]
DOCS = [(1, "Say: ONE two, three four five six seven eight nine ten! eleven twelve."), (2, None), (3, ""),
        (4, "a short item and a solo"), (4, "a short item and a solo"), (None, "solo"), (5, "shor item"),
        (6, "nothing here at all"), (7, "É solo é" + " word" * 30_000 + " short item"),
        (8, "two three four five six seven eight nine ten one")]


def plain_scan(docs, items, n=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - n, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if of := windows.get(tuple(w[i:i + size])):
                    hit.update(range(i, i + size))
                    found |= of
        out.append((doc_id, len(w), sorted(hit), sorted(found)))
    return out


@pytest.mark.parametrize("most", [4_000_000, 0])
def test_scan_on_odd_rows(spark, most):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("words", F.lit("clash"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = [(r.doc_id, r.n_words, list(r.hit), list(r.items)) for r in scan(docs, items, broadcast_grams=most).collect()]
    key = lambda r: (r[0] is None, r[0], r[1:])
    assert sorted(got, key=key) == sorted(plain_scan(DOCS, ITEMS), key=key)


def test_decontaminate_removes_documents_or_spans(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    for c in ("extra", "_hit_id", "_hit_key", "_hit", "hit", "hit_id", "id", "row", "text_key", "words"):
        docs = docs.withColumn(c, F.lit(1))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    left = decontaminate(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 3, 5, 6, 8]
    cut = {(r.doc_id, r.text) for r in decontaminate(docs, items, remove="spans").collect()}
    assert {(1, "Say: "), (2, None), (4, "a and a "), (None, ""), (6, "nothing here at all")} <= cut
    assert any(d == 7 and t.startswith("É é word") and t.endswith("word ") for d, t in cut)


def test_empty_sides(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert scan(docs.limit(0), items).count() == 0
    assert all(r.hit == [] for r in scan(docs, items.limit(0)).collect())
