"""op11: near words and forms against a plain comparison of all pairs."""

import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from martforge.llm.queries import op11_spelling
from martforge.llm.spelling import near_words, one_edit_apart, spelling_variants
from tests.conftest import SF001


def plain_words(rows, least=5, count=3):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least and n >= count}


def plain_edit(a, b):
    """One edit, by trying all of them."""
    drops = lambda w: {w[:i] + w[i + 1:] for i in range(len(w))}
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return b in drops(a) or a in drops(b)


def plain(rows):
    n = plain_words(rows)
    near = {w: [] for w in n}
    by_size = {}
    for w in n:
        by_size.setdefault(len(w), []).append(w)
    for size, words in by_size.items():
        for i, a in enumerate(words):
            for b in words[i + 1:] + by_size.get(size + 1, []):
                if plain_edit(a, b):
                    near[a].append(b), near[b].append(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def got(frame):
    return [tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()]


def same(frame, want):
    rows = got(frame)
    assert len(rows) == len(want) and set(rows) == want


def test_query_equals_plain(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(f is not None for _, f, *_ in want) > 20 and sum(k > 3 for *_, k, _ in want) > 20
    same(op11_spelling(spark, SF001), want)


@pytest.fixture(scope="module")
def odd_rows():
    many = [(100 + i, " ".join(f"prefix{chr(97 + i % 26)}{chr(97 + j % 26)}" for j in range(60))) for i in range(40)]
    chain = [(1, "abcdefgh " * 3 + "abcdefgx " * 6 + "abcdefyx " * 12 + "abcdezyx " * 24)]
    ties = [(2, "ttttta tttttb tttttc " * 4 + "tttttd " * 8 + "ttttte " * 8)]
    shapes = [(3, "aaaaa aaaaaa aaaaaaa " * 5 + "x" * 300 + " " + "x" * 299 + "y " + "x" * 299 + " ") for _ in range(4)]
    accents = [(4, "Éclair éclair eclair ÉCLAIR a×b÷ccc " * 4)]
    return [(None, None), (5, None), (6, ""), (7, "123 , ."), (None, "hello hello hallo hallo hello"), *chain, *ties,
            *shapes, *accents, *many, *many]


@pytest.mark.parametrize("block_words", [4096, 8])
def test_odd_rows(spark, odd_rows, block_words):
    docs = (spark.createDataFrame(odd_rows, "doc_id long, text string").withColumn("word", F.lit("clash"))
            .withColumn("base", F.lit(1)).repartition(4))
    want = plain(odd_rows)
    assert {"abcdezyx"} == {r for w, _, r, *_ in want if w == "abcdefgh"} and any(len(w) == 300 for w, *_ in want)
    same(spelling_variants(docs, block_words=block_words), want)


def test_each_pair_once(spark):
    words = ["aaaaa", "aaaaaa", "aaaaab", "baaaaa", "ababab", "bababa", "abaab", "abab" * 4, "abab" * 4 + "a"]
    frame = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long")
    found = {r.word: r.n_near for r in near_words(frame).collect()}
    want = {w: sum(plain_edit(w, v) for v in words if v != w) for w in words}
    assert found == {w: k for w, k in want.items() if k}
    assert all(one_edit_apart(a, b) == plain_edit(a, b) for a in words for b in words if a != b)


def test_empty(spark):
    assert got(spelling_variants(spark.createDataFrame([], "doc_id long, text string"))) == []
