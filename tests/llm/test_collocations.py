"""op13: phrases, cuts and ranks against a plain count of all phrases."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from martforge.llm.collocations import collocations
from martforge.llm.queries import op13_collocations
from tests.conftest import SF001, SF01


def plain(rows, least=100, longest=5, top=2000):
    total, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    found = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    dropped = set()
    for (lang, words), a in found.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if 100 * a >= 100 * found[lang, words[i:i + k]]:
                    dropped.add((lang, words[i:i + k]))
    rows = {}
    for (lang, words), a in found.items():
        if (lang, words) not in dropped:
            n = total[lang]
            score, _, l, r = min((1000 * a * n // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]],
                                  f[lang, words[k:]]) for k in range(1, len(words)))
            rows.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r, n))
    return {(lang, i, p.decode(), -a, l, r, n, -s) for lang, x in rows.items()
            for i, (s, a, p, l, r, n) in enumerate(sorted(x)[:top], 1)}


def same(frame, want):
    rows = [tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert len(rows) == len(want) and set(rows) == want


def texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs, [(r.lang, r.text) for r in docs.select("lang", "text").collect()]


def test_query_equals_plain(spark):
    _, rows = texts(spark, SF01)
    want = plain(rows)
    assert len(want) > 50 and any(p.count(" ") > 2 for _, _, p, *_ in want)
    same(op13_collocations(spark, SF01), want)


@pytest.mark.parametrize("lookup", [2_000_000, 0, 60])
def test_ways_agree(spark, lookup):
    docs, rows = texts(spark, SF001)
    same(collocations(docs, least=12, top=300, lookup=lookup), plain(rows, 12, top=300))


def test_odd_rows(spark):
    rows = [(None, None), ("en", ""), ("", "a b a b a b"), (None, "x y z\tx  y z! X Y z"), ("und", "x y. z x y z"),
            ("en", "one two three four five six. " * 6), ("en", "one two" + chr(0x1c) + "three a b two"), ("en", "." * 50),
            ("de", "Ä b ä b Ä b"), ("en", "same same same same same same"), *[("fr", "la la land")] * 3]
    docs = (spark.createDataFrame(rows, "lang string, text string").withColumn("id", F.lit(7))
            .withColumn("gap", F.lit("clash")).repartition(3))
    for lookup in (1000, 0):
        same(collocations(docs, least=2, top=5, lookup=lookup), plain(rows, 2, top=5))
    same(collocations(docs, least=10 ** 6), set())
    same(collocations(docs.limit(0), least=1), set())
