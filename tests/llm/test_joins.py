"""Similarity joins, line dedup, passages and components against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from martforge.llm import rounds
from martforge.llm.graph import connected_components
from martforge.llm.line_dedup import fuzzy_line_dedup
from martforge.llm.ngram_join import jaccard_components
from martforge.llm.substring_dedup import align, chains, distance, repeated_passages


def test_components(spark):
    rnd = random.Random(5)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1040)]
    want = brute.components({x for p in links for x in p}, links)
    got = connected_components(spark.createDataFrame([*links, (5, None)], "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: c for x, c in want.items()
                                                  if any(a != b and x in (a, b) for a, b in links)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copies(n=60, words=80, seed=3):
    """Copies of a base with 0 to 12 words changed: a dense group around the threshold."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(5000)}" for _ in range(words)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rnd.randrange(7)):
            w[rnd.randrange(words)] = f"x{rnd.randrange(9999)}"
        out.append((i, " ".join(w)))
    return out


ODD = [(100, None), (101, ""), (102, " \t"), (103, "one"), (104, "One"), (105, "one two"), (106, "two one"),
       (107, "a b c"), (108, "A  B\nc"), (109, "z " * 30_000), (110, "z z z")]


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 8, 10), (1, 1, 1)])
@pytest.mark.parametrize("few", [50_000, 0])
def test_jaccard_equals_plain(spark, monkeypatch, k, num, den, few):
    monkeypatch.setattr(rounds, "FEW", few)
    rows = near_copies() + ODD
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("token", F.lit("clash")).repartition(4)
    got = jaccard_components(docs, k=k, num=num, den=den).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == brute.jaccard(rows, k, num, den)


def test_jaccard_repeated_and_null_ids(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (2, "a b c d"), (None, "a b c d"), (None, "q r s t"), (7, None), (7, None)]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str)
    assert found == sorted([(5, 2, 2), (5, 2, 2), (2, 2, 2), (None, 2, 2), (None, 2, None), (7, 0, 7), (7, 0, 7)], key=str)
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def line_rows():
    rnd = random.Random(4)
    base = [" ".join(f"w{rnd.randrange(3000)}" for _ in range(rnd.randrange(1, 60))) for _ in range(25)]
    rows = []
    for d in range(30):
        lines = []
        for _ in range(rnd.randrange(6)):
            line = rnd.choice(base).split()
            if rnd.random() < 0.5 and len(line) > 20:
                line[rnd.randrange(len(line))] = f"w{rnd.randrange(3000)}"
            lines.append((" " if rnd.random() < 0.8 else "  ").join(line))
        rows.append((d, "\n".join(lines)))
    return rows + [(40, None), (41, ""), (42, "\n\n"), (43, "A\na\n\nb"), (44, "y" * 40_000)]


def test_line_dedup_equals_plain(spark):
    rows = line_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash")).withColumn("_id", F.lit(5)).withColumn("_cut", F.lit("x")).withColumn("text_key", F.lit(0)).repartition(3)
    got = {r.doc_id: r for r in fuzzy_line_dedup(docs).collect()}
    want = brute.line_cuts(rows)
    assert {d: list(r.cut_lines) for d, r in got.items() if r.cut_lines} == want and len(want) > 10
    for d, text in rows:
        kept = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in want.get(d, ()))
        assert got[d].text == kept
    assert set(got[0].asDict()) == {"doc_id", "text", "node", "_id", "_cut", "text_key", "n_lines", "cut_lines"}
    assert got[0]._id == 5 and got[0]._cut == "x" and got[0].text_key == 0


def test_line_dedup_repeated_rows_and_nothing(spark):
    rows = [(2, "p q"), (2, "p q"), (None, "P Q\nr"), (1, "s")]
    got = fuzzy_line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.text for r in got)) == ["p q", "p q", "r", "s"]
    assert fuzzy_line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_chains_are_best():
    rnd = random.Random(1)
    for _ in range(60):
        matches = sorted({(rnd.randrange(40), rnd.randrange(40)) for _ in range(rnd.randrange(1, 14))})

        def score(chain):
            return 6 * len(chain) - 0.1 * sum(b[0] - a[0] + b[1] - a[1] for a, b in zip(chain, chain[1:]))

        best = {}
        for x, y in matches:  # quadratic dynamic programme
            best[x, y] = 6 + max([0, *(v - 0.1 * (x - p + y - q) for (p, q), v in best.items() if p < x and q < y)])
        assert abs(score(chains(matches)[0]) - max(best.values())) < 1e-9


def test_alignment():
    a = [b"w%d" % i for i in range(100)]
    b = [b"p", b"q"] + a[:50] + [b"new"] + a[50:60] + a[61:] + [b"r"]
    start, end, other, other_end, alike = align(a, b, [(10, 12), (70, 72)])
    assert (start, end, other, other_end) == (0, 100, 2, 102) and abs(alike - 0.98) < 1e-9
    assert distance([b"a", b"b", b"c"], [b"a", b"c", b"d"]) == 2


def test_passages(spark):
    rnd = random.Random(2)
    text = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    passage, short = text(70), text(40)
    rows = [(i, " ".join(text(rnd.randrange(60, 200)) + passage + text(30))) for i in range(12)]
    changed = list(passage)
    for i in (10, 30, 55):
        changed[i] = "changed"
    rows += [(20, " ".join(text(50) + changed + text(20))), (21, " ".join(short + text(80))), (22, " ".join(text(80) + short)),
             (23, " ".join(text(100))), (24, None), (25, ""), (26, "z " * 20_000), (27, rows[3][1]), (28, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("seed", F.lit("clash")).repartition(3)
    got = repeated_passages(docs).collect()
    found = {x for r in got for x in (r.doc_id, r.other_id)}
    assert found == {*range(12), 20, 27, 28}
    assert len(set(brute.components(found, [(r.doc_id, r.other_id) for r in got]).values())) == 1
    of = dict(rows)
    for r in got:
        a = of[r.doc_id].split()[r.start:r.start + r.n_words]
        b = of[r.other_id].split()[r.other_start:r.other_start + r.other_words]
        assert r.doc_id > r.other_id and min(len(a), len(b)) >= 50
        assert r.similarity <= 1 - distance([x.encode() for x in a], [x.encode() for x in b]) / max(len(a), len(b)) + 1e-9
    assert len(got) <= 2 * len(found)
    assert repeated_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0
