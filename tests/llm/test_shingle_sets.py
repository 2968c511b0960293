"""Shingles of whole slices of texts at once: the sets of a word-by-word definition, and the time they take."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from martforge.llm import ngram_join
from martforge.llm.shingles import SLICE, shingle_sets, slices


def by_words(text, k):
    words = (text or "").encode("utf-8").lower().split()
    k = min(k, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def made(texts, k):
    return [s for lo, hi in slices(texts) for s in shingle_sets(texts.slice(lo, hi - lo), k)]


def odd_texts():
    draw = random.Random(3)
    odd = [None, "", " \n", "a", "A b", "a b c", "a b c d  A B C", "q\0 q", "q q\0", "é É " * 5, " a\tb\nc\x0bd\x0ce\rf\x1cg\x85h ",
           *[" ".join(["x" * n, "y", "x" * n, "z"]) for n in (7, 8, 9, 16, 63, 64, 65, 200)], "w " * SLICE]
    return odd + ["".join(draw.choice("abAB \n\t") for _ in range(draw.randrange(40))) for _ in range(800)]


@pytest.mark.parametrize("k", [1, 3, 5])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_sets_are_those_of_the_words(k, kind):
    texts = odd_texts()
    found = made(pa.array(["before"] * 3 + texts, kind).slice(3), k)
    assert len(found) == len(texts)
    one, other = {}, {}
    for text, s in zip(texts, found):
        words = by_words(text, k)
        assert len(s) == len(words) and (s[1:] > s[:-1]).all()
        assert one.setdefault(words, s.tobytes()) == s.tobytes() and other.setdefault(s.tobytes(), words) == words
    draw = random.Random(4)
    for _ in range(1000):
        i, j = draw.randrange(len(texts)), draw.randrange(len(texts))
        assert len(np.intersect1d(found[i], found[j])) == len(by_words(texts[i], k) & by_words(texts[j], k))


def test_no_texts():
    assert made(pa.array([], pa.string()), 3) == [] and [len(s) for s in made(pa.array([None, ""], pa.string()), 3)] == [0, 0]


def test_prefixes_hold_the_first_of_each_order():
    sets = made(pa.array([" ".join(str((i * j) % 91) for j in range(9 * i + 1)) for i in range(30)]), 2)
    sketch = ngram_join._counted(np.zeros(1 << ngram_join.SKETCH_BITS, np.int64), sets)
    for s, firsts in zip(sets, ngram_join.prefixes(sets, sketch, 4, 5)):
        need = len(s) - ngram_join.required(len(s), 4, 5) + 1
        rank = [sketch[int(x) >> (64 - ngram_join.SKETCH_BITS)] for x in s.tolist()]
        assert all(need <= len(first) <= len(s) and np.isin(first, s).all() for first in firsts)
        kept = set(firsts[0].tolist())
        assert max(r for r, x in zip(rank, s.tolist()) if x in kept) <= min(
            [r for r, x in zip(rank, s.tolist()) if x not in kept], default=1 << 60)


def test_words_are_not_hashed_one_by_one():
    draw = random.Random(5)
    texts = pa.array([" ".join(str(draw.randrange(50_000)) for _ in range(400)) for _ in range(1000)])

    def seconds(job):
        began = time.process_time()
        job()
        return time.process_time() - began

    one_by_one = lambda: [[xxhash.xxh64_intdigest(w) for w in t.encode().lower().split()] for t in texts.to_pylist()]
    assert min(seconds(lambda: made(texts, 3)) for _ in range(3)) < min(seconds(one_by_one) for _ in range(3))
