"""Merges look up the pairs that they make, not all pairs again."""

import random

import numpy as np
import public_tokenizers

from martforge.llm.bpe import NONE, PairTable, Vocabulary

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


def many_words(n):
    rnd = random.Random(5)
    return ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzéß.,'") for _ in range(rnd.randrange(1, 12))) for _ in range(n)]


def test_merges_look_up_new_pairs_only(monkeypatch):
    vocabulary, words = Vocabulary(PATH), [w.encode() for w in many_words(3000)]
    looked, find = [], Vocabulary._rank
    monkeypatch.setattr(Vocabulary, "_rank", lambda self, a, b: (looked.append(np.size(a)), find(self, a, b))[1])
    ids = vocabulary.merge(words)
    merges = sum(map(len, words)) - sum(map(len, ids))
    width = max(map(len, words))
    assert sum(looked) <= len(words) * width + 2 * merges


def test_pair_table():
    rnd = np.random.default_rng(1)
    pairs = rnd.choice(1 << 34, 5000, replace=False)
    table = PairTable(pairs[:4000])
    assert table.find(pairs[:4000]).tolist() == list(range(4000))
    assert (table.find(pairs[4000:]) == NONE).all()
    assert (PairTable(np.empty(0, np.int64)).find(pairs) == NONE).all()
    assert PairTable(np.array([7, 9, 7])).find(np.array([9, 7])).tolist() == [1, 0]
