"""The bound of the frequent words where all counts are large."""

import pytest
from martforge.llm import bpe


@pytest.mark.parametrize("counts,words,want", [
    ([100_000 + 1000 * i for i in range(50)], 8, 8), ([10**6 * (i + 1) for i in range(20)], 5, 5),
    ([10**12 + i for i in range(20)], 5, 0), ([2, 3, 3, 4], 3, 3), ([], 5, 0)])
def test_words_are_bounded(spark, monkeypatch, counts, words, want):
    rows = [(b"w%d" % i, n) for i, n in enumerate(counts)]
    monkeypatch.setattr(bpe, "word_counts", lambda *_: spark.createDataFrame(rows, "word binary, n long"))
    monkeypatch.setattr(bpe, "compile_lexicon", lambda top, merged: top)
    monkeypatch.setattr(bpe, "Vocabulary", lambda path: type("V", (), {"merge": lambda self, top: None})())
    got = bpe.frequent_lexicon(None, "text", "path", words=words)
    assert sorted(got) == sorted(sorted((w for w, n in rows), key=lambda w: -dict(rows)[w])[:want])


def test_empty_lexicon_compiles():
    import public_tokenizers
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    assert bpe.compile_lexicon([], bpe.Vocabulary(path).merge([])) is not None
