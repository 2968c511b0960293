"""Collocations by SETM: occurrence relations of growing phrases, merge-joined by piece and adjacent position.

1. Texts are cut into pieces and words; words are counted per language, and the frequent ones get dense ids.
2. Relation R1 holds the occurrences of frequent words: one row per document with its positions in ascending order (as
   gaps to the position before) and the word ids. A piece's end takes a position of its own, so that words of two
   pieces are never adjacent. Each relation is written to the shared folder in this order.
3. From Rk to Rk+1: entries at adjacent positions are merged in one sequential pass; the pair (id here, id there) names
   a phrase one word longer exactly. Groups are counted, those frequent enough get ids and keep what they are made of,
   and the occurrences of the others are dropped (semi-join) before the next length.
4. Of each phrase its parts' counts are at hand, so the lowest-scoring cut is found in exact integers.

The semi-join looks ids up in a broadcast table while that has at most ``lookup`` rows; beyond it the occurrences are
joined by shuffle and put together again per document. Both ways give the same relation.
"""

from __future__ import annotations

from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm import python_tasks
from martforge.llm.shingles import batches_of
from martforge.operators.keys import dense_key
from martforge.session import materialize

#: Words that a task counts before it hands them on.
HELD_WORDS = 400_000
#: Occurrences that are counted at once.
HELD_PAIRS = 2_000_000
#: Most bytes of words (for R1) that are broadcast.
LOOKUP_BYTES = 32 << 20

# Piece ends (fixed values of the contract) become "."; a tab is a space.
_ENDS = bytes.maketrans(b",;:!?\n\x0b\x0c\r\t", b"......... ")
_RELATION = "gap array<int>, id array<long>"


def tokens(text: str | None) -> list[bytes]:
    """A text's words in order (A-Z in lower case); ``.`` stands where a piece ends."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower().translate(_ENDS)
    return raw.replace(b".", b" . ").split()


def _counting(batches):
    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])
    total: dict[str, Counter] = {}

    def rows():
        held = [(lang, w, n) for lang, words in total.items() for w, n in words.items()]
        total.clear()
        return ({"lang": lang, "word": w, "n": n} for lang, w, n in held)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            count = total.setdefault(lang, Counter())
            count.update(tokens(text.as_py()))
            count.pop(b".", None)
        if sum(map(len, total.values())) > HELD_WORDS:
            yield from batches_of(rows(), schema, 20_000)
    yield from batches_of(rows(), schema, 20_000)


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _relation(positions: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    """Rows of ``sizes`` entries each; the first gap of a row is 0."""
    gap = np.diff(positions, prepend=0)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    gap[starts] = 0
    return pa.RecordBatch.from_arrays([_lists(gap, sizes, pa.int32()), _lists(ids, sizes, pa.int64())], ["gap", "id"])


def _first_looked_up(shared):
    """R1 from texts by a broadcast {language: {word: id}}."""
    def task(batches):
        known = shared.value
        for batch in batches:
            places, own = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = tokens(text.as_py())
                ids = np.fromiter(map(known.get(lang, {}).get, words, repeat(-1)), np.int64, len(words))
                at = np.flatnonzero(ids >= 0)
                if len(at) > 1:
                    places.append(at), own.append(ids[at])
            if places:
                yield _relation(np.concatenate(places), np.concatenate(own), np.array([len(x) for x in places]))

    return task


def _first_flat(batches):
    """Words with their places, to be joined with the frequent ones."""
    schema = pa.schema([("block", pa.int64()), ("pos", pa.int64()), ("lang", pa.string()), ("word", pa.binary())])
    for batch in batches:
        for block, lang, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            rows = ({"block": block, "pos": i, "lang": lang, "word": w} for i, w in enumerate(tokens(text)) if w != b".")
            yield from batches_of(rows, schema, 20_000)


class _Entries:
    """The entries of a batch of relation rows, and the pairs at adjacent positions."""

    def __init__(self, batch: pa.RecordBatch):
        gaps, ids = (batch.column(batch.schema.get_field_index(c)) for c in ("gap", "id"))
        gap = gaps.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.ids = ids.flatten().to_numpy(zero_copy_only=False)
        self.sizes = np.diff(np.asarray(gaps.offsets))
        self.positions = np.cumsum(gap)
        self.at = np.flatnonzero(gap[1:] == 1)
        self.left, self.right = self.ids[self.at], self.ids[self.at + 1]

    def kept(self, of_pair: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions, ids and row sizes of the pairs that are kept."""
        at = self.at[of_pair]
        row = np.searchsorted(np.cumsum(self.sizes), at, side="right")
        return self.positions[at], ids, np.bincount(row, minlength=len(self.sizes))


def _pair_counts(left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    first = np.flatnonzero(np.concatenate(([True], (left[1:] != left[:-1]) | (right[1:] != right[:-1]))))
    n = np.diff(first, append=len(left))
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (left[first], right[first], n)], ["l", "r", "n"])


def _pairing(batches):
    """Counts of adjacent pairs, combined before they leave the task."""
    left, right, held = [], [], 0
    for batch in batches:
        if len(batch):
            found = _Entries(batch)
            left.append(found.left), right.append(found.right)
            held += len(found.at)
        if held > HELD_PAIRS:
            yield _pair_counts(np.concatenate(left), np.concatenate(right))
            left, right, held = [], [], 0
    if held:
        yield _pair_counts(np.concatenate(left), np.concatenate(right))


def _next_looked_up(shared):
    """The next relation by a broadcast of the frequent pairs: (left + (right << 32), sorted) and their ids."""
    def task(batches):
        keys, ids = shared.value
        for batch in batches:
            if not len(batch) or not len(keys):
                continue
            found = _Entries(batch)
            key = (found.left << 32) | found.right
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[place] == key
            positions, own, sizes = found.kept(hit, ids[place[hit]])
            some = sizes > 1  # an entry alone joins nothing
            keep = np.repeat(some, sizes)
            if keep.any():
                yield _relation(positions[keep], own[keep], sizes[some])

    return task


def _next_flat(batches):
    """Adjacent pairs with their places, to be joined with the frequent ones."""
    for batch in batches:
        if len(batch):
            found = _Entries(batch)
            positions, _, sizes = found.kept(np.ones(len(found.at), bool), found.left)
            block = np.repeat(batch.column(batch.schema.get_field_index("block")).to_numpy(), sizes)
            columns = [pa.array(x, pa.int64()) for x in (block, positions, found.left, found.right)]
            for at in range(0, len(block), 100_000):
                yield pa.RecordBatch.from_arrays([c[at:at + 100_000] for c in columns], ["block", "pos", "l", "r"])


def _rows_again(entries: DataFrame) -> DataFrame:
    """A relation from entries (block, pos, id); a block is one document, so its row is no longer than a text."""
    first = F.element_at("x", 1)["pos"]
    gaps = F.transform(F.col("x"), lambda e, i: (e["pos"] - F.when(i == 0, first).otherwise(
        F.element_at("x", F.greatest(i, F.lit(1)))["pos"])).cast("int"))
    return (entries.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("x"))
            .filter(F.size("x") > 1).select(gaps.alias("gap"), F.col("x.id").alias("id")))


def _numbered(phrases: DataFrame, order: list[str]) -> DataFrame:
    return materialize(dense_key(phrases, order, "id"), "phrases")


def _first_relation(docs: DataFrame, words: DataFrame, lookup: int) -> DataFrame:
    size = words.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("word") + 16).alias("bytes")).first()
    if size["rows"] <= lookup and (size["bytes"] or 0) <= LOOKUP_BYTES:
        known: dict[str, dict[bytes, int]] = {}
        for r in words.select("lang", "word", "id").toLocalIterator():
            known.setdefault(r["lang"], {})[bytes(r["word"])] = r["id"]
        shared = docs.sparkSession.sparkContext.broadcast(known)
        return docs.select("lang", "text").mapInArrow(_first_looked_up(shared), _RELATION)
    flat = docs.select(F.monotonically_increasing_id().alias("block"), "lang", "text").mapInArrow(
        _first_flat, "block long, pos long, lang string, word binary")
    return _rows_again(flat.join(words.select("lang", "word", "id"), ["lang", "word"]).select("block", "pos", "id"))


def _next_relation(relation: DataFrame, phrases: DataFrame, below: int, lookup: int) -> DataFrame:
    """Rk+1 of Rk and the frequent phrases of k + 1 words; ``below`` is the number of those of k words."""
    rows = phrases.count()
    if rows <= lookup and below < 1 << 31:
        found = phrases.select("l", "r", "id").toArrow()
        left, right, ids = (found.column(i).to_numpy() for i in range(3))
        key = (left << 32) | right
        order = np.argsort(key)
        shared = relation.sparkSession.sparkContext.broadcast((key[order], ids[order]))
        return relation.mapInArrow(_next_looked_up(shared), _RELATION)
    flat = relation.withColumn("block", F.monotonically_increasing_id()).mapInArrow(
        _next_flat, "block long, pos long, l long, r long")
    return _rows_again(flat.join(phrases.select("l", "r", "id"), ["l", "r"]).select("block", "pos", "id"))


def _scoring(batches):
    """Lowest-scoring cut of each phrase, in Python's integers."""
    for batch in batches:
        rows = batch.to_pydict()
        score, left, right = [], [], []
        for a, n, pre, suf in zip(rows["a"], rows["n"], rows["pre"], rows["suf"]):
            k = len(pre)
            s, _, l, r = min((1000 * a * n // (pre[i - 1] * suf[k - i - 1]), i, pre[i - 1], suf[k - i - 1])
                             for i in range(1, k))
            score.append(s), left.append(l), right.append(r)
        phrase = [b" ".join(w).decode("utf-8") for w in rows["words"]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["lang"], pa.string()), pa.array(phrase, pa.string()),
             *[pa.array(x, pa.int64()) for x in (rows["a"], left, right, rows["n"], score)]],
            ["lang", "phrase", "a", "l", "r", "n", "score"])


def frequent_phrases(docs: DataFrame, least: int, longest: int, lookup: int) -> tuple[DataFrame, list[DataFrame]]:
    """``lang, n`` and, for 1 to ``longest`` words, the frequent phrases: ``id, lang, words, a, pre, suf`` (from two words
    on ``l, r``, the ids of the phrase without its last and without its first word). ``pre`` and ``suf`` have the counts
    of its first and last 1, 2, ... words. ``docs`` has lang (not null) and text."""
    counted = materialize(docs.select("lang", "text").mapInArrow(_counting, "lang string, word binary, n long")
                          .groupBy("lang", "word").agg(F.sum("n").alias("n")), "phrase-words")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    words = _numbered(counted.filter(F.col("n") >= least), ["lang", "word"])
    one = F.array("n")
    levels = [words.select("id", "lang", F.array("word").alias("words"), F.col("n").alias("a"), one.alias("pre"),
                           one.alias("suf"))]
    relation = materialize(_first_relation(docs, words, lookup), "occurrences")
    below = words.count()
    for k in range(2, longest + 1):
        pairs = (relation.mapInArrow(_pairing, "l long, r long, n long").groupBy("l", "r").agg(F.sum("n").alias("a"))
                 .filter(F.col("a") >= least))
        pairs = _numbered(pairs, ["l", "r"])
        shorter = levels[-1]
        left = shorter.select(F.col("id").alias("l"), "lang", F.col("words").alias("head"), "pre")
        right = shorter.select(F.col("id").alias("r"), F.element_at("words", -1).alias("last"), "suf")
        levels.append(materialize(pairs.join(left, "l").join(right, "r").select(
            "id", "l", "r", "lang", F.array_append("head", F.col("last")).alias("words"), "a",
            F.array_append("pre", F.col("a")).alias("pre"), F.array_append("suf", F.col("a")).alias("suf")), "phrases"))
        if k < longest:
            relation = materialize(_next_relation(relation, pairs, below, lookup), "occurrences")
            below = pairs.count()
    return totals, levels


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 100, longest: int = 5,
                 top: int = 2000, lookup: int = 2_000_000) -> DataFrame:
    """The best ``top`` phrases of 2 to ``longest`` words of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``n`` counts a language's words, ``a`` a phrase's occurrences inside pieces (at least ``least``). Cut after some
    first words the phrase has parts that occur l and r times; the cut with the smallest floor(1000 * a * n / (l * r))
    counts, the first of equal ones. Phrases that only occur inside one longer candidate are left out (the longer one
    may itself be left out). Order: score and a descending, phrase ascending in UTF-8 bytes.

    Null texts are empty, null languages count as ``und`` (with those that are called so); an empty language name is a
    language. Repeated rows count each time. An empty table, or one without frequent phrases, gives no rows. Other
    columns are not read.
    """
    if least < 1 or longest < 2:
        raise ValueError("least >= 1 and longest >= 2 are asked for")
    python_tasks(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    totals, levels = frequent_phrases(docs, least, longest, lookup)
    found = []
    for k, phrases in enumerate(levels[1:], 1):
        if k + 1 < len(levels):  # one word more, and as often: it always stands inside that phrase
            longer = levels[k + 1]
            inside = longer.select(F.explode(F.array("l", "r")).alias("id"), "a").distinct()
            phrases = phrases.join(inside, ["id", "a"], "left_anti")
        found.append(phrases.select("lang", "words", "a", "pre", "suf"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    scored = every.join(totals, "lang").select("lang", "words", "a", "n", "pre", "suf").mapInArrow(
        _scoring, "lang string, phrase string, a long, l long, r long, n long, score long")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return scored.withColumn("rank", place.cast("long")).filter(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
