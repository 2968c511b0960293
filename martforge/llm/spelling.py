"""Spelling variants: near words by blocked Gram matrices of letter counts, and the form that each word stands for.

1. Runs of Latin letters are counted per document and task, then over all documents; frequent ones of some length are
   the words.
2. Words that differ by one inserted, deleted or replaced letter share a half: where the shorter one has m letters,
   either the first m // 2 or the last m - m // 2. Each word goes to the blocks of its halves, as the shorter (or equal)
   word of its own length's blocks and as the longer one of those a letter shorter. Blocks so hold two adjacent lengths.
3. A task takes blocks in order, some hundred words at a time: one NumPy product of their letter-count matrices gives
   all squared distances, and pairs of at most two (one edit changes no more) are verified letter by letter. What
   leaves the task is one row per word and tile - how many near words, and the best one - never a pair.
4. A block of more than ``block_words`` words is dealt into chunks by hash, and each two chunks are a block of their own.
5. Forms point at words at least twice as frequent, so chains end; roots are found by pointer jumping.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm import python_tasks
from martforge.llm.shingles import batches_of
from martforge.session import materialize

# fixed values of the contract
LETTERS = "A-Za-zÀ-ÿ"
DROP_EVERY = 97

_RUN = re.compile(f"[{LETTERS}]+")
#: Words that a task counts before it hands them on.
HELD_WORDS = 400_000
#: Rows and columns of one Gram matrix.
TILE = 512
#: Words up to this length are verified together, longer ones pair by pair.
SHORT = 64

# Latin-1 byte -> column of the letter counts: a-z, then U+00C0 on.
_COLUMN = np.zeros(256, np.int64)
_COLUMN[97:123] = np.arange(26)
_COLUMN[0xC0:] = 26 + np.arange(64)


def _counting(least: int):
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def task(batches):
        total: Counter = Counter()

        def rows():
            held = list(total.items())
            total.clear()
            return ({"word": w, "n": n} for w, n in held)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                lower = (text.as_py() or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in Counter(_RUN.findall(lower)).items():
                    if len(run) < least:
                        continue
                    h = zlib.crc32(run.encode(), seed)
                    if h % DROP_EVERY == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                        if len(run) < least:
                            continue
                    total[run] += n
                if len(total) > HELD_WORDS:
                    yield from batches_of(rows(), schema, 20_000)
        yield from batches_of(rows(), schema, 20_000)

    return task


def spelled_words(docs: DataFrame, least_letters: int = 5, least_count: int = 3) -> DataFrame:
    """``word, n`` of the corpus: lower-cased letter runs (``doc_id, text``), some with one letter dropped by a hash."""
    found = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(_counting(least_letters), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def one_edit_apart(a: str, b: str) -> bool:
    """Whether exactly one code point is inserted, deleted or replaced between two words."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)):] == b[at + 1:]


class _Block:
    """Words of consecutive blocks: ``group`` tells the blocks apart."""

    def __init__(self, words, n, base, side, group, chunk):
        self.words, self.n = words, np.array(n, np.int64)
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.base, self.group, self.chunk = np.array(base, np.int64), np.array(group, np.int64), np.array(chunk, np.int64)
        self.suffix = np.array([s == "s" for s in side])
        self.letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        self.start = np.cumsum(self.size) - self.size
        row = np.repeat(np.arange(len(words)), self.size)
        counts = np.bincount(row * 90 + _COLUMN[self.letters], minlength=90 * len(words))
        self.vector = counts.reshape(-1, 90).astype(np.float32)
        self.square = (self.vector * self.vector).sum(axis=1)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Near words (i < j), each pair of words once over all blocks."""
        found, n = [], len(self.words)
        for a in range(0, n, TILE):
            rows = slice(a, min(a + TILE, n))
            last = self.group[rows.stop - 1]
            for b in range(a, n, TILE):
                if self.group[b] > last:
                    break
                cols = slice(b, min(b + TILE, n))
                gram = self.vector[rows] @ self.vector[cols].T
                apart = self.square[rows, None] + self.square[None, cols] - 2 * gram
                near = (apart <= 2) & (self.group[rows, None] == self.group[None, cols])
                i, j = np.nonzero(near)
                found.append((i + a, j + b))
        i, j = (np.concatenate(x) for x in zip(*found))
        own = np.minimum(self.size[i], self.size[j]) == self.base[i]  # two of the longer words meet in their own blocks
        keep = (i < j) & own & ((self.chunk[i] != self.chunk[j]) | (self.chunk[i] < 0))
        i, j = i[keep], j[keep]
        return tuple(x[self._verified(i, j)] for x in (i, j))

    def _verified(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """One edit apart; and in a block of last parts, first parts that differ (else the pair is in another block)."""
        swap = self.size[i] > self.size[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        good = np.zeros(len(i), bool)
        short = self.size[j] <= SHORT
        for at in np.array_split(np.flatnonzero(short), max(1, int(short.sum()) // 50_000)):
            if not len(at):
                continue
            width = int(self.size[j[at]].max()) + 1
            place = np.arange(width)

            def letters(k):
                inside = place < self.size[k][:, None]
                return np.where(inside, self.letters[np.minimum(self.start[k][:, None] + place, len(self.letters) - 1)], 0)

            x, y = letters(i[at]), letters(j[at])
            equal = x == y
            first = np.where(equal.all(axis=1), width, equal.argmin(axis=1))
            same = self.size[i[at]] == self.size[j[at]]
            replaced = (~equal).sum(axis=1) == 1
            shifted = ((x[:, :-1] == y[:, 1:]) | (place[:-1] < first[:, None])).all(axis=1)
            known = self.suffix[i[at]] & (first >= self.base[i[at]] // 2)
            good[at] = np.where(same, replaced, shifted & (first < width)) & ~known
        for at in np.flatnonzero(~short).tolist():
            a, b, half = self.words[i[at]], self.words[j[at]], self.base[i[at]] // 2
            good[at] = one_edit_apart(a, b) and not (self.suffix[i[at]] and a[:half] == b[:half])
        return good

    def best(self) -> list[dict]:
        """Each word that has near ones here: how many, and the most frequent of them."""
        i, j = self.pairs()
        i, j = np.concatenate((i, j)), np.concatenate((j, i))
        if not len(i):
            return []
        rank = np.empty(len(self.words), np.int64)
        rank[sorted(range(len(self.words)), key=self.words.__getitem__)] = np.arange(len(self.words))
        order = np.lexsort((rank[j], -self.n[j], i))
        i, j = i[order], j[order]
        head, count = np.unique(i, return_index=True, return_counts=True)[1:]
        return [{"word": self.words[i[k]], "near": c, "best_n": int(self.n[j[k]]), "best": self.words[j[k]]}
                for k, c in zip(head.tolist(), count.tolist())]


def _blocks(batches):
    schema = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
    names = ["word", "n", "base", "side", "group", "chunk"]

    def rows():
        held: dict[str, list] = {c: [] for c in names}
        last, number = None, 0
        for batch in batches:
            part = {c: batch.column(c).to_pylist() for c in ("word", "n", "base", "side", "half", "low", "high", "chunk")}
            for word, n, base, side, half, low, high, chunk in zip(*part.values()):
                if (key := (base, side, half, low, high)) != last:
                    if len(held["word"]) >= TILE:
                        yield from _Block(*held.values()).best()
                        held = {c: [] for c in names}
                    last, number = key, number + 1
                # inside one chunk all pairs count (-1), between two only those of both
                for c, v in zip(names, (word, n, base, side, number, -1 if low == high else chunk)):
                    held[c].append(v)
        if held["word"]:
            yield from _Block(*held.values()).best()

    yield from batches_of(rows(), schema, 5000)


def near_words(words: DataFrame, block_words: int = 4096) -> DataFrame:
    """``word, n_near, best_n, best`` of the words (``word, n``) that have near ones; the best is the most frequent,
    of equally frequent ones the first in code-point order."""
    size, base = F.char_length("word"), F.col("base")
    half = F.floor(base / 2).cast("int")
    place = (words.select("word", "n", F.explode(F.array(size, size - 1)).alias("base"))
             .withColumn("side", F.explode(F.array(F.lit("p"), F.lit("s"))))
             .withColumn("half", F.when(F.col("side") == "p", F.substring("word", F.lit(1), half))
                         .otherwise(F.right("word", base - half))))
    place = materialize(place, "spelling-blocks")
    key = ["base", "side", "half"]
    large = (place.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > block_words)
             .select(*key, F.ceil(F.col("rows") * 2 / block_words).cast("int").alias("chunks")))
    chunks = F.coalesce("chunks", F.lit(1))
    chunk = F.pmod(F.xxhash64("word"), chunks).cast("int")
    dealt = (place.join(large, key, "left").withColumn("chunk", chunk)
             .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
             .withColumn("low", F.least("chunk", "other")).withColumn("high", F.greatest("chunk", "other"))
             .select("word", "n", *key, "low", "high", "chunk"))
    whole = [*key, "low", "high"]
    found = (dealt.repartition(*whole).sortWithinPartitions(*whole)
             .mapInArrow(_blocks, "word string, near long, best_n long, best string"))
    first = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return (found.groupBy("word").agg(F.sum("near").alias("n_near"), first.alias("first"))
            .select("word", "n_near", (-F.col("first.m")).alias("best_n"), F.col("first.best").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where following ``form`` from ``word`` ends. Each round doubles the steps."""
    up = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        over = up.select(F.col("word").alias("root"), F.col("root").alias("then"))
        further = materialize(up.join(over, "root", "left").select(
            "word", F.coalesce("then", "root").alias("root"), F.col("then").isNotNull().alias("moved")), "spelling-roots")
        if further.filter("moved").isEmpty():
            return up
        up = further.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = 5,
                      least_count: int = 3, ratio: int = 2, block_words: int = 4096) -> DataFrame:
    """One row per word of the corpus: ``word, form, root, n, n_near, form_n``.

    A word's near words differ from it by exactly one inserted, deleted or replaced code point. Its form is the near
    word of largest n (ties: first in code-point order), if that n is at least ``ratio`` times its own, else null; its
    root is where forms lead to, the word itself if it has none. ``block_words`` bounds the words that are compared in
    one place; larger blocks are split into pairs of chunks, with the same result.

    Null and empty texts, and texts without letters, have no words. A null id is hashed as an empty one. Repeated rows
    count each time. Long runs of letters are words like others. An empty table gives no rows. Other columns are not
    read.
    """
    if ratio < 2 or least_letters < 2:
        raise ValueError("ratio >= 2 (forms must not run in circles) and least_letters >= 2 are asked for")
    python_tasks(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    words = materialize(spelled_words(docs, least_letters, least_count), "spelling-words")
    likes = F.col("best_n") >= ratio * F.col("n")
    found = materialize(words.join(near_words(words, block_words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(likes, F.col("best")).alias("form"),
        F.when(likes, F.col("best_n")).alias("form_n")), "spelling-forms")
    return found.join(roots(found.filter("form is not null")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
