"""Byte-level BPE over a minimal acyclic transducer of frequent words; other words are merged exactly.

A word here is one match of the tokenizer's splitting pattern; merges never cross words. The corpus' most frequent
words are compiled, with their ids, into an automaton that shares suffixes: each edge carries the number of words
that sort before the ones behind it, so the sum along a word's path is its rank, and the rank finds its ids
(Lucchesi and Kowaltowski's minimal perfect hash). The automaton is a handful of flat arrays that each Python worker
memory-maps; a batch's words walk through it together, one byte a step. Words that it does not have are merged by
the ranks of the vocabulary, also a batch at a time.
"""

from __future__ import annotations

import json
import mmap
import re
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm import KEPT, python_tasks
from martforge.llm.shingles import batches_of
from martforge.session import materialize

# Letters and numbers up to U+024F, as the splitting pattern's \p{L} and \p{N} have them; texts with other characters
# beyond ASCII (see _OTHER) are split by the tokenizers library itself.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ", "0-9\xb2\xb3\xb9\xbc-\xbe", " \t\n\r\x0b\x0c"
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_OTHER = re.compile("[^\t-\r -~\xa1-ɏ]")
#: Longest word, in bytes, that is merged in the batch; longer ones are merged one by one.
_SHORT = 48
#: Bits of a place in such a word, and the rank of pairs that don't merge.
_PLACE_BITS, NONE = 6, 1 << 40

class PairTable:
    """Ranks of the pairs of symbols that merge: an open hash table, looked up for many pairs at a time."""

    def __init__(self, pairs: np.ndarray):
        self.shift = np.uint64(64 - max(4, (4 * len(pairs)).bit_length()))
        self.pair = np.full(1 << 64 - int(self.shift), -1, np.int64)
        self.rank = np.full(len(self.pair), NONE, np.int64)
        left = np.arange(len(pairs))
        slot = self._slot(pairs)
        while len(left):
            free = self.pair[slot] < 0
            self.pair[slot[free]] = pairs[left[free]]
            here = self.pair[slot] == pairs[left]
            np.minimum.at(self.rank, slot[here], left[here])
            left, slot = left[~here], slot[~here] + 1 & len(self.pair) - 1

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, pairs: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where the table doesn't have it."""
        slot = self._slot(pairs)
        found = self.pair[slot]
        out = np.where(found == pairs, self.rank[slot], NONE)
        left = np.flatnonzero((found != pairs) & (found >= 0))
        while len(left):
            slot = slot + 1 & len(self.pair) - 1
            found = self.pair[slot[left]]
            here = found == pairs[left]
            out[left[here]] = self.rank[slot[left[here]]]
            left = left[~here & (found >= 0)]
        return out


class Vocabulary:
    """Merges and ids of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if (model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or spec["normalizer"]
                or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre.get("use_regex", True)):
            raise ValueError(f"{path} is no plain byte-level BPE without normaliser and prefix space")
        plain = any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"])
        if plain:
            raise ValueError(f"{path} has added tokens that match more than their own text")
        self.path = path
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        # The file writes bytes as characters: printable ones as themselves, the others from U+0100 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ids = model["vocab"]
        self.size = max([*ids.values(), *self.added.values()]) + 1
        self.bytes_of = [b""] * self.size
        for token, i in ids.items():
            self.bytes_of[i] = bytes(map(self.byte_of.__getitem__, token))
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        char_of = {b: c for c, b in self.byte_of.items()}
        self.first = np.array([ids[char_of[b]] for b in range(256)], np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.pairs = PairTable(np.array([ids[a] * (self.size + 1) + ids[b] for a, b in merges], np.int64))
        self.into = np.array([ids[a + b] for a, b in merges], np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` for what is no merge; the id ``size`` stands for no symbol."""
        return self.pairs.find(left * (self.size + 1) + right)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word: again and again the first pair of lowest rank becomes one symbol."""
        return [np.frombuffer(x, "<u4").astype(np.int64) for x in self.merged(words)]

    def merged(self, words: list[bytes]) -> list[bytes]:
        """The ids of ``merge`` as little-endian unsigned 32-bit integers."""
        out: list = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))  # words of like length share a batch
        at = 0
        while at < len(order) and len(words[order[at]]) <= _SHORT:
            some = [i for i in order[at:at + 4096] if len(words[i]) <= _SHORT]
            for i, ids in zip(some, self._merge_batch([words[i] for i in some])):
                out[i] = ids
            at += len(some)
        for i in order[at:]:
            out[i] = self._merge_long(words[i]).astype("<u4").tobytes()
        return out

    def _merge_batch(self, words: list[bytes]) -> list[bytes]:
        """A column for each word, a row for each place; symbols keep their place and know their neighbours."""
        n, size = len(words), np.fromiter(map(len, words), np.int64, len(words))
        width = int(size.max())
        if not width:
            return [b""] * n
        raw = np.frombuffer(b"".join(words), np.uint8)
        place = np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size)
        symbol = np.full((width + 1, n), self.size, np.int64)  # the last row: no symbol, before the first and after the last
        symbol[place, np.repeat(np.arange(n), size)] = self.first[raw]
        rows = np.arange(width)[:, None]
        best = self._rank(symbol[:-1].ravel(), symbol[1:].ravel()).reshape(width, n) << _PLACE_BITS | rows  # rank, then place
        after = np.repeat(np.minimum(np.arange(1, width + 2), width)[:, None], n, 1)
        before = np.repeat(np.concatenate((([width], np.arange(width))))[:, None], n, 1)
        live = np.arange(n)
        while True:
            low = best[:, live].min(axis=0)
            go = low < NONE << _PLACE_BITS
            live, low = live[go], low[go]
            if not len(live):
                break
            p = low & (1 << _PLACE_BITS) - 1
            q = after[p, live]
            new = self.into[low >> _PLACE_BITS]
            following, last = after[q, live], before[p, live]
            symbol[p, live], symbol[q, live] = new, self.size
            after[p, live] = following
            before[following, live] = p
            best[q, live] = NONE << _PLACE_BITS
            best[p, live] = self._rank(new, symbol[following, live]) << _PLACE_BITS | p
            some = last < width
            o, l = last[some], live[some]
            best[o, l] = self._rank(symbol[o, l], new[some]) << _PLACE_BITS | o
        symbol = symbol[:-1].T
        left = symbol < self.size
        ids = symbol[left].astype("<u4").tobytes()
        ends = (4 * np.cumsum(left.sum(axis=1))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def _merge_long(self, word: bytes) -> np.ndarray:
        """All pairs of the lowest rank at a time, from the left; a merge never makes a pair of lower rank than its own."""
        s = self.first[np.frombuffer(word, np.uint8)]
        while len(s) > 1:
            rank = self._rank(s[:-1], s[1:])
            low = rank.min()
            if low == NONE:
                break
            hits, last = [], -2
            for p in np.flatnonzero(rank == low).tolist():
                if p > last + 1:
                    hits.append(p)
                    last = p
            hits = np.array(hits)
            s[hits] = self.into[low]
            s = np.delete(s, hits + 1)
        return s


def compile_lexicon(words: list[bytes], ids: list[np.ndarray]) -> bytes:
    """The automaton of distinct words as one blob: a header of array sizes, then the arrays.

    Built from the sorted words by keeping one unfinished path: what a new word leaves behind is replaced by an equal
    finished state where there is one, so equal suffixes are stored once.
    """
    order = sorted(range(len(words)), key=words.__getitem__)
    register: dict[tuple, int] = {}
    states: list[tuple] = []
    path: list[list] = [[False, []]]  # [final, [(byte, state)]] along the current word

    def finish(depth: int) -> None:
        while len(path) > depth:
            final, edges = path.pop()
            key = (final, tuple(edges))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            path[-1][1].append((last[len(path) - 1], register[key]))

    last = b""
    for i in order:
        word = words[i]
        same = next((k for k, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
        finish(same + 1)
        path.extend([False, []] for _ in word[same:])
        path[-1][0] = True
        last = word
    finish(1)
    states.append((path[0][0], tuple(path[0][1])))

    below = []  # words reachable from each state; children have smaller numbers
    edges, targets, skips = [], [], []
    for number, (final, out) in enumerate(states):
        seen = int(final)
        for byte, to in out:
            edges.append(number * 256 + byte)
            targets.append(to)
            skips.append(seen)
            seen += below[to]
        below.append(seen)
    sizes = np.array([len(ids[i]) for i in order], np.int64)
    arrays = [np.array(edges, "<i8"), np.array(targets, "<i4"), np.array(skips, "<i4"),
              np.array([s[0] for s in states], "<u1"), np.concatenate(([0], np.cumsum(sizes))).astype("<i8"),
              (np.concatenate([ids[i] for i in order]) if order else np.empty(0)).astype("<u4")]
    parts = [x.tobytes() + b"\0" * (-x.nbytes % 8) for x in arrays]
    return np.array([len(x) for x in arrays], "<i8").tobytes() + b"".join(parts)


class Lexicon:
    """A compiled automaton, mapped from a nameless file of the worker."""

    KINDS = ("<i8", "<i4", "<i4", "<u1", "<i8", "<u4")

    def __init__(self, blob: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(blob)
            file.flush()
            self._map = mmap.mmap(file.fileno(), 0, prot=mmap.PROT_READ)
        sizes, at, arrays = np.frombuffer(self._map, "<i8", 6), 48, []
        for kind, size in zip(self.KINDS, sizes.tolist()):
            arrays.append(np.frombuffer(self._map, kind, size, at))
            at += -(-size * np.dtype(kind).itemsize // 8) * 8
        self.edges, self.targets, self.skips, self.final, self.starts, self.ids = arrays

    def __len__(self) -> int:
        return len(self.starts) - 1

    def find(self, words: list[bytes]) -> np.ndarray:
        """Rank of each word, -1 where the lexicon doesn't have it."""
        rank = np.zeros(len(words), np.int64)
        if not len(self.edges) or not words:
            return rank - 1
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        start = np.cumsum(size) - size
        state = np.full(len(words), len(self.final) - 1, np.int64)
        live, step = np.flatnonzero(size > 0), 0
        while len(live):
            key = state[live] * 256 + raw[start[live] + step]
            at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            hit = self.edges[at] == key
            rank[live] += self.skips[at]
            state[live] = np.where(hit, self.targets[at], -1)
            step += 1
            live = live[hit]
            live = live[size[live] > step]
        good = (state >= 0) & (self.final[np.maximum(state, 0)] > 0)
        return np.where(good, rank, -1)

    def ids_of(self, rank: int) -> np.ndarray:
        return self.ids[self.starts[rank]:self.starts[rank + 1]]


class Encoder:
    """Ids of whole texts as the tokenizers library gives them (no special tokens added, no truncation or padding)."""

    #: Units that a worker remembers.
    REMEMBERED = 500_000

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        from tokenizers import Tokenizer
        self.vocabulary, self.lexicon, self.library = vocabulary, lexicon, Tokenizer.from_file(vocabulary.path)
        self.added = sorted(vocabulary.added, key=len, reverse=True)
        self._added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        # Ids of what follows a space (which is part of it), and of what stands for itself.
        self.after: dict[str, bytes] = {}
        self.exact: dict[str, bytes] = {}

    def units(self, text: str) -> list[str] | None:
        """What single spaces part, line feeds in front; each but the first stands for itself and its space.

        Words never begin inside such a unit's predecessor, so units can be encoded one by one. None if the text has
        added tokens, characters beyond Latin, or white space that the pattern treats as runs.
        """
        if (any(x in text for x in ("  ", "\n\n", " \n", "\n ", "\t", "\r", "\x0b", "\x0c", *self.added))
                or _OTHER.search(text)):
            return None
        return text.replace("\n", " \n").split(" ")

    def words(self, text: str) -> list[str]:
        """A text's words by the splitting pattern."""
        if not _OTHER.search(text):
            return _SPLIT.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self, text: str) -> list:
        """A text's words, and the ids (int) of added tokens between them."""
        out: list = []
        for i, piece in enumerate(self._added.split(text) if self._added else [text]):
            out.extend([self.vocabulary.added[piece]] if i % 2 else self.words(piece))
        return out

    @staticmethod
    def spaced(unit: str) -> str:
        return unit if unit[:1] == "\n" else " " + unit

    def _learn(self, new: list[str], texts: list[str], known: dict[str, bytes]) -> None:
        """Ids of new units whose texts are given."""
        split_at = _SPLIT.findall if known is self.after else self.words  # what follows a space is Latin
        split = [[w.encode() for w in split_at(t)] for t in texts]
        distinct = list(dict.fromkeys(w for words in split for w in words))
        ranks = self.lexicon.find(distinct)
        ids = {w: self.lexicon.ids_of(r).tobytes() for w, r in zip(distinct, ranks.tolist()) if r >= 0}
        unseen = [w for w in distinct if w not in ids]
        ids.update(zip(unseen, self.vocabulary.merged(unseen)))
        for unit, words in zip(new, split):
            known[unit] = ids[words[0]] if len(words) == 1 else b"".join(map(ids.__getitem__, words))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.after) > self.REMEMBERED or len(self.exact) > self.REMEMBERED:
            self.after.clear(), self.exact.clear()
        rows = [self.units(t) for t in texts]
        other = [self.pieces(t) if row is None else row[:1] for t, row in zip(texts, rows)]
        after = set().union(*(row[1:] for row in rows if row is not None)).difference(self.after)
        exact = {u for row in other for u in row if u.__class__ is str}.difference(self.exact)
        after, exact = list(after), list(exact)
        self._learn(after, [self.spaced(u) for u in after], self.after)
        self._learn(exact, exact, self.exact)
        follow, alone = self.after.__getitem__, self.exact.__getitem__
        return [b"".join([alone(u) if u.__class__ is str else u.to_bytes(4, "little") for u in head])
                + (b"".join(map(follow, row[1:])) if row is not None else b"")
                for head, row in zip(other, rows)]


def decoded(ids: bytes, bytes_of: list[bytes]) -> str:
    """Text of little-endian unsigned 32-bit ids, special tokens included."""
    return b"".join(map(bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def text_slices(batch: pa.RecordBatch, column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose texts have about ``most_bytes`` or are single."""
    text, at, size = batch.column(batch.schema.get_field_index(column)), 0, 0
    lengths = [len(x.as_buffer()) if x.is_valid else 0 for x in text] if len(batch) else []
    for i, n in enumerate(lengths):
        if i > at and size + n > most_bytes:
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += n
    if len(batch) > at:
        yield batch.slice(at)


_LOADED: dict = {}
KEPT.append(_LOADED)


def encoder(path: str, lexicon: bytes, key: str) -> Encoder:
    """This worker's encoder; ``key`` tells lexicons apart."""
    if _LOADED.get("key") != (path, key):
        _LOADED.clear()
        _LOADED.update(key=(path, key), encoder=Encoder(Vocabulary(path), Lexicon(lexicon)))
    return _LOADED["encoder"]


def word_counts(docs: DataFrame, text_col: str, path: str) -> DataFrame:
    """``word, n`` of all words of all texts."""
    python_tasks(docs.sparkSession)
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])
    empty = compile_lexicon([], [])

    def task(batches):
        after, exact = Counter(), Counter()
        enc = encoder(path, empty, "none")

        def rows():
            words: Counter = Counter()
            for count, text in ((after, enc.spaced), (exact, str)):
                for u, n in count.items():
                    for w in enc.words(text(u)):
                        words[w] += n
                count.clear()
            return ({"word": w.encode(), "n": n} for w, n in words.items())

        for batch in batches:
            for text in batch.column(0).to_pylist():
                units = enc.units(text or "")
                if units is None:
                    exact.update(u for u in enc.pieces(text) if u.__class__ is str)
                else:
                    exact[units[0]] += 1
                    after.update(units[1:])
                if len(after) + len(exact) > 600_000:
                    yield from batches_of(rows(), schema, 50_000)
        yield from batches_of(rows(), schema, 50_000)

    return docs.select(text_col).mapInArrow(task, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_lexicon(docs: DataFrame, text_col: str, path: str, words: int = 65_536) -> bytes:
    """Lexicon of the corpus' most frequent words: all that occur at least c times, for the smallest c (2 or more)
    that leaves at most ``words`` of them (from 2^17 on, c has 10 significant bits). ``words`` bounds what the driver gets and the lexicon, about 5 MB."""
    counts = materialize(word_counts(docs, text_col, path).filter("n > 1"), "word-counts")
    # Counts from 2^17 on keep their 10 highest bits: 512 bars of the histogram for each doubling, without an upper one.
    low = F.greatest(F.length(F.bin("n")) - 10, F.lit(0))
    bar = F.when(F.col("n") < 1 << 17, F.col("n")).otherwise(F.call_function("shiftleft", F.call_function("shiftright", "n", low), low))
    bars = counts.groupBy(bar.alias("n")).agg(F.count(F.lit(1)).alias("words")).collect()
    least, total = max((r["n"] for r in bars), default=0) << 1, 0  # over all counts
    for n, more in sorted(((r["n"], r["words"]) for r in bars), reverse=True):
        if total + more > words:
            break
        least, total = n, total + more
    top = [bytes(r["word"]) for r in counts.filter(F.col("n") >= least).select("word").collect()]
    return compile_lexicon(top, Vocabulary(path).merge(top))


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", into: str = "ids",
                     lexicon: bytes | None = None) -> DataFrame:
    """``docs`` with the ids of ``text_col`` as little-endian unsigned 32-bit integers (binary) in ``into``.

    Ids are those of the tokenizers library for the file ``path``, which must be at this place on every node, with no
    special tokens added and no truncation or padding. Nulls and empty texts have no ids (an empty binary). Rows are
    independent: repeated rows give repeated ids. ``lexicon`` is compiled from ``docs`` where it is not given; any
    lexicon gives the same ids. All other columns are kept, an older column ``into`` is replaced.
    """
    if lexicon is None:
        lexicon = frequent_lexicon(docs, text_col, path)
    python_tasks(docs.sparkSession)
    names = [c for c in docs.columns if c != into]
    shared, key = docs.sparkSession.sparkContext.broadcast(lexicon), str(hash(lexicon))

    def task(batches):
        for batch in batches:
            for part in text_slices(batch, text_col):
                texts = [t or "" for t in part.column(part.schema.get_field_index(text_col)).to_pylist()]
                ids = encoder(path, shared.value, key).encode(texts)
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(names))], pa.array(ids, pa.binary())],
                                                 [*part.schema.names, into])

    return docs.select(*names).mapInArrow(task, docs.select(*names).schema.add(into, "binary"))


def decode_documents(encoded: DataFrame, path: str, ids_col: str = "ids", into: str = "text") -> DataFrame:
    """``encoded`` with the texts of its ids in ``into``; null ids give null, no ids the empty text."""
    python_tasks(encoded.sparkSession)
    names = [c for c in encoded.columns if c != into]

    def task(batches):
        bytes_of = Vocabulary(path).bytes_of
        for batch in batches:
            for part in text_slices(batch, ids_col):
                texts = [None if x is None else decoded(x, bytes_of)
                         for x in part.column(part.schema.get_field_index(ids_col)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(names))], pa.array(texts, pa.string())],
                                                 [*part.schema.names, into])

    return encoded.select(*names).mapInArrow(task, encoded.select(*names).schema.add(into, "string"))
