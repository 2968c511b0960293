"""Word shingles as sorted arrays of 64-bit hashes, made batch by batch inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Word hashes that a task remembers; beyond it the memory starts anew.
CACHE = 200_000


class WordHashes(dict):
    """xxh64 of each word (bytes), remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes of text whose words are hashed at once (some hundred bytes a word while they are).
SLICE = 1 << 18
#: Words of up to so many bytes are hashed side by side, 8 bytes a step; longer ones one at a time.
SIDE_BY_SIDE = 64
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _bounds(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a column of texts, and where each text begins in them and the last one ends (nulls are empty)."""
    texts = texts.fill_null("") if texts.null_count else texts
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8), np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``SLICE`` bytes of text (one text at least)."""
    _, ends = _bounds(texts)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE, "right")) - 1)
        yield at, end
        at = end


def _words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word of consecutive texts, and where each text begins among the words and the last one ends."""
    raw = data.tobytes().lower() + bytes(8)  # ASCII letters only
    inside = ~_SPACE[data]
    edge = np.ones(len(data) + 1, bool)  # before a byte: no word goes on
    edge[1:-1] = ~(inside[1:] & inside[:-1])
    edge[ends - ends[0]] = True
    start = np.flatnonzero(inside & edge[:-1])
    size = np.flatnonzero(inside & edge[1:]) + 1 - start
    eights = np.ndarray(len(data) + 1, "<u8", raw, strides=(1,))
    out = mixed((eights[start] & _FIRST[np.minimum(size, 8)]) ^ (size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    for at in range(8, SIDE_BY_SIDE, 8):
        more = np.flatnonzero(size > at)
        if not len(more):
            break
        x = eights[start[more] + at] & _FIRST[np.minimum(size[more] - at, 8)]
        out[more] = mixed(out[more] * np.uint64(0x9E3779B97F4A7C15) + x)
    for i in np.flatnonzero(size > SIDE_BY_SIDE):
        out[i] = xxhash.xxh64_intdigest(raw[start[i]:start[i] + size[i]])
    return out, np.searchsorted(start, ends - ends[0])


def _rolled(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words."""
    n = len(words) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[i:i + n])
    return out


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Ascending distinct hashes of each text's k-word shingles; for columns of about ``SLICE`` bytes (see ``slices``).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. Fewer than k words make one shingle, none make none.
    """
    data, ends = _bounds(texts)
    words, at = _words(data[ends[0]:ends[-1]], ends)
    every = _rolled(words, k) if len(words) >= k else None
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a < k:
            out.append(_rolled(words[a:b], b - a) if b > a else np.empty(0, np.uint64))
            continue
        s = np.sort(every[a:b - k + 1])
        new = s[1:] != s[:-1]
        out.append(s if new.all() else s[np.concatenate(([True], new))])
    return out


def as_long(x: int) -> int:
    """An unsigned 64-bit value as Spark's signed long."""
    return x - (1 << 64) if x >= 1 << 63 else x


def batches_of(rows: Iterator[dict], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of at most ``size`` rows."""
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)
