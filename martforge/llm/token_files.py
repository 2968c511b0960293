"""Token files: canonical, length-limited Huffman codes in independent blocks with bit-offset checkpoints.

A file set is one folder: ``codebook`` (id, length) and ``blocks``, both Parquet. A block holds whole documents in
ascending order: their ids and token counts, the bit stream of all their tokens (codes from the highest bit on), and
the bit offset of every 256th token. Any block can be read alone with the codebook, and inside it decoding can begin
at any checkpoint; the reader decodes all checkpoints of a block side by side by table look-up.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martforge.llm import python_tasks
from martforge.llm.bpe import Encoder, Lexicon, Vocabulary, compile_lexicon, text_slices
from martforge.session import materialize, scratch_path

CHECKPOINT = 256
BLOCK_IDS = 1 << 18


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for positive counts (package-merge)."""
    n = len(counts)
    if n == 1:
        return np.ones(1, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols don't fit in codes of {limit} bits")
    order = np.argsort(counts, kind="stable")
    leaf = counts[order].astype(np.float64)
    levels, packages = [], np.empty(0)
    for _ in range(limit):
        weight = np.concatenate([leaf, packages])
        place = np.argsort(weight, kind="stable")  # leaves come before packages of the same weight
        levels.append(place < n)
        weight = weight[place]
        packages = weight[0:len(weight) // 2 * 2:2] + weight[1:len(weight) // 2 * 2:2]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        leaves = int(is_leaf[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Codebook:
    """Canonical codes: shorter ones first, then by id."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.symbols, self.lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        self.limit = int(self.lengths.max()) if len(ids) else 1
        span = np.int64(1) << (self.limit - self.lengths)  # of the decoding table
        first = np.cumsum(span) - span
        if len(ids) and first[-1] + span[-1] > 1 << self.limit:
            raise ValueError("the lengths are those of no prefix code")
        size = int(self.symbols.max()) + 1 if len(ids) else 1
        self.code, self.length_of = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code[self.symbols] = (first >> (self.limit - self.lengths)).astype(np.uint64)
        self.length_of[self.symbols] = self.lengths
        self.table = np.zeros(1 << self.limit, np.int64)  # code prefix -> place among the symbols
        self.table[:span.sum()] = np.repeat(np.arange(len(ids)), span)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bit stream, and the bit offset of every CHECKPOINT-th id."""
        length = self.length_of[ids]
        end = np.cumsum(length)
        at = end - length
        words = np.zeros((int(end[-1]) >> 5) + 3 if len(ids) else 3, np.uint64)
        value = self.code[ids] << (np.uint64(64) - (at & 31).astype(np.uint64) - length.astype(np.uint64))
        np.add.at(words, at >> 5, value >> np.uint64(32))
        np.add.at(words, (at >> 5) + 1, value & np.uint64(0xFFFFFFFF))
        return words.astype(">u4").tobytes(), at[::CHECKPOINT]

    def decode(self, stream: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """The n ids of a stream, all checkpoints side by side."""
        words = np.frombuffer(stream, ">u4").astype(np.uint64)
        lanes = len(checkpoints)
        out = np.zeros((CHECKPOINT, lanes), np.int64)
        at = np.array(checkpoints, np.int64)
        last = n - (lanes - 1) * CHECKPOINT
        down = np.uint64(64 - self.limit)
        for step in range(min(n, CHECKPOINT)):
            if step == last:  # the last lane is done
                at = at[:-1]
            word = at >> 5
            window = ((words[word] << np.uint64(32)) | words[word + 1]) << (at & 31).astype(np.uint64)
            place = self.table[(window >> down).astype(np.int64)]
            out[step, :len(at)] = self.symbols[place]
            at = at + self.lengths[place]
        return out.T.ravel()[:n]


_LOADED: dict = {}


class LibraryEncoder(Encoder):
    """The tokenizers library on what it has not encoded before (texts fall into units that never merge).

    It gets ``AT_ONCE`` units at a time, as its results take far more memory than their ids. Units that follow a space
    stand side by side in one text, as they do in documents: words never reach over the space, so the ids of such a text
    are those of its units, and the bytes of the ids tell where one ends.
    """

    AT_ONCE = 4096
    REMEMBERED = 200_000  # units; some 200 bytes each in every worker

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        super().__init__(Vocabulary(path), Lexicon(compile_lexicon([], [])))
        self.library.no_truncation(), self.library.no_padding()
        self.bytes_in = np.array([len(x) for x in self.vocabulary.bytes_of], np.int64)
        self.apart = any(c.isspace() for x in self.added for c in x)  # then added tokens could reach over units

    def _learn(self, new, texts, known):
        for at in range(0, len(new), self.AT_ONCE):
            units, some = new[at:at + self.AT_ONCE], texts[at:at + self.AT_ONCE]
            if known is self.after and not self.apart:
                # white space at a unit's end would make a run with what follows
                lone = [x[-1].isspace() for x in some]
                self._learn_joined([u for u, x in zip(units, lone) if not x], [t for t, x in zip(some, lone) if not x], known)
                units, some = [u for u, x in zip(units, lone) if x], [t for t, x in zip(some, lone) if x]
            for unit, found in zip(units, self.library.encode_batch_fast(some, add_special_tokens=False)):
                known[unit] = np.array(found.ids, "<u4").tobytes()

    def _learn_joined(self, units, texts, known):
        for at in range(0, len(units), 256):
            some = [t.encode() for t in texts[at:at + 256]]
            ids = np.array(self.library.encode_batch_fast([b"".join(some).decode()], add_special_tokens=False)[0].ids, np.int64)
            reached, wanted = np.cumsum(self.bytes_in[ids]), np.cumsum([len(t) for t in some])
            ends = np.searchsorted(reached, wanted)
            if len(reached) != ends[-1] + 1 or (reached[ends] != wanted).any():
                raise ValueError("a token reaches over a space")
            raw, ends = ids.astype("<u4").tobytes(), (4 * ends + 4).tolist()
            for unit, a, b in zip(units[at:at + 256], [0, *ends], ends):
                known[unit] = raw[a:b]


def _tokenising(path: str, end_id: int):
    def task(batches):
        if _LOADED.get("path") != path:
            _LOADED.update(path=path, encoder=LibraryEncoder(path))
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = [x + end for x in _LOADED["encoder"].encode(texts)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return task


def _counting(batches):
    total = np.zeros(0, np.int64)
    for batch in batches:
        for ids in batch.column(0):
            count = np.bincount(np.frombuffer(ids.as_buffer(), "<u4"))
            if len(count) > len(total):
                count, total = total, count.astype(np.int64)
            total[:len(count)] += count
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"id": ids, "n": total[ids]})


def _coding(shared):
    schema = pa.schema([("place", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
                        ("n_ids", pa.int64()), ("bits", pa.binary()), ("checkpoints", pa.list_(pa.int64()))])

    def task(batches):
        book = Codebook(*shared.value)
        held: list = []

        def block():
            ids = np.concatenate([x for _, _, x in held])
            bits, checkpoints = book.encode(ids)
            row = {"place": held[0][0], "doc_ids": [d for _, d, _ in held], "counts": [len(x) for _, _, x in held],
                   "n_ids": len(ids), "bits": bits, "checkpoints": checkpoints}
            held.clear()
            return pa.RecordBatch.from_pylist([row], schema)

        size = 0
        for batch in batches:
            for place, doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if held and (size >= BLOCK_IDS or place != held[-1][0] + 1):  # a gap: another file begins
                    yield block()
                    size = 0
                held.append((place, doc_id, np.frombuffer(ids.as_buffer(), "<u4").astype(np.int64)))
                size += len(held[-1][2])
        if held:
            yield block()

    return task


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, limit: int = 16,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes the texts, ends each with ``end_id`` and writes them to the folder ``path`` in ascending id order.

    Ids are those of the tokenizers library for the file ``vocabulary`` without special tokens. Code lengths are
    optimal for the counts of all ids in all texts, at most ``limit`` bits (or what that many different ids need).

    Nulls: a null text is empty (its end id alone), null ids come first. Rows that repeat an id follow one another by
    their texts. An empty table writes an empty codebook and no blocks. Other columns are not read.
    """
    spark = python_tasks(docs.sparkSession)
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
               .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text")))
    # the place is read off once and written: partition and row of the global order
    coded = materialize(ordered.mapInArrow(_tokenising(vocabulary, end_id), "doc_id long, ids binary")
                        .select(F.monotonically_increasing_id().alias("place"), "doc_id", "ids"), "token-ids")
    counts = coded.select("ids").mapInArrow(_counting, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = sorted((r["id"], r["n"]) for r in counts.collect())  # a row for each id of the vocabulary at most
    ids, n = (np.array(x, np.int64) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 2
    lengths = code_lengths(n, max(limit, int(max(len(n) - 1, 1)).bit_length())) if found else n
    spark.createDataFrame(list(zip(ids.tolist(), lengths.tolist())), "id long, length long").coalesce(1).write.parquet(
        f"{path}/codebook")
    shared = spark.sparkContext.broadcast((ids, lengths))
    coded.mapInArrow(_coding(shared), "place long, doc_ids array<long>, counts array<long>, n_ids long, bits binary, "
                                      "checkpoints array<long>").write.parquet(f"{path}/blocks")


def _decoding(shared):
    def task(batches):
        book = Codebook(*shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                ids = book.decode(row["bits"], np.array(row["checkpoints"]), row["n_ids"])
                ends = np.cumsum(row["counts"])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start": pa.array(row["start"] + ends - row["counts"], pa.int64()),
                    "ids": pa.array([x.astype("<u4").tobytes() for x in np.split(ids, ends[:-1])], pa.binary())})

    return task


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of every document: its first token's number, and its ids (little-endian unsigned 32-bit)."""
    python_tasks(spark)
    book = sorted((r["id"], r["length"]) for r in spark.read.parquet(f"{path}/codebook").collect())
    shared = spark.sparkContext.broadcast(tuple(np.array([x[i] for x in book], np.int64) for i in (0, 1)))
    blocks = spark.read.parquet(f"{path}/blocks").withColumn("part", F.shiftrightunsigned("place", 33))
    # token numbers: sums of the parts before (one row a partition), then of the blocks before in the part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    starts = (blocks.select("part", "place", "n_ids").join(parts, "part")
              .select("place", (F.col("base") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("start")))
    return blocks.join(starts, "place").mapInArrow(_decoding(shared), "doc_id long, start long, ids binary")


def token_digests(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from files written to the shared scratch folder."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, vocabulary, end_id)
    return read_token_files(docs.sparkSession, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
