"""Self join of documents on the Jaccard similarity of their word n-grams, filtered under several global orders.

Any fixed order of all shingles gives a prefix filter: two sets of similarity ``t`` or more share a shingle among
the first ``n - ceil(t * n) + 1`` of each. Three orders are used. All put rarer shingles first (by a count sketch of
fixed size over the whole corpus) and break ties by three independent hashes.

1. One pass counts shingles in the sketch and gives each document its set key; documents with equal sets are one
   class from here on, so copies cost nothing more.
2. A second pass writes each class's prefix under the first order, and 16-bit fingerprints of its prefixes under the
   other two.
3. Classes that share a prefix shingle are candidates. They are taken in rounds: in each shingle's group the first
   members are compared with all others (1 member in the first round, then 2, 4, ...), and members that have come to
   one component need no further comparison. So a group of thousands of near copies costs a star, not all its pairs,
   while no pair of different components is left out.
4. A candidate must share a prefix shingle under the second and third order too; what is left is verified on whole
   texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm import materialize, python_tasks
from martforge.llm.graph import connected_components
from martforge.llm.rounds import linked_in_rounds, near
from martforge.llm.shingles import batches_of, mixed, shingle_sets, slices

#: Counters of the sketch; 8 MB.
SKETCH_BITS = 21
BLOCK_BITS = 16
ORDER_SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)


def required(n: int, num: int, den: int) -> int:
    """Shingles that a set of n must share with any set similar enough."""
    return -(-num * n // den)


def _longs(x: list[int]) -> pa.Array:
    return pa.array(np.array(x, np.uint64).view(np.int64), pa.int64())


def _counting(k: int, seed: int):
    """Task of the first pass: a row for each document, and the task's counts in blocks."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("other", pa.int64()),
                        ("block", pa.int32()), ("counts", pa.binary())])

    def task(batches):
        counts, held, size = np.zeros(1 << SKETCH_BITS, np.int64), [], 0
        for batch in batches:
            doc_id, text, text_key = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text", "text_key"))
            for lo, hi in slices(text):
                sets = shingle_sets(text.slice(lo, hi - lo), k)
                held += sets
                size += sum(map(len, sets))
                if size >= 1 << (SKETCH_BITS - 1):
                    counts, held, size = _counted(counts, held), [], 0
                yield pa.RecordBatch.from_arrays([
                    doc_id.slice(lo, hi - lo), text_key.slice(lo, hi - lo), pa.array(list(map(len, sets)), pa.int64()),
                    _longs([xxhash.xxh64_intdigest(s, seed) for s in sets]),
                    _longs([xxhash.xxh64_intdigest(s, seed + 1000) for s in sets]),
                    pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())], schema=schema)
        counts = np.minimum(_counted(counts, held), (1 << 32) - 1)
        yield from batches_of(({"block": i, "counts": zlib.compress(part.astype("<u4").tobytes(), 1)}
                               for i, part in enumerate(counts.reshape(-1, 1 << BLOCK_BITS)) if part.any()), schema)

    return task


def _counted(counts: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    if not sets:
        return counts
    places = (np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
    return counts + np.bincount(places, minlength=len(counts))


def _summing(batches):
    """Sums the blocks that meet in a partition, as they come."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, part in zip(batch.column(0).to_pylist(), batch.column(1)):
            x = np.frombuffer(zlib.decompress(part.as_py()), "<u4").astype(np.int64)
            total[block] = total[block] + x if block in total else x
    schema = pa.schema([("block", pa.int32()), ("counts", pa.binary())])
    yield from batches_of(({"block": b, "counts": x.tobytes()} for b, x in total.items()), schema, 4)


def sketch_of(parts) -> np.ndarray:
    counts = np.zeros(1 << SKETCH_BITS, np.uint32)
    for block, part in parts:
        sums = np.minimum(np.frombuffer(bytes(part), np.int64), (1 << 32) - 1)
        counts[block << BLOCK_BITS:(block + 1) << BLOCK_BITS] = sums.astype(np.uint32)
    return counts


def prefixes(sets: list[np.ndarray], sketch: np.ndarray, num: int, den: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The shingles of each set (none empty) that come first under each order; of ties at its end, all.

    The first order follows the counts themselves, so that what a text has for itself comes first; the others follow
    half powers of two of the counts, so that their hashes can tell.
    """
    every = np.concatenate(sets)
    count = sketch[(every >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    half = (2 * np.log2(count + 1.0)).astype(np.uint64) << np.uint64(32)
    keys = [rank | (mixed(every ^ np.uint64(seed)) >> np.uint64(32))
            for rank, seed in zip((count.astype(np.uint64) << np.uint64(32), half, half), ORDER_SEEDS)]
    out, at = [], 0
    for s in sets:
        last = len(s) - required(len(s), num, den)
        own = [key[at:at + len(s)] for key in keys]
        out.append(tuple(s[key <= np.partition(key, last)[last]] for key in own))
        at += len(s)
    return out


def fingerprints(s: np.ndarray) -> bytes:
    return np.unique((mixed(s) >> np.uint64(48)).astype("<u2")).tobytes()


def _prefixes(k: int, seed: int, num: int, den: int, shared):
    schema = pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("tokens", pa.list_(pa.int64())),
                        ("second", pa.binary()), ("third", pa.binary())])

    def task(batches):
        sketch, done = shared.value, set()
        for batch in batches:
            text = batch.column(0)
            for lo, hi in slices(text):
                new = {}
                for s in shingle_sets(text.slice(lo, hi - lo), k):
                    cls = xxhash.xxh64_intdigest(s, seed)
                    if len(s) and cls not in done:  # one of equal sets is enough; others meet it again by class
                        new[cls] = s
                if not new:
                    continue
                if len(done) < 200_000:
                    done.update(new)
                sets = list(new.values())
                first, second, third = zip(*prefixes(sets, sketch, num, den))
                ends = np.cumsum([0, *map(len, first)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    _longs(list(new)), pa.array(list(map(len, sets)), pa.int64()),
                    pa.ListArray.from_arrays(ends, np.concatenate(first).view(np.int64)),
                    pa.array(map(fingerprints, second), pa.binary()), pa.array(map(fingerprints, third), pa.binary())],
                    schema=schema)

    return task


def _shares(a: bytes, b: bytes) -> bool:
    return not set(memoryview(a).cast("H")).isdisjoint(memoryview(b).cast("H"))


def _filtering(batches):
    """Pairs that share a fingerprint under the second and third order."""
    for batch in batches:
        x = batch.to_pydict()
        keep = [_shares(s, t) and _shares(u, v)
                for s, t, u, v in zip(x["seconda"], x["secondb"], x["thirda"], x["thirdb"])]
        yield pa.RecordBatch.from_pydict({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(keep, pa.bool_()))


def _verifying(k: int, num: int, den: int):
    def sets_of(keys: pa.Array, texts: pa.Array) -> Iterator[np.ndarray]:
        """The set of each row; those of equal keys are made once."""
        keys, first, at = np.unique(keys.to_numpy(), return_index=True, return_inverse=True)
        texts = texts.take(pa.array(first))
        found = [s for lo, hi in slices(texts) for s in shingle_sets(texts.slice(lo, hi - lo), k)]
        return (found[i] for i in at.tolist())

    def task(batches):
        for batch in batches:
            a, b, s, t = (batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "texta", "textb"))
            keep = []
            for lo, hi in slices(t):
                part = lambda x: x.slice(lo, hi - lo)
                for x, y in zip(sets_of(part(a), part(s)), sets_of(part(b), part(t))):
                    both = np.sort(np.concatenate((x, y)))
                    shared = np.count_nonzero(both[1:] == both[:-1])
                    keep.append(den * shared >= num * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_pydict({"a": a, "b": b}).filter(pa.array(keep, pa.bool_()))

    return task


def jaccard_links(docs: DataFrame, k: int, num: int, den: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``rows`` (doc_id, n, cls), ``classes`` (cls, first_id) and ``links`` (a, b) that connect similar classes.

    The links are a part of all similar pairs that reaches the same components: pairs inside a component that is
    already known are not compared. ``docs`` has doc_id, text.
    """
    spark = python_tasks(docs.sparkSession)
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    for seed in count(1):
        counted = materialize(docs.mapInArrow(
            _counting(k, seed), "doc_id long, text_key long, n long, cls long, other long, block int, counts binary"),
            "ngram-sets")
        rows = counted.filter("n is not null").select("doc_id", "text_key", "n", "cls", "other")
        classes = rows.groupBy("cls").agg(F.min("doc_id").alias("first_id"), F.min("text_key").alias("text_key"),
                                          F.min("other").alias("x"), F.max("other").alias("y"))
        classes = materialize(classes, "ngram-classes")
        if classes.filter("x <> y").isEmpty():  # else two sets have the same key: draw new ones
            break
    sums = (counted.filter("block is not null").select("block", "counts").repartition("block")
            .mapInArrow(_summing, "block int, counts binary").collect())  # 32 blocks, 16 MB
    sketch = spark.sparkContext.broadcast(sketch_of([(r["block"], r["counts"]) for r in sums]))

    prefixes = materialize(docs.select("text").mapInArrow(
        _prefixes(k, seed, num, den, sketch), "cls long, n long, tokens array<long>, second binary, third binary"),
        "ngram-prefixes")
    members = prefixes.select(F.explode("tokens").alias("token"), F.col("cls").alias("node"), "n")
    members = members.repartition("token").groupBy("token", "node").agg(F.min("n").alias("n"))
    fits = lambda hub, member: F.col(f"{hub}.n") * den >= F.col(f"{member}.n") * num
    similar = lambda pairs: _similar(docs, classes, prefixes, pairs, k, num, den)
    return rows, classes, linked_in_rounds(members, fits, similar, "ngram")


def _similar(docs, classes, prefixes, pairs, k, num, den) -> DataFrame:
    """The pairs that pass the other two orders and then the comparison of whole texts."""
    size = pairs.count()
    if not size:
        return pairs
    ends = lambda frame: frame.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    side = lambda frame, key, names: frame.select(F.col("cls").alias(key), *[F.col(c).alias(c + key) for c in names])
    signs = (prefixes.select("cls", "second", "third").join(near(ends(pairs), 2 * size), "cls", "left_semi")
             .groupBy("cls").agg(F.first("second").alias("second"), F.first("third").alias("third")))
    passed = (pairs.join(side(signs, "b", ["second", "third"]), "b").join(side(signs, "a", ["second", "third"]), "a")
              .mapInArrow(_filtering, "a long, b long"))
    passed = materialize(passed, "ngram-passed")
    wanted = ends(passed).join(classes.select("cls", "text_key"), "cls")
    texts = docs.join(near(wanted, 2 * size), "text_key").groupBy("cls").agg(F.first("text").alias("text"))
    texts = materialize(texts, "ngram-texts")
    return (passed.join(side(texts, "b", ["text"]), "b").join(side(texts, "a", ["text"]), "a")
            .select("a", "b", "texta", "textb").mapInArrow(_verifying(k, num, den), "a long, b long"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, num: int = 90,
                       den: int = 100) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, text_key, component``.

    Documents are linked when ``den * |A & B| >= num * |A | B|`` for their sets of distinct k-word shingles.
    ``component_id`` is the smallest id that links reach, its own included; ``component`` names the component also
    where ids repeat or are null (null: no shingles), ``text_key`` is a hash of the text that tells apart rows of an id.

    Nulls and empty texts have no shingles and are linked with nothing. Null ids are kept; a component's id is null
    only if all its ids are. Repeated rows are equal sets and so linked. An empty table gives no rows. Other columns
    are not read. Shingles are compared as 64-bit hashes; keys of equal sets are checked and drawn anew if two differ.
    """
    if not 0 < num <= den or k < 1:
        raise ValueError("0 < num <= den and k >= 1 are asked for")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows, classes, links = jaccard_links(docs, k, num, den)
    comp = connected_components(links).select(F.col("node").alias("cls"), "component")
    of = classes.select("cls", "first_id").join(comp, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    smallest = of.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of = of.join(smallest, "component").select("cls", "component_id", "component")
    some = F.col("n") > 0
    return rows.join(of, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(some, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "text_key", F.when(some, F.col("component")).alias("component"))
