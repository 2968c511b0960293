"""BPE, token files, shards, chat and quality."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martforge.llm import chat
from martforge.llm.bpe import (Encoder, Lexicon, Vocabulary, compile_lexicon, decode_documents, decoded,
                               encode_documents)
from martforge.llm.quality import NAMES, fit_on_corpus, held_out, statistics
from martforge.llm.shard import fisher_yates, shuffle_into_shards
from martforge.llm.token_files import Codebook, code_lengths, read_token_files, write_token_files

SF001 = "/root/testdata/sf0.001"

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
ODD = ["", " ", "  a", "a   b\n\n\n c", "a\tb", "x\r\ny", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "日本語 テスト",
       "emoji 😀😀 ok", "don't I'll we've 'S", "\x1c a\x85b\xa0c", "a" * 3000, " " * 50 + "x", "é ǅ ɐ 1234 ½ ²", "tail \n",
       "\nhead", " \n mix", "İstanbul ſ K", "a​b", "﻿bom", "the and of " * 3000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def random_texts(n=1500):
    rnd = random.Random(1)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(30)))
            for alphabet in ("ab \n\t'sdrelvm.!é½日😀\x1c\xa0\r", "ab \n's.") for _ in range(n)]


@pytest.mark.parametrize("words", [[], ["the", " the", " and", " a", "and", "hand", " hand", ".", "\n", " don"]])
def test_encoder_equals_library(library, words):
    vocabulary = Vocabulary(PATH)
    raw = [w.encode() for w in words]
    encoder = Encoder(vocabulary, Lexicon(compile_lexicon(raw, vocabulary.merge(raw))))
    texts = ODD + random_texts()
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert got == want
    for ids, text in zip(got, texts):
        assert decoded(np.array(ids, "<u4").tobytes(), vocabulary.bytes_of) == library.decode(ids, skip_special_tokens=False)


def test_lexicon_is_minimal_and_exact():
    rnd = random.Random(2)
    words = sorted({bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(1, 8))) for _ in range(600)})
    lexicon = Lexicon(compile_lexicon(words, [np.arange(i % 5 + 1) + i for i in range(len(words))]))
    ranks = lexicon.find(words)
    assert ranks.tolist() == list(range(len(words)))
    assert all(lexicon.ids_of(i).tolist() == list(range(i, i + i % 5 + 1)) for i in range(len(words)))
    known = set(words)
    others = [bytes(x) for x in itertools.product(b"abcd", repeat=4) if bytes(x) not in known]
    assert (lexicon.find([*others, b""]) == -1).all()
    suffixes = {}  # states of a minimal automaton: distinct sets of continuations
    for w in words:
        for i in range(len(w) + 1):
            suffixes.setdefault(w[:i], set()).add(w[i:])
    assert len(lexicon.final) == len({frozenset(x) for x in suffixes.values()})


def test_documents_round_trip(spark, library):
    texts = [*ODD, None, ODD[3]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash")).repartition(3)
    encoded = encode_documents(docs, PATH)
    got = {r.doc_id: r for r in decode_documents(encoded.withColumnRenamed("text", "was"), PATH).collect()}
    for i, t in enumerate(texts):
        assert np.frombuffer(got[i].ids, "<u4").tolist() == library.encode(t or "", add_special_tokens=False).ids
        assert got[i].text == (t or "")
    assert encode_documents(docs.limit(0), PATH).count() == 0


def test_code_lengths_are_optimal():
    rnd = random.Random(3)
    for _ in range(40):
        counts = [rnd.choice((1, 1, 2, 5, 40, 1000)) for _ in range(rnd.randrange(2, 7))]
        for limit in (3, 4, 6):
            got = code_lengths(np.array(counts), limit)
            assert sum(2.0 ** -x for x in got) <= 1 and max(got) <= limit
            best = min(sum(c * x for c, x in zip(counts, lengths))
                       for lengths in itertools.product(range(1, limit + 1), repeat=len(counts))
                       if sum(2.0 ** -x for x in lengths) <= 1) if len(counts) < 6 and limit < 6 else None
            assert best is None or sum(c * x for c, x in zip(counts, got)) == best
    assert code_lengths(np.array([7]), 16).tolist() == [1]


@pytest.mark.parametrize("n", [1, 255, 256, 257, 5000])
def test_codebook_round_trip(n):
    rnd = np.random.default_rng(n)
    ids = np.minimum(rnd.geometric(0.02, n) * 37, 60_000)
    found, counts = np.unique(ids, return_counts=True)
    book = Codebook(found, code_lengths(counts, 16))
    stream, checkpoints = book.encode(ids)
    assert book.decode(stream, checkpoints, n).tolist() == ids.tolist()
    middle = len(checkpoints) // 2  # decoding can begin at any checkpoint
    assert book.decode(stream, checkpoints[middle:], n - 256 * middle).tolist() == ids[256 * middle:].tolist()


def test_token_files(spark, library, tmp_root):
    texts = [*ODD, None, ODD[3]]
    docs = spark.createDataFrame([(7 * i % 31, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    write_token_files(docs, f"{tmp_root}/files", PATH)
    got = sorted(read_token_files(spark, f"{tmp_root}/files").collect(), key=lambda r: r.start)
    of, start = {7 * i % 31: t for i, t in enumerate(texts)}, 0
    assert [r.doc_id for r in got] == sorted(of)
    for r in got:
        ids = library.encode(of[r.doc_id] or "", add_special_tokens=False).ids + [2]
        assert (r.start, np.frombuffer(r.ids, "<u4").tolist()) == (start, ids)
        start += len(ids)
    write_token_files(docs.limit(0), f"{tmp_root}/none", PATH)
    assert read_token_files(spark, f"{tmp_root}/none").count() == 0


@pytest.mark.parametrize("bucket_bytes", [1 << 20, 300])
def test_shards(spark, tmp_root, bucket_bytes):
    rows = [(i, f"text {i % 7}") for i in range(101)] + [(5, "text 5")] * 20 + [(None, None), (200, ""), (201, "y" * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("_key", "_bucket", "_row", "_offset", "_total", "key", "row", "copy", "bucket", "offset", "size"):
        docs = docs.withColumn(c, F.lit(1))
    runs = []
    for n, parts in enumerate((3, 5)):
        got = shuffle_into_shards(docs.repartition(parts, "doc_id"), f"{tmp_root}/{bucket_bytes}-{n}", bucket_bytes=bucket_bytes).collect()
        assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(rows, key=str)
        for s in range(8):
            slots = sorted(r.slot for r in got if r.shard == s)
            assert slots == list(range(len(slots))) and len(slots) in (len(rows) // 8, len(rows) // 8 + 1)
        runs.append(sorted(((r.shard, r.slot, r.text) for r in got), key=str))
    assert runs[0] == runs[1]  # the order doesn't follow from the partitions
    assert shuffle_into_shards(docs.limit(0), f"{tmp_root}/{bucket_bytes}-none").count() == 0


def plain_order(spark, rows, bucket_bytes, seed=20260):
    """(doc_id, text) in the order of the shards, bucket by bucket."""
    total = sum(len((t or "").encode()) + 64 for _, t in rows)
    buckets = max(1, -(-total // bucket_bytes))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    keys = [r[0] for r in frame.select(F.xxhash64(F.lit(seed), "doc_id", "text")).collect()]
    weight, seen, placed = {}, {}, []
    for key, (_, t) in zip(keys, rows):
        weight[key] = weight.get(key, 0) + len((t or "").encode()) + 64
    bucket = lambda pairs: [r[0] for r in spark.createDataFrame(pairs, "key long, copy long").select(
        F.pmod(F.xxhash64("key", "copy"), F.lit(buckets))).collect()]
    sizes = {}
    for key, b in zip(weight, bucket([(k, 0) for k in weight])):
        sizes[b] = sizes.get(b, 0) + weight[key]
    first = dict(zip(weight, bucket([(k, 0) for k in weight])))
    hot = {k for k in weight if weight[k] > bucket_bytes and sizes[first[k]] > 4 * bucket_bytes}
    for key, row in zip(keys, rows):
        copy = seen[key] = seen.get(key, -1) + 1
        placed.append((key, copy if key in hot else 0, row))
    of = {}
    for b, item in zip(bucket([x[:2] for x in placed]), placed):
        of.setdefault(b, []).append(item)
    out = []
    for b in sorted(of):
        items = sorted(of[b], key=lambda x: x[:2])
        out += [items[i][2] for i in fisher_yates(len(items), [seed, b])]
    return out


@pytest.mark.parametrize("bucket_bytes", [300, 2000])
def test_shards_equal_plain_order(spark, tmp_root, bucket_bytes):
    rows = [(i, f"text {i}") for i in range(100)] + [(7, "again and again")] * 200
    want = plain_order(spark, rows, bucket_bytes)
    for parts in (2, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = shuffle_into_shards(docs, f"{tmp_root}/{parts}", bucket_bytes=bucket_bytes).collect()
        assert [(r.doc_id, r.text) for r in sorted(got, key=lambda r: (r.shard, r.slot))] == want


def plain_cost(roles):
    """Least repair cost by trying every choice, turn by turn."""
    states = {0: 0}
    insert = lambda costs: [costs := {b: min([c for a, c in costs.items() if a == b] + [c + 2 for a, c in costs.items()
                                             if b in chat.NEXT[a] and b != 1]) for b in range(4)
                                      if b in costs or any(b in chat.NEXT[a] and b != 1 for a in costs)}
                            for _ in range(3)][-1]
    for r in roles:
        new = {}
        for a, c in states.items():
            if a:
                own = 1 if r + 1 == a else 2 if r == 3 else 4
                new[a] = min(new.get(a, 99**9), c + own)
        for a, c in insert(states).items():
            for b in chat.NEXT[a]:
                new[b] = min(new.get(b, 99**9), c + (0 if r + 1 == b else 2 if r == 3 else 3))
        states = new
    return insert(states)[3]


def test_repair_costs_are_least():
    for n in range(1, 5):
        for roles in itertools.product(range(4), repeat=n):
            for cut in (1, 2, 9):
                blocks = [list(roles[i:i + cut]) for i in range(0, n, cut)]
                states = chat.states_between([chat.block_matrix(b) for b in blocks])
                found = [d for b, s, t in zip(blocks, states, states[1:]) for d in chat.decisions(b, s, t)]
                assert sum(d[1] for d in found) + 2 * len(chat.ENDING[found[-1][0]]) == plain_cost(roles)


def test_chat(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_BITS", 1)  # blocks of two turns
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "a"), (2, 1, "User ", "b"), (2, 2, None, "c"),
             (3, 0, "assistant", "x <|im_end|>"), (4, 0, "system", None), (None, 0, "human", "n"), (None, 1, "gpt", "m"),
             (5, 0, "user", ""), (5, 0, "user", "")]
    turns += [(9, i, ("user", "assistant", "assistant")[i % 3], f"t{i}") for i in range(300)]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("place", F.lit("clash"))
    got = chat.format_chats(rows.repartition(4)).collect()
    assert len(got) == len(turns)
    text = {}
    for r in sorted(got, key=lambda r: r.place):
        text[r.conv_id] = text.get(r.conv_id, "") + r.rendered
    turn = lambda role, t: f"<|im_start|>{role}\n{t}<|im_end|>\n"
    assert text[1] == turn("user", "hi") + turn("assistant", "yo")
    assert text[2] == turn("user", "a\nb") + turn("assistant", "c")
    assert text[3] == turn("user", "") + turn("assistant", "x <| im_end|>")
    assert text[4] in (turn("system", "") + turn("user", "") + turn("assistant", ""), turn("user", "") + turn("assistant", ""))
    assert text[None] == turn("user", "n") + turn("assistant", "m")
    for t in text.values():
        roles = [x.split("\n")[0] for x in t.split("<|im_start|>")[1:]]
        roles = roles[1:] if roles[0] == "system" else roles
        assert len(roles) % 2 == 0 and roles == ["user", "assistant"] * (len(roles) // 2)
    code = {"system": 0, "user": 1, "assistant": 2}
    cost = {}
    for r in got:
        cost[r.conv_id] = cost.get(r.conv_id, 0) + r.cost
    assert cost[9] == plain_cost([code[t[2]] for t in turns if t[0] == 9]) and cost[5] == 3
    assert chat.format_chats(rows.limit(0)).count() == 0


def test_statistics():
    assert len(statistics("Some words, and\nlines.")) == len(NAMES)
    assert statistics(None).tolist() == statistics("").tolist() == [0.0] * (len(NAMES) - 1) + [1.0]
    assert np.isfinite(statistics("\x00 é " * 9999)).all()


def test_quality_on_held_out_rows(spark):
    sf = SF001.replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = fit_on_corpus(docs.withColumn("x", F.lit("clash")), labels)
    rows = model.score(docs).join(labels, "doc_id").filter(held_out()).select("score", "quality").collect()
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    assert np.mean([g > b for g in good for b in bad]) > 0.98
    assert np.mean([g >= 0.3 for g in good]) > 0.99 and np.mean([b < 0.3 for b in bad]) > 0.9
    ids = [r.doc_id for r in docs.filter(held_out()).select("doc_id").collect()]
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in ids)


def test_quality_on_odd_rows(spark):
    docs = spark.createDataFrame([(1, "good words here"), (2, None), (3, ""), (None, "x"), (1, "good words here")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 1), (77, 0, 0)], "doc_id long, quality int, toxic int")
    for d, lab in ((docs, labels), (docs, labels.limit(0)), (docs.limit(0), labels)):
        model = fit_on_corpus(d, lab)
        assert all(0 <= r.score <= 1 for r in model.score(docs.withColumn("score", F.lit("old"))).collect())
    assert model.score(docs.limit(0)).count() == 0
