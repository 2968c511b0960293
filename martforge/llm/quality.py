"""Quality classifier by positive-unlabelled learning (non-negative unbiased risk).

A linear model g(x) on statistics of a text's bytes, words and lines minimises

    R(g) = p * E_pos[l(g)] + max(0, E_unl[l(-g)] - p * E_pos[l(-g)]) + l2 * |w|^2,   l(z) = log(1 + exp(-z)),

with trusted positives, unlabelled web text and an estimated class prior p. As l(z) - l(-z) = -z, the risk without
the max is convex: E_unl[l(-g)] - p * E_pos[g]. Newton steps minimise it; the sums over all unlabelled texts are
Spark aggregates of one row a task. A step after which the second term is negative (the model would fit noise) is
halved until the term is not, as the max gives no reason to go further; what a sample of n positives can be off by
anyway, p / (2 sqrt(n)), is allowed for. The score is 1 / (1 + exp(-g)).
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from martforge.llm import python_tasks
from martforge.session import materialize

#: ASCII characters counted one by one (all but letters and digits); letters, digits and other bytes are counted as groups.
SINGLE = [c for c in range(9, 127) if c in (9, 10, 32) or (c > 32 and not chr(c).isalnum())]
NAMES = ["upper", "lower", "digit", "high", "control", *[f"ascii_{c}" for c in SINGLE], "words", "distinct", "top_word",
         "same_next", "mean_length", "long_words", "odd_words", "caps_words", "distinct_lines", "bias"]
_ODD = re.compile(rb"[^\s\w\x80-\xff]{2}|[^\s\w\x80-\xff.,;:!?')\"]$")


def statistics(text: str | None) -> np.ndarray:
    """The features of one text, all between 0 and about 3; an empty text has zeros and the bias."""
    out = np.zeros(len(NAMES))
    out[-1] = 1
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return out
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256) / len(data)
    groups = (count[65:91].sum(), count[97:123].sum(), count[48:58].sum(), count[128:].sum(),
              count[:32].sum() - count[9:11].sum() + count[127])
    out[:5] = np.sqrt(np.maximum(groups, 0))
    out[5:5 + len(SINGLE)] = np.sqrt(count[SINGLE])
    words = data.split()
    if words:
        each, n = Counter(words), len(words)
        sizes = np.fromiter(map(len, words), np.int64, n)
        odd = sum(c for w, c in each.items() if _ODD.search(w))
        caps = sum(c for w, c in each.items() if len(w) > 1 and w.isupper())
        lines = [x for x in data.split(b"\n") if x.strip()]
        same = sum(a == b for a, b in zip(words, words[1:]))
        out[5 + len(SINGLE):-1] = (
            np.log1p(n) / 5, len(each) / n ** 0.9, max(each.values()) / n, same / n, min(sizes.mean(), 50) / 10,
            np.mean(sizes > 20), odd / n, caps / n, len(set(lines)) / len(lines))
    return out


def _features(batches):
    for batch in batches:
        for at in range(0, len(batch), 1000):
            part = batch.slice(at, 1000)
            x = [statistics(t.as_py()) for t in part.column(part.schema.get_field_index("text"))]
            keep = [c for c in part.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(x, pa.list_(pa.float64()))],
                                             [*keep, "x"])


def _sums(w: np.ndarray, mean: np.ndarray, scale: np.ndarray):
    """Sums of one task: rows, loss, gradient and Hessian of l(-g) at the weights."""
    def task(batches):
        d, total = len(w), np.zeros(2 + len(w) + len(w) ** 2)
        for batch in batches:
            if not len(batch):
                continue
            x = (np.array(batch.column(0).flatten()).reshape(len(batch), d) - mean) / scale
            g = x @ w
            s = 1 / (1 + np.exp(-np.clip(g, -500, 500)))
            total[0] += len(x)
            total[1] += np.logaddexp(0, g).sum()
            total[2:2 + d] += x.T @ s
            total[2 + d:] += (x.T @ (x * (s * (1 - s))[:, None])).ravel()
        yield pa.RecordBatch.from_pydict({"i": list(range(len(total))), "v": total.tolist()})
    return task


def _total(rows: DataFrame, w, mean, scale) -> tuple[float, float, np.ndarray, np.ndarray]:
    d = len(w)
    parts = rows.select("x").mapInArrow(_sums(w, mean, scale), "i long, v double").groupBy("i").agg(F.sum("v").alias("v"))
    out = np.zeros(2 + d + d * d)
    for r in parts.collect():  # d * d + d + 2 rows
        out[r["i"]] = r["v"]
    n = max(out[0], 1.0)
    return out[0], out[1] / n, out[2:2 + d] / n, out[2 + d:].reshape(d, d) / n


class QualityModel:
    """Weights of the standardised features; ``score`` and ``predict`` add columns to documents."""

    def __init__(self, w, mean, scale, prior: float, risk: list[float]):
        self.w, self.mean, self.scale, self.prior, self.risk = w, mean, scale, prior, risk

    def score(self, docs: DataFrame, text_col: str = "text", into: str = "score") -> DataFrame:
        """``docs`` with the score (0 to 1) of its texts; null and empty texts get that of a text without words."""
        python_tasks(docs.sparkSession)
        w, mean, scale = self.w, self.mean, self.scale
        names = [c for c in docs.columns if c != into]

        def task(batches):
            for batch in batches:
                text = batch.column(batch.schema.get_field_index(text_col))
                x = np.array([statistics(t.as_py()) for t in text]).reshape(len(batch), len(NAMES))
                g = ((x - mean) / scale) @ w
                columns = [batch.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(1 / (1 + np.exp(-np.clip(g, -500, 500))))],
                                                 [*batch.schema.names, into])

        schema = docs.select(*names).schema.add(into, "double")
        return docs.select(*names).mapInArrow(task, schema)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        positives: int = 50_000, prior: float | None = None, l2: float = 1e-4, steps: int = 25) -> QualityModel:
    """Learns from ``labels`` (id, 0/1) and all texts of ``docs``.

    At most ``positives`` labelled rows (those with the smallest hashes of their ids) are trusted positives; the
    unlabelled risk runs over every row of ``docs``. ``prior``, the share of positives, is estimated as the share of
    label 1 among the labelled rows where it is not given. Null labels, ids and labels without a document are not
    used; several labels of one id count each. Without a positive nothing can be learned: every text scores the prior.
    """
    python_tasks(docs.sparkSession)
    labels = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).dropna()
    share = labels.agg(F.sum("_y").alias("ones"), F.count("_y").alias("n")).first()
    if prior is None:
        prior = ((share["ones"] or 0) + 0.5) / (share["n"] + 1)
    prior = min(max(prior, 0.01), 0.99)
    rows = materialize(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                       .mapInArrow(_features, docs.select(F.col(id_col).alias("id")).schema.add("x", ArrayType(DoubleType()))),
                       "quality-features")
    trusted = labels.filter("_y = 1").orderBy(F.xxhash64("_id"), "_id").limit(positives)
    # null columns of a text are zeros, so every row has the same length
    near = rows.join(F.broadcast(trusted.select("_id")), F.col("id") == F.col("_id"))
    d = len(NAMES)
    n, _, half, _ = _total(near, np.zeros(d), np.zeros(d), np.ones(d))  # at w = 0 the gradient is half the mean
    mean, scale = np.zeros(d), np.ones(d)
    total, _, all_half, spread = _total(rows, np.zeros(d), mean, scale)
    if not n or not total:
        w = np.zeros(d)
        w[-1] = np.log(prior / (1 - prior))
        return QualityModel(w, mean, scale, prior, [])
    mean = 2 * all_half
    scale = np.sqrt(np.maximum(4 * np.diag(spread) - mean ** 2, 0))
    scale[scale < 1e-6] = np.inf  # a feature that never varies says nothing
    mean[-1], scale[-1] = 0, 1
    positive = (2 * half - mean) / scale

    def risk(at):
        _, loss, gradient, hessian = _total(rows, at, mean, scale)
        _, loss_pos, _, _ = _total(near, at, mean, scale)
        return (loss - prior * (at @ positive) + l2 * (at[:-1] @ at[:-1]), loss - prior * loss_pos,
                gradient - prior * positive, hessian)

    slack = prior / (2 * np.sqrt(n))
    w, ridge, seen = np.zeros(d), np.append(np.full(d - 1, 2 * l2), 1e-9), []
    w[-1] = np.log(prior / (1 - prior))
    now = risk(w)
    for _ in range(steps):
        seen.append(now[0])
        step = np.linalg.solve(now[3] + np.diag(ridge + 1e-9), now[2] + ridge * w)
        size, done = 1.0, True
        while size > 0.05:
            then = risk(w - size * step)
            if then[0] < now[0] - 1e-7 and then[1] >= -slack:
                w, done = w - size * step, now[0] - then[0] < 1e-5
                now = then
                break
            size /= 2
        if done:
            break
    return QualityModel(w, mean, scale, prior, seen)


def held_out(id_col: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit_on_corpus(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Fitted on labels and texts that are not held out."""
    return fit(docs.filter(~held_out()), labels.filter(~held_out()))
