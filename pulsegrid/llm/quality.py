"""Quality classifier: a linear SVM over naive-Bayes-scaled n-gram indicators.

Indicators: hashed word 1- and 2-grams and word-shape 1-, 2- and 3-grams (case,
digits, punctuation, last character, and whether a word repeats the one before
it).  Each indicator is scaled by its class log-count ratio, a text's vector has
length one, and the weights come from dual coordinate descent on the hinge
loss.  A logistic curve fitted on rows that the weights have not seen turns
margins into probabilities.

The classifier is fitted on at most ``FIT_ROWS`` labelled rows, those with the
smallest hash of their id; every text is scored whole, in one map-only pass.

Edge cases: a NULL or blank text has the bias alone; a label other than 0 or 1
is no label; without labelled rows every score is 0.5, and with one class only
it is that class's smoothed rate; repeated rows score alike; an empty table
gives no rows; columns named like the results are replaced, others kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import SPACE_WORDS, as_bytes, crc32_text, hash_words, mix64, slices, written

#: Bound on the labelled rows that the classifier is fitted on.
FIT_ROWS = 12_000
BINS = 1 << 18
#: Fitting rows that an indicator needs to count.
LEAST_ROWS = 8
THRESHOLD = 0.7

_CASED = bytes(32 if SPACE_WORDS[b] == 32 else b for b in range(256))


def _classes() -> np.ndarray:
    """Per byte, one-hot: upper case, digit, punctuation, other letter."""
    out = np.zeros((256, 4), np.uint8)
    for b in range(256):
        c = chr(b)
        out[b, 3 if b >= 128 or c.islower() else 0 if c.isupper() else 1 if c.isdigit() else 2] = 1
    out[32] = 0
    return out


_KIND = _classes()


def shapes(texts: list[bytes]) -> np.ndarray:
    """A code per word: case pattern, digits, punctuation and its last character if that is punctuation."""
    data = np.frombuffer(b" ".join(texts).translate(_CASED), np.uint8)
    inside = np.concatenate([[False], data != 32, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    code = _KIND[data[starts], 0].astype(np.uint64)
    for k, most in enumerate((2, 2, 4, 2)):
        n = np.add.reduceat(_KIND[:, k][data], starts, dtype=np.int64)
        code = code * np.uint64(8) + np.minimum(n, most).astype(np.uint64)
    last = data[ends - 1]
    return code * np.uint64(256) + np.where(_KIND[last, 2] > 0, last, 0).astype(np.uint64)


def indicators(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(document, bin) of every n-gram of a run of texts, with repeats."""
    words, counts = hash_words(texts, SPACE_WORDS)
    shape = shapes(texts)
    doc = np.repeat(np.arange(len(counts)), counts)
    out_doc, out_bin = [], []

    def add(kind: int, code: np.ndarray, owner: np.ndarray) -> None:
        out_doc.append(owner)
        out_bin.append((mix64(code * np.uint64(8) + np.uint64(kind)) % np.uint64(BINS)).astype(np.int64))

    step = np.uint64(0x9E3779B97F4A7C15)
    pair, triple = doc[1:] == doc[:-1], doc[2:] == doc[:-2]
    same = (words[1:] == words[:-1]).astype(np.uint64)
    add(0, words, doc)
    add(1, (words[:-1] * step + words[1:])[pair], doc[1:][pair])
    add(2, mix64(shape), doc)
    add(3, mix64((shape[:-1] * step + shape[1:]) * np.uint64(2) + same)[pair], doc[1:][pair])
    add(4, mix64((shape[:-2] * step + shape[1:-1]) * step + shape[2:])[triple], doc[2:][triple])
    return np.concatenate(out_doc), np.concatenate(out_bin)


def distinct(doc: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(doc * BINS + bins)
    return both // BINS, both % BINS


def coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, width: int, cost: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (bias last) of the L2-regularised hinge loss, by dual coordinate descent."""
    w, alpha = np.zeros(width + 1), np.zeros(len(y))
    q = np.array([float(v @ v) + 1.0 for v in values])
    rng = np.random.default_rng(3)
    for _ in range(rounds):
        worst = 0.0
        for i in rng.permutation(len(y)):
            gradient = y[i] * (w[rows[i]] @ values[i] + w[-1]) - 1
            new = min(cost, max(0.0, alpha[i] - gradient / q[i]))
            move = new - alpha[i]
            if move:
                worst, alpha[i] = max(worst, abs(move)), new
                w[rows[i]] += move * y[i] * values[i]
                w[-1] += move * y[i]
        if worst < 1e-3:
            break
    return w


def logistic_curve(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """(a, b) of 1 / (1 + exp(-(a m + b))), by Newton steps with a small ridge."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((p - good) * margins).sum() + 1e-3 * a, (p - good).sum() + 1e-3 * b])
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * margins**2).sum() + 1e-3, (v * margins).sum()], [(v * margins).sum(), v.sum() + 1e-3]])
        move = np.linalg.solve(h, g)
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-9:
            break
    return float(a), float(b)


@dataclass
class Weights:
    """By bin: weight times ratio, and squared ratio; the bias and the logistic curve."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, texts: list[bytes]) -> np.ndarray:
        doc, bins = indicators(texts)
        used = self.square[bins] > 0
        doc, bins = distinct(doc[used], bins[used])
        total = np.bincount(doc, self.weight[bins], len(texts))
        norm = np.sqrt(np.bincount(doc, self.square[bins], len(texts)))
        return total / np.where(norm > 0, norm, 1) + self.bias

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.offset, -30, 30)))


def constant(rate: float) -> Weights:
    return Weights(np.zeros(BINS), np.zeros(BINS), 0.0, 0.0, float(np.log(rate / (1 - rate))))


def train(rows: list[np.ndarray], labels: np.ndarray) -> Weights:
    """Fit on rows of distinct bins and 0/1 labels; every fifth row is kept for the logistic curve."""
    if not len(labels):
        return constant(0.5)
    if labels.min() == labels.max():
        return constant((labels.sum() + 1) / (len(labels) + 2))
    held = np.arange(len(labels)) % 5 == 4
    if len(set(labels[~held])) < 2 or not held.any():
        held[:] = False
    fit = np.flatnonzero(~held)
    flat, y = np.concatenate([rows[i] for i in fit]), labels[fit]
    owner = np.repeat(y, [len(rows[i]) for i in fit])
    good, bad = np.bincount(flat[owner == 1], minlength=BINS), np.bincount(flat[owner == 0], minlength=BINS)
    common = good + bad >= min(LEAST_ROWS, max(1, len(fit) // 20))
    p, q = (good + 1.0) / (good + 1.0)[common].sum(), (bad + 1.0) / (bad + 1.0)[common].sum()
    ratio = np.where(common, np.log(p / q), 0.0)

    def vector(i: int) -> tuple[np.ndarray, np.ndarray]:
        b = rows[i][ratio[rows[i]] != 0]
        v = ratio[b]
        return b, v / (np.linalg.norm(v) or 1.0)

    pairs = [vector(i) for i in fit]
    w = coordinate_descent([b for b, _ in pairs], [v for _, v in pairs], 2.0 * y - 1, BINS)
    out = Weights(w[:-1] * ratio, ratio**2, float(w[-1]), 1.0, 0.0)
    check = np.flatnonzero(held) if held.any() else fit
    margins = np.array([w[b] @ v + w[-1] for b, v in map(vector, check)])
    out.slope, out.offset = logistic_curve(margins, labels[check])
    return out


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = as_bytes(batch.column("text"))
        for lo, hi in slices(texts):
            doc, bins = distinct(*indicators(texts[lo:hi]))
            cuts = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("label").slice(lo, hi - lo), batch.column("rank").slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(cuts), pa.array(bins.astype(np.int32)))], ["label", "rank", "bins"])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, labels, ranks = [], [], []
    for batch in batches:
        labels += batch.column("label").to_pylist()
        ranks += batch.column("rank").to_pylist()
        lists = batch.column("bins")
        cuts, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        rows += [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    order = sorted(range(len(rows)), key=lambda i: (ranks[i], labels[i], len(rows[i]), rows[i].tobytes()))
    m = train([rows[i] for i in order], np.array([labels[i] for i in order], np.int64))
    used = np.flatnonzero(m.square)
    yield pa.RecordBatch.from_arrays(
        [pa.array([x], t) for x, t in ((used, pa.list_(pa.int64())), (m.weight[used], pa.list_(pa.float64())), (m.square[used], pa.list_(pa.float64())))] + [pa.array([[m.bias, m.slope, m.offset]], pa.list_(pa.float64()))],
        ["used", "weight", "square", "rest"])


def fit(docs: DataFrame, labels: DataFrame, keep=None, fit_rows: int = FIT_ROWS) -> Weights:
    """Weights from at most ``fit_rows`` rows of ``labels`` (doc_id, quality) for which ``keep(doc_id)`` holds.

    The chosen labels have a fixed bound, so they are broadcast; the texts they
    name are featurised where they lie, and one task fits the bounded rows.
    """
    rank = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("label"), rank.alias("rank")).where("label in (0, 1) and _id is not null")
    if keep is not None:
        chosen = chosen.where(keep(F.col("_id")))
    chosen = written(chosen.orderBy("rank", "_id", "label").limit(fit_rows), "quality-labels")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    sparse = written(rows.select("text", "label", "rank").mapInArrow(_featurise, "label int, rank bigint, bins array<int>"), "quality-rows")
    # A repeated document id must not lift the bound.
    r = sparse.orderBy("rank").limit(fit_rows).coalesce(1).mapInArrow(_train, "used array<bigint>, weight array<double>, square array<double>, rest array<double>").first()
    if r is None:
        return constant(0.5)
    w = Weights(np.zeros(BINS), np.zeros(BINS), *r["rest"])
    w.weight[r["used"]], w.square[r["used"]] = r["weight"], r["square"]
    return w


def score(docs: DataFrame, weights: Weights, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    docs = docs.drop("score", "predicted")
    model = docs.sparkSession.sparkContext.broadcast(weights)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column("_text"))
            out = [model.value.scores(texts[lo:hi]) for lo, hi in slices(texts)]
            s = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(s), pa.array((s >= threshold).astype(np.int32))], [*names, "score", "predicted"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.withColumn("_text", F.col(text)).mapInArrow(run, f"{fields}, score double, predicted int")


def is_held_out(doc_id):
    return crc32_text(doc_id) % 4 == 2


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; labels of held-out rows are never read into the fit."""
    weights = fit(docs, labels, lambda c: ~is_held_out(c))
    return score(docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "text"), weights).select("doc_id", "held_out", "score", "predicted")
