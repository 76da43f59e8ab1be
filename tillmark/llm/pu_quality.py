"""Quality by positive-unlabelled learning.

Texts known to be good (trusted positives) and texts of which nothing is known (unlabelled) are all that
is learned from; no text is known to be bad. A small network minimises the non-negative unbiased risk:
with ``prior`` the share of good texts, ``prior * R(positives, good) + max(0, R(unlabelled, bad) - prior
* R(positives, bad))``; where the second part falls below zero, steps are taken against it, so that it
is not learned by heart. The prior is estimated too: a first network tells positives from unlabelled
texts, and on texts that it did not learn from, the share of unlabelled over that of positives above a
threshold is an upper bound of the prior; the threshold is that of the least bound with its error.

A text is seen through how often classes of bytes follow each other, and through what repeats in it:
words, runs of three words, lines. Both are of the whole text.

What is learned from is a bounded sample, chosen by a hash of the id: ``POSITIVES`` and ``UNLABELLED``
texts, whose features (``N_FEATURES`` numbers a text) go to the driver. Everything is scored.

Defined results: null counts as empty. Without a trusted positive that has a text row every score is 0.
Rows that repeat are scored each; of several labels of an id the smallest holds. Only the named columns
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.llm.common import (
    received,
    row_type,
    sent_by_value,
    ship_by_value,
    sliced,
    text_apart,
    worker_cache,
)
from tillmark.llm.kernel import Texts, mix, rows_of, same_row, small_batches, window_hashes

POSITIVES = 6_000
UNLABELLED = 12_000
THRESHOLD = 0.7
_CLASSES = 16
_OTHERS = 9
N_FEATURES = _CLASSES * _CLASSES + _OTHERS


def _class_of_byte() -> np.ndarray:
    """Sixteen classes of bytes: letters by case, digits, gaps, signs that go together."""
    of = np.full(256, 15, np.int64)  # other signs and control bytes
    groups = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r",
              b".", b",", b"!?", b"|", b"#*", b"$%&", b"<>", b"\"'()[]{}", b":;-_/"]
    for i, group in enumerate(groups):
        of[list(group)] = i
    of[128:] = 14
    return of


def _seen_before(keys: np.ndarray) -> np.ndarray:
    """Which of the keys also stand further to the front."""
    order = np.argsort(keys, kind="stable")
    out = np.zeros(len(keys), bool)
    out[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return out


def features(texts: Texts) -> np.ndarray:
    """A row of numbers for each text: roots of shares, and logarithms of sizes."""
    n, size = texts.rows, np.diff(texts.off)
    row_of_byte = np.repeat(np.arange(n), size)
    kinds = worker_cache("byte-classes", _class_of_byte)[texts.buf]
    follows = row_of_byte[1:] == row_of_byte[:-1]
    pairs = (row_of_byte[1:] * _CLASSES + kinds[:-1]) * _CLASSES + kinds[1:]
    counts = np.bincount(pairs[follows], minlength=n * _CLASSES**2).reshape(n, -1)

    starts, ends, first = texts.words()
    rows, n_words = rows_of(first), np.diff(first)
    salt = mix(np.arange(n, dtype=np.uint64) + np.uint64(1))
    words = texts.hashes(starts, ends, fold_case=True) ^ salt[rows]
    twice = np.zeros(len(words), bool)
    twice[1:] = words[1:] == words[:-1]
    triples = np.flatnonzero(same_row(rows, 3))
    again = triples[_seen_before(window_hashes(words, 3)[triples])]
    begins, stops, line_first = texts.pieces(texts.buf == 10)
    line_rows = rows_of(line_first)
    lines = texts.hashes(begins, stops) ^ salt[line_rows]

    def share(marked: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.sqrt(np.bincount(marked, minlength=n) / np.maximum(whole, 1))

    long = (ends - starts) > 20
    others = [
        share(rows[_seen_before(words)], n_words), share(rows[twice], n_words), share(rows[again], n_words),
        share(line_rows[_seen_before(lines)], np.diff(line_first)), share(rows[long], n_words),
        np.log1p(n_words), np.log1p(size), np.log1p(np.diff(line_first)),
        np.log1p(np.bincount(rows, weights=ends - starts, minlength=n) / np.maximum(n_words, 1)),
    ]
    shares = np.sqrt(counts / np.maximum(size - 1, 1)[:, None])
    return np.concatenate([shares, np.stack(others).T], 1).astype(np.float32)


class Network:
    """One hidden layer; the sign of ``logits`` says good or bad."""

    def __init__(self, inputs: int, hidden: int = 32, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.weights = [rng.normal(0, (2 / inputs) ** 0.5, (inputs, hidden)).astype(np.float32),
                        np.zeros(hidden, np.float32),
                        rng.normal(0, (1 / hidden) ** 0.5, hidden).astype(np.float32),
                        np.zeros(1, np.float32)]
        self.first = [np.zeros_like(w) for w in self.weights]
        self.second = [np.zeros_like(w) for w in self.weights]
        self.step = 0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum(x @ w1 + b1, 0) @ w2 + b2

    def move(self, x: np.ndarray, slope: np.ndarray, rate: float = 2e-3, decay: float = 1e-3) -> None:
        """A step of Adam for the slopes of the risk by the logits of ``x``."""
        w1, b1, w2, _ = self.weights
        inner = np.maximum(x @ w1 + b1, 0)
        back = np.outer(slope, w2) * (inner > 0)
        grads = [x.T @ back + decay * w1, back.sum(0), inner.T @ slope + decay * w2, slope.sum(keepdims=True)]
        self.step += 1
        for w, g, m, v in zip(self.weights, grads, self.first, self.second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)


def _chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def risk_slopes(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Slopes of the non-negative risk by the logits of positives and unlabelled texts, and the risk of
    the unlabelled as bad without the good among them. Losses are logistic."""
    bad_risk = float(np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean())
    as_good, as_bad = -prior * _chance(-zp) / len(zp), -prior * _chance(zp) / len(zp)
    unlabelled = _chance(zu) / len(zu)
    if bad_risk < 0:  # below what a risk can be: back to where it is not
        return -as_bad, -unlabelled, bad_risk
    return as_good + as_bad, unlabelled, bad_risk


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, epochs: int = 40,
        batch: int = 256, seed: int = 3) -> Network:
    """With a prior by the non-negative risk; without one, positives against unlabelled texts."""
    rng = np.random.default_rng(seed)
    net = Network(positive.shape[1])
    steps = max(8, -(-len(unlabelled) // batch))
    for _ in range(epochs):
        for _ in range(steps):
            p = positive[rng.integers(0, len(positive), min(batch, 4 * len(positive)))]
            u = unlabelled[rng.integers(0, len(unlabelled), min(batch, 4 * len(unlabelled)))]
            zp, zu = net.logits(p), net.logits(u)
            if prior is None:
                slope_p, slope_u = -_chance(-zp) / len(zp), _chance(zu) / len(zu)
            else:
                slope_p, slope_u, _ = risk_slopes(zp, zu, prior)
            net.move(np.concatenate([p, u]), np.concatenate([slope_p, slope_u]).astype(np.float32))
    return net


def bound_of_prior(positive: np.ndarray, unlabelled: np.ndarray, doubt: float = 0.1) -> float:
    """Share of positives among the unlabelled, from scores of both that nothing was learned from."""
    cuts = np.unique(positive)
    over_p = 1 - np.searchsorted(np.sort(positive), cuts, "left") / len(positive)
    over_u = 1 - np.searchsorted(np.sort(unlabelled), cuts, "left") / len(unlabelled)
    error = sum((np.log(4 / doubt) / 2 / len(x)) ** 0.5 for x in (positive, unlabelled))
    best = np.argmin((over_u + error) / over_p)
    return float(np.clip(over_u[best] / over_p[best], 0.05, 0.99))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Each half is scored by a network that saw the other."""
    scores: tuple[list, list] = [], []
    for half in (0, 1):
        net = fit(positive[half::2], unlabelled[half::2], None, epochs=8)
        for out, x in zip(scores, (positive, unlabelled), strict=True):
            out.append(_chance(net.logits(x[1 - half::2])))
    return float(np.mean([bound_of_prior(p, u) for p, u in zip(*scores, strict=True)]))


@dataclass
class QualityModel:
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    network: Network | None = None
    prior: float | None = None

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.network is None:
            return np.zeros(len(x))
        return _chance(self.network.logits(self.scaled(x))).astype(float)


def learn(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> QualityModel:
    """The model of rows of features; ``prior`` is estimated unless given."""
    if not len(positive) or not len(unlabelled):
        return QualityModel()
    model = QualityModel(unlabelled.mean(0), unlabelled.std(0) + 0.02)
    p, u = model.scaled(positive), model.scaled(unlabelled)
    model.prior = prior if prior is not None else estimate_prior(p, u) if min(len(p), len(u)) > 1 else 0.5
    model.network = fit(p, u, model.prior)
    return model


def _sampled(texts: DataFrame, limit: int) -> np.ndarray:
    """Features of at most ``limit`` texts, those whose ids have the least hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = [features(t) for _, t in small_batches(batch.column("text"))]
            yield pa.RecordBatch.from_pydict({
                "h": batch.column("h"), "doc_id": batch.column("doc_id"),
                "x": pa.array([r.tobytes() for part in rows for r in part], pa.binary())})

    made = texts.select("h", "doc_id", "text").mapInArrow(run, "h long, doc_id long, x binary")
    rows = made.orderBy("h", "doc_id", "x").limit(limit).collect()  # limit x N_FEATURES numbers
    return np.frombuffer(b"".join(r["x"] for r in rows), np.float32).reshape(-1, N_FEATURES)


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED,
          trusted: Column | None = None) -> QualityModel:
    """Learns from ``text`` of ``docs`` and from which ``doc_id`` have the label ``quality`` 1.

    ``trusted`` says of a label's row whether it may be learned from.
    """
    hashed = F.xxhash64("doc_id", F.lit("quality"))
    place = F.pmod(hashed, F.lit(1 << 24)) / (1 << 24)
    known = labels.where("quality IN (0, 1)")
    known = known if trusted is None else known.where(trusted)
    good = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    share = 1.1 * positives / max(1, good.count())
    chosen = good.where(place < share).limit(2 * positives)  # ids only: 16 bytes each
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("h", hashed)
    p = _sampled(own.join(F.broadcast(chosen), "doc_id", "left_semi"), positives)
    share = 1.1 * unlabelled / max(1, docs.count())
    u = _sampled(own.where((place < share) | F.col("doc_id").isNull()), unlabelled)
    return learn(p, u)


def score(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``row`` (the columns of ``docs`` but ``text``), ``score`` and ``predicted``."""
    sent = sent_by_value(docs.sparkSession, model)  # N_FEATURES x 32 weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = received(sent)
        for batch in sliced(batches):
            found = [learned.score(features(t)) for _, t in small_batches(batch.column("text"))]
            yield pa.RecordBatch.from_pydict({
                "row": batch.column("row"),
                "score": pa.array(np.concatenate(found) if found else [], pa.float64())})

    apart = text_apart(docs)
    return apart.mapInArrow(run, f"{row_type(apart)}, score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


ship_by_value(__name__)
