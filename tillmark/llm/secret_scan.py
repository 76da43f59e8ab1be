"""Secret scanning: fixed patterns, and a character convolutional network over every candidate.

The patterns' findings stay. A candidate is a run of 6 or more characters of those that secrets are
made of, with a digit, with a capital after a small letter, or shortly after a word like ``key`` or
``password``; what a pattern found is cut out of it, and what is left on either side is a candidate
by the same rule. The network reads its characters, in segments, each with what stands before and
after it, and the candidate takes the highest probability of its segments. It learns from
the different candidates of all documents, labelled by whether a pattern found a secret there, with all
their segments up to ``MAX_SEGMENTS``. Up to ``MAX_CANDIDATES`` of them are learned on the driver; if there
are more, that gives the first weights only: then, ``ROUNDS`` times, every task goes on with its share of
all of them, and the weights are averaged. Findings are also shown altered: letters and digits drawn anew, in the surroundings of
candidates that are none, so that a secret of an alphabet or in a place that no pattern has is one by
its disorder. A quarter is kept apart: on all of it, the scores of whole candidates are
calibrated (a logistic curve) and the threshold is set to the highest that keeps ``RECALL`` of its
labelled findings, and as much of them altered. Candidates above it are added as kind ``model``. With fewer than
``LEAST_FINDINGS`` findings, or other candidates, there is no network and nothing is added.

Places count code points, ends are exclusive. Defined results: null text counts as empty and has no
findings; rows that repeat are scanned each. Only the named columns are read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.cnn import ByteNetwork
from tillmark.llm.common import (
    kept_table,
    received,
    row_type,
    sent_by_value,
    ship_by_value,
    sliced,
    text_apart,
)

TRAIN_DOCS = 20_000
MAX_CANDIDATES = 12_000
AT_A_TURN = 16
MAX_SEGMENTS = 16  # of a candidate to learn from; all are scored
ROUNDS = 3
# Margins are counted in steps of one over this, up to a bound, to calibrate and to set the threshold.
STEPS, FARTHEST = 1024, 40.0
LEAST_FINDINGS = 8
RECALL = 0.99
BEFORE, SEGMENT, AFTER = 24, 48, 24
KINDS = ("assign", "access", "hex", "model")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_CHARACTERS = 6
_RUN = re.compile(r"[A-Za-z0-9+/_.=!@#$%^&*~-]{6,}")
_MARKED = re.compile(r"[0-9]|[a-z][^A-Z]*[A-Z]")
_NEAR = re.compile(r"passw|passphrase|pwd|secret|token|key|credential|bearer", re.IGNORECASE | re.ASCII)

Span = tuple[int, int, int]  # start, number of the kind, end


def base_findings(text: str) -> list[Span]:
    found: list[Span] = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int]]:
    near = [m.end() for m in _NEAR.finditer(text)]

    def hinted(a: int) -> bool:
        return bool(near) and bisect_right(near, a) > bisect_left(near, a - BEFORE)

    return [m.span() for m in _RUN.finditer(text) if _MARKED.search(m[0]) or hinted(m.start())]


def merged(spans: list[Span]) -> list[tuple[int, int]]:
    """The stretches that sorted spans cover, disjoint and ascending."""
    out: list[tuple[int, int]] = []
    for a, _, b in spans:
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def touched(a: int, b: int, covered: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those of the covered stretches that overlap [a, b)."""
    first = bisect_right(covered, a, key=lambda x: x[1])
    return covered[first: bisect_left(covered, b, key=lambda x: x[0])]


def outside(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """Candidates without what the spans cover: whole, or what is left of them if it is one by itself."""
    covered = merged(spans)
    out = []
    for a, b in candidates(text):
        parts = touched(a, b, covered)
        if not parts:
            out.append((a, b))
            continue
        begins, ends = [a, *[e for _, e in parts]], [*[s for s, _ in parts], b]
        out += [(x, y) for x, y in zip(begins, ends, strict=True)
                if y - x >= LEAST_CHARACTERS and _MARKED.search(text, x, y)]
    return out


def segments(text: str, a: int, b: int) -> np.ndarray:
    """The candidate's windows of codes: what stands before, a segment, what stands after."""
    rows = []
    for at in range(a, b, SEGMENT):
        end = min(at + SEGMENT, b)
        row = np.zeros(BEFORE + SEGMENT + AFTER, np.uint8)
        for place, part in ((0, text[max(0, at - BEFORE): at].rjust(BEFORE, "\0")),
                            (BEFORE, text[at: end]), (BEFORE + SEGMENT, text[end: end + AFTER])):
            row[place: place + len(part)] = [c if c < 256 else 1 for c in map(ord, part)]
        rows.append(row)
    return np.stack(rows)


@dataclass
class SecretModel:
    network: ByteNetwork | None
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 1.0

    def margins(self, windows: list[np.ndarray]) -> np.ndarray:
        """How far each candidate's likeliest segment is on the side of secrets."""
        if not windows:
            return np.zeros(0)
        z = self.network.logits(np.concatenate(windows))
        first = np.concatenate([[0], np.cumsum([len(w) for w in windows])[:-1]])
        return np.maximum.reduceat(z[:, 1] - z[:, 0], first)

    def scores(self, windows: list[np.ndarray]) -> np.ndarray:
        """A calibrated probability for each candidate's windows."""
        return 1 / (1 + np.exp(-(self.slope * self.margins(windows) + self.shift)))


def _windows(docs: DataFrame) -> DataFrame:
    """``window, label, turn``: the different labelled candidates of all documents.

    Of a document with many, a few have an early turn.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            windows, label, turn = [], [], []
            for t in batch.column(0).to_pylist():
                covered = merged(base_findings(t or ""))
                own = [(segments(t, a, min(b, a + MAX_SEGMENTS * SEGMENT)).tobytes(),
                        int(bool(touched(a, b, covered)))) for a, b in candidates(t or "")]
                drawn = [0, 0]
                for window, y in sorted(own, key=lambda x: zlib.crc32(x[0])):
                    windows.append(window)
                    label.append(y)
                    turn.append(drawn[y] // AT_A_TURN)
                    drawn[y] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(windows, pa.binary()), pa.array(label, pa.int32()), pa.array(turn, pa.int32())],
                names=["window", "label", "turn"])

    found = docs.select("text").mapInArrow(run, "window binary, label int, turn int")
    return kept_table(found.groupBy("window", "label").agg(F.min("turn").alias("turn")), "secret-windows")


def _first(found: DataFrame) -> list:
    """At most ``MAX_CANDIDATES`` of the windows; each label has half of them to itself, and what the
    other leaves."""
    place = F.xxhash64("window").alias("place")
    rows = [found.where(F.col("label") == y).select("window", "label", "turn", place).orderBy("turn", "place")
            .limit(MAX_CANDIDATES).collect() for y in (1, 0)]
    half = MAX_CANDIDATES // 2
    taken = [own[: max(half, MAX_CANDIDATES - len(other))] for own, other in (rows, rows[::-1])]
    return [r for own in taken for r in sorted(own, key=lambda r: r["place"])]


def _sample(docs: DataFrame, train_docs: int) -> list:
    """``_first`` of about ``train_docs`` documents, chosen by a hash of their id; for trials."""
    share = train_docs / max(1, docs.count())
    chance = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 24)) / (1 << 24)
    return _first(_windows(docs.where(chance < share)))


def _as_windows(window: bytes) -> np.ndarray:
    return np.frombuffer(window, np.uint8).reshape(-1, BEFORE + SEGMENT + AFTER)


def train(docs: DataFrame, train_docs: int | None = None, recall: float = RECALL) -> SecretModel:
    """The model learned from all documents, or from a sample of ``train_docs`` if that is asked for."""
    sizes: dict[int, int] = {}
    if train_docs is None:
        found = _windows(docs)
        sizes = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
        rows = _first(found)
    else:
        rows = _sample(docs, train_docs)
    whole = [_as_windows(r["window"]) for r in rows]
    y = np.array([r["label"] for r in rows], np.int64)
    if y.sum() < LEAST_FINDINGS or len(y) - y.sum() < LEAST_FINDINGS:
        return SecretModel(None)
    if sum(sizes.values()) > len(rows):
        return _train_on_all(found, sizes, whole, y, recall)
    order = np.random.default_rng(3).permutation(len(y))
    whole, y = [whole[i] for i in order], y[order]
    apart = np.zeros(len(y), bool)
    for label in (0, 1):
        own = np.flatnonzero(y == label)
        apart[own[: len(own) // 4]] = True
    learned = np.flatnonzero(~apart)
    model = SecretModel(_go_on(ByteNetwork(2), [whole[i] for i in learned], y[learned],
                               {1: int(y.sum()), 0: int(len(y) - y.sum())}, epochs=8))
    kept_apart = np.flatnonzero(apart)
    margins = model.margins([whole[i] for i in kept_apart])
    model.slope, model.shift = _logistic_curve(margins, y[kept_apart])
    findings = [whole[i] for i in kept_apart if y[i] == 1]
    others = np.concatenate([whole[i] for i in kept_apart if y[i] == 0])
    altered = [_altered(w, others, seed) for seed, w in enumerate(findings)]
    # The highest threshold that lets at most 1 - recall of either go.
    model.threshold = min(
        float(np.sort(model.scores(group))[int((1 - recall) * len(group))]) for group in (findings, altered))
    return model


def _go_on(network: ByteNetwork, whole: list[np.ndarray], y: np.ndarray, sizes: dict[int, int],
           draw: int = 5, **how) -> ByteNetwork:
    """The network trained on these candidates; findings also altered."""
    # A candidate weighs the same whatever its length: its segments share its weight.
    lengths = np.array([len(w) for w in whole])
    total = sum(sizes.values())
    weights = np.where(y == 1, total / sizes[1], total / sizes[0]) / lengths
    x, label, weight = np.concatenate(whole), np.repeat(y, lengths), np.repeat(weights, lengths)
    found = label == 1
    if found.any() and not found.all():
        x = np.concatenate([x, _altered(x[found], x[~found], draw)])
        label, weight = np.concatenate([label, label[found]]), np.concatenate([weight, weight[found]])
    return network.train(x, label, weights=weight, **how)


def _train_on_all(found: DataFrame, sizes: dict[int, int], whole: list[np.ndarray], y: np.ndarray,
                  recall: float) -> SecretModel:
    """The model learned by tasks from all windows, of which ``whole`` and ``y`` are the first.

    To the driver come averaged weights, and counts of margins.
    """
    # Another hash than the one the first are drawn by; the same quarter stays apart throughout.
    apart = F.pmod(F.crc32("window"), F.lit(4)) == 0
    own = [i for i, w in enumerate(whole) if zlib.crc32(w.tobytes()) % 4]
    model = SecretModel(_go_on(ByteNetwork(2), [whole[i] for i in own], y[own], sizes, epochs=8))
    shards = -(-sum(sizes.values()) // MAX_CANDIDATES)
    dealt = kept_table(found.where(~apart).select(
        "window", "label", F.pmod(F.xxhash64("window"), F.lit(shards)).cast("int").alias("shard")), "secret-shards")
    for turn in range(ROUNDS):
        model.network.set_flat(_averaged(dealt, shards, model.network, sizes, turn))
    others = np.concatenate([w for w, label in zip(whole, y, strict=True) if label == 0])[:MAX_CANDIDATES // 8]
    margin, kind, count = _margin_counts(found.where(apart), model, others)
    plain = kind < 2
    model.slope, model.shift = _logistic_curve(margin[plain], kind[plain], count=count[plain])
    # The highest threshold, to a step, that lets at most 1 - recall of findings, and of altered ones, go.
    lowest = []
    for k in (1, 2):
        step, below = margin[kind == k], np.cumsum(count[kind == k])
        lowest.append(step[np.searchsorted(below, int((1 - recall) * below[-1]), side="right")]
                      if len(step) else FARTHEST)
    edge = min(lowest) - 0.5 / STEPS
    model.threshold = float(1 / (1 + np.exp(-(model.slope * edge + model.shift))))
    return model


def _averaged(dealt: DataFrame, shards: int, network: ByteNetwork, sizes: dict[int, int], turn: int) -> np.ndarray:
    """The mean of the weights that the tasks come to, each from the network and a shard of the windows."""
    sent = sent_by_value(dealt.sparkSession, network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A shard is about MAX_CANDIDATES windows, however many there are.
        rows = sorted((w, y) for batch in batches for w, y in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        if rows:
            own = _go_on(received(sent), [_as_windows(w) for w, _ in rows], np.array([y for _, y in rows], np.int64),
                         sizes, draw=turn, epochs=1, rate=0.002, seed=turn)
            yield pa.RecordBatch.from_arrays(
                [pa.array([own.flat().tolist()], pa.list_(pa.float32())), pa.array([float(len(rows))])],
                names=["weights", "n"])

    trained = dealt.repartitionById(shards, F.col("shard")).select("window", "label").mapInArrow(
        run, "weights array<float>, n double").withColumn("vector", array_to_vector("weights"))
    mean = Summarizer.mean(F.col("vector"), F.col("n"))
    return trained.select(mean.alias("mean")).first()["mean"].toArray()


def _margin_counts(apart: DataFrame, model: SecretModel, others: np.ndarray
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Margins in steps, ascending, with their kind (label; 2 for altered findings) and how many."""
    sent = sent_by_value(apart.sparkSession, (model, others))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, between = received(sent)
        for batch in sliced(batches):
            windows = [_as_windows(w) for w in batch.column(0).to_pylist()]
            label = batch.column(1).to_pylist()
            altered = [_altered(w, between, zlib.crc32(w.tobytes()))
                       for w, y in zip(windows, label, strict=True) if y == 1]
            margins = own.margins(windows + altered)
            steps = np.floor(np.clip(margins, -FARTHEST, FARTHEST) * STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(steps), pa.array(label + [2] * len(altered), pa.int32())], names=["step", "kind"])

    counted = apart.select("window", "label").mapInArrow(run, "step int, kind int").groupBy("step", "kind").count()
    rows = np.array(sorted(tuple(r) for r in counted.collect()), np.int64).reshape(-1, 3)
    return (rows[:, 0] + 0.5) / STEPS, rows[:, 1], rows[:, 2]


def _altered(windows: np.ndarray, others: np.ndarray, seed: int = 5) -> np.ndarray:
    """The windows with every letter and digit of their segments drawn anew from all of them, between
    what stands before and after some of ``others``."""
    alphabet = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", np.uint8)
    rng = np.random.default_rng(seed)
    out = others[rng.integers(0, len(others), len(windows))].copy()
    segment = windows[:, BEFORE: BEFORE + SEGMENT]
    out[:, BEFORE: BEFORE + SEGMENT] = np.where(
        np.isin(segment, alphabet), rng.choice(alphabet, segment.shape), segment)
    return out


def _logistic_curve(margin: np.ndarray, y: np.ndarray, rounds: int = 200, count: np.ndarray | float = 1.0
                    ) -> tuple[float, float]:
    """Slope (positive) and shift of a logistic curve, by damped Newton steps with a weak prior."""
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        wrong = (p - y) * count
        g = np.array([(wrong * margin).sum() + 0.1 * (a - 1), wrong.sum() + 0.1 * b])
        w = p * (1 - p) * count
        h = np.array([[(w * margin * margin).sum() + 0.1, (w * margin).sum()],
                      [(w * margin).sum(), w.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        a, b = max(1e-3, a - 0.5 * step[0]), b - 0.5 * step[1]
    return float(a), float(b)


def all_findings(texts: list[str | None], model: SecretModel) -> list[tuple[list[Span], list[Span]]]:
    """The patterns' findings of each text, and all findings with the network's."""
    base = [base_findings(t or "") for t in texts]
    asked = []
    if model.network is not None:
        asked = [(i, a, b) for i, t in enumerate(texts) if t for a, b in outside(t, base[i])]
    added: dict[int, list[Span]] = {}
    for k in range(0, len(asked), 1024):
        part = asked[k: k + 1024]
        scores = model.scores([segments(texts[i], a, b) for i, a, b in part])
        for (i, a, b), p in zip(part, scores, strict=True):
            if p >= model.threshold:
                added.setdefault(i, []).append((a, 3, b))
    return [(x, sorted(x + added.get(i, []))) for i, x in enumerate(base)]


def as_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every found stretch replaced by ``[secret]``."""
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], "[secret]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, model: SecretModel, redact: bool = False) -> DataFrame:
    """``row`` (the columns of ``docs`` but ``text``), ``base`` and ``spans`` as text; if asked also
    ``text``, with every finding replaced."""
    sent = sent_by_value(docs.sparkSession, model)  # the network: under 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = received(sent)
        for batch in sliced(batches):
            texts = batch.column("text").to_pylist()
            found = all_findings(texts, own)
            columns = {"row": batch.column("row"),
                       "base": pa.array([as_text(x) for x, _ in found], pa.string()),
                       "spans": pa.array([as_text(x) for _, x in found], pa.string())}
            if redact:
                columns["text"] = pa.array([redacted(t, x) if x else t for t, (_, x)
                                            in zip(texts, found, strict=True)], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    apart = text_apart(docs)
    return apart.mapInArrow(
        run, f"{row_type(apart)}, base string, spans string" + (", text string" if redact else ""))


def counts(scanned: DataFrame) -> DataFrame:
    """Per row: number of findings of each fixed kind, digest of them, and all spans."""
    def of(kind: str):
        return F.regexp_count("base", F.lit(f"{kind}:")).cast("bigint").alias(f"n_{kind}")

    return scanned.select("row.doc_id", *[of(k) for k in KINDS[:3]],
                          F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


ship_by_value(__name__)
