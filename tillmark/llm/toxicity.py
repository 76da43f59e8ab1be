"""Toxicity by a weighted lexicon, matched by Aho-Corasick.

Texts are folded first: small letters, letters of other scripts that look Latin, digits and signs
that stand for letters (only within words that have a letter), white space and stops to one space.
The lexicon is learned from labelled texts: starts of folded words, or whole ones, weighted by how
much more often labelled texts have them (smoothed log-odds); a longer start is taken only if it says
clearly more than the shorter. Words near a term that keep it from being meant, again by the labels,
make exception phrases, within which the term does not count. A text's hits and its hits by length
go through a logistic curve, fitted to the labels, which gives a probability.

The labelled texts learned from are a bounded sample, about ``TRAIN_ROWS`` chosen by a hash of their
id; Spark counts over them. What goes to the driver is bounded too: ``MAX_TERMS`` terms,
``MAX_PHRASES`` phrases and two numbers of each text of the sample.

Defined results: null counts as empty; an empty text has the score of no hits. Without labels of both
kinds every score is 0. Rows that repeat are scored each; of several labels of an id the largest
holds. Only the named columns are read.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.common import (
    kept_table,
    received,
    row_type,
    sent_by_value,
    ship_by_value,
    sliced,
    text_apart,
    worker_cache,
)

MAX_TERMS = 2_000
MAX_PHRASES = 500
TRAIN_ROWS = 30_000
SHORTEST, LONGEST = 3, 12
LEAST_TEXTS = 5
THRESHOLD = 0.7

# ---- fixed values: characters that look like, or stand for, a Latin letter ----
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j",
    "ѕ": "s", "ԁ": "d", "ӏ": "l", "в": "b", "к": "k", "м": "m", "н": "h", "т": "t",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
               "@": "a", "$": "s", "!": "i", "|": "i", "+": "t"}
# ---- end of fixed values ----

_HOMOGLYPH_TABLE = str.maketrans(HOMOGLYPHS)
_SUBSTITUTE_TABLE = str.maketrans(SUBSTITUTES)
_EDGES = ".,;:!?\"'()[]{}<>|*#&%$-_=~`/\\"


def _fold_word(word: str) -> str:
    """A word in small Latin letters where it looks like them; stops at its ends go."""
    bare = word.strip(_EDGES)
    if not bare.isascii():
        bare = unicodedata.normalize("NFKC", bare).lower()
        if not bare.isascii() and any(c.isascii() and c.isalpha() for c in bare):
            bare = bare.translate(_HOMOGLYPH_TABLE)
        elif any(c in HOMOGLYPHS for c in bare) and all(c in HOMOGLYPHS for c in bare if c.isalpha()):
            bare = bare.translate(_HOMOGLYPH_TABLE)
    if not bare.isalpha() and any(c.isalpha() for c in bare):
        bare = bare.translate(_SUBSTITUTE_TABLE)
        bare = "".join(c for c in bare if c.isalnum())
    return bare


def fold(text: str) -> str:
    """Folded words, each with a space before and after."""
    known = worker_cache("folded-words", dict, "toxicity")
    if len(known) > 300_000:
        known.clear()
    out = []
    for w in text.lower().split():
        f = known.get(w)
        if f is None:
            f = known[w] = _fold_word(w)
        if f:
            out.append(f)
    return f" {' '.join(out)} " if out else " "


@dataclass
class ToxicityModel:
    """Terms begin with a space (the start of a word); those that end with one are whole words."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] | None = None

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for t, w in self.terms.items():
            found.add_word(t, (w, len(t), False))
        for e in self.exceptions:
            found.add_word(e, (0.0, len(e), True))
        if len(found):
            found.make_automaton()
        return found

    def hits(self, folded: str, automaton) -> float:
        """Summed weights: the heaviest term of each word, but none within an exception."""
        if not len(automaton):
            return 0.0
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (weight, size, is_exception) in automaton.iter(folded):
            start = end - size + 1
            if is_exception:
                spared.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        return sum(w for at, w in best.items() if not any(a <= at < b for a, b in spared))

    def score(self, hits: float | np.ndarray, words: float | np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.zeros_like(np.asarray(hits, float))
        z = np.stack([np.ones_like(np.asarray(hits, float)), *features(hits, words)]).T @ np.array(self.curve)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def features(hits, words) -> tuple[np.ndarray, np.ndarray]:
    """Hits, and hits in a thousand words, both damped."""
    hits, words = np.asarray(hits, float), np.asarray(words, float)
    return np.log1p(hits), np.log1p(1000 * hits / (words + 20))


def _starts(folded: str) -> set[str]:
    """The starts of a text's folded words, and the words themselves, as terms."""
    out = set()
    for w in set(folded.split()):
        out.update(f" {w[:n]}" for n in range(SHORTEST, min(len(w), LONGEST) + 1))
        if len(w) >= SHORTEST:
            out.add(f" {w} ")
    return out


def _counted(labelled: DataFrame, parts, kind: str) -> DataFrame:
    """In how many texts of either label each part occurs: ``part``, ``bad``, ``fine``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1024):
            seen: tuple[Counter, Counter] = Counter(), Counter()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                seen[label].update(parts(fold(text or "")))
            keys = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(keys, pa.string()),
                "bad": pa.array([seen[1][k] for k in keys], pa.int64()),
                "fine": pa.array([seen[0][k] for k in keys], pa.int64())})

    counted = labelled.select("text", "toxic").mapInArrow(run, "part string, bad long, fine long")
    return counted.groupBy("part").agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine"))


def _terms(labelled: DataFrame, n_bad: int, n_fine: int) -> dict[str, float]:
    odds = F.log((F.col("bad") + 0.1) / (n_bad + 1)) - F.log((F.col("fine") + 0.5) / (n_fine + 1))
    likely = (
        _counted(labelled, _starts, "term").where(F.col("bad") >= LEAST_TEXTS)
        .select("part", "bad", odds.alias("odds")).where("odds > 2.5")
        .orderBy(F.desc(F.col("odds") * F.log1p("bad")), "part").limit(4 * MAX_TERMS).collect()
    )
    odds_of = {r["part"]: r["odds"] for r in likely}
    bad = {r["part"]: r["bad"] for r in likely}
    # A start that nearly always goes on in one way is left to the longer one.
    goes_on = {p[:n] for p in bad for n in range(1 + SHORTEST, len(p)) if bad[p] >= 0.95 * bad.get(p[:n], np.inf)}
    taken: dict[str, float] = {}
    for part in sorted(odds_of.keys() - goes_on, key=lambda p: (len(p), p)):
        shorter = [odds_of[part[:n]] for n in range(2, len(part)) if part[:n] in taken]
        if not shorter or odds_of[part] > max(shorter) + 1:
            taken[part] = odds_of[part]
    return dict(sorted(taken.items(), key=lambda x: (-x[1], x[0]))[:MAX_TERMS])


def _phrases(labelled: DataFrame, model: ToxicityModel, n_bad: int, n_fine: int) -> list[str]:
    """Two words, one a term, that texts without the label have and texts with it have not."""
    def near(folded: str) -> set[str]:
        automaton = worker_cache(("phrase-terms", tuple(model.terms)), model.automaton, "toxicity")
        words, out = folded.split(), set()
        if not len(automaton) or not any(True for _ in automaton.iter(folded)):
            return out
        for i, w in enumerate(words):
            if any(True for _ in automaton.iter(f" {w} ")):
                out.update(f" {' '.join(p)} " for p in (words[max(0, i - 1): i + 1], words[i: i + 2]) if len(p) == 2)
        return out

    return [r["part"] for r in (
        _counted(labelled, near, "phrase").where((F.col("fine") >= LEAST_TEXTS) & (F.col("bad") == 0))
        .orderBy(F.desc("fine"), "part").limit(MAX_PHRASES).collect())]


def _measured(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``row`` (the columns of ``docs`` but ``text``), ``hits`` and ``score``."""
    sent = sent_by_value(docs.sparkSession, model)  # MAX_TERMS terms, MAX_PHRASES phrases

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = received(sent)
        automaton = lexicon.automaton()
        for batch in sliced(batches):
            folded = [fold(t or "") for t in batch.column("text").to_pylist()]
            hits = np.array([lexicon.hits(t, automaton) for t in folded])
            words = np.array([t.count(" ") - 1 for t in folded], float)
            yield pa.RecordBatch.from_pydict({
                "row": batch.column("row"), "hits": pa.array(hits, pa.float64()),
                "words": pa.array(words, pa.float64()),
                "score": pa.array(np.broadcast_to(lexicon.score(hits, words), hits.shape), pa.float64())})

    apart = text_apart(docs)
    return apart.mapInArrow(run, f"{row_type(apart)}, hits double, words double, score double")


def _curve(hits: np.ndarray, words: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by damped Newton steps with a weak prior."""
    x = np.stack([np.ones(len(y)), *features(hits, words)]).T
    w = np.zeros(3)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + 0.01 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(3)
        w = w - 0.7 * np.linalg.solve(h, g)
    return tuple(map(float, w))


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Learns from ``text`` and the labels ``toxic`` (0 or 1) by ``doc_id``."""
    known = labels.where("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = train_rows / max(1, known.count())
    chance = F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 24)) / (1 << 24)
    sample = known.where(chance < share).limit(train_rows + train_rows // 4)
    # At most 1.25 times train_rows ids and labels.
    labelled = kept_table(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"), "toxic-sample")
    count = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}  # two rows
    if len(count) < 2:
        return ToxicityModel()
    model = ToxicityModel(_terms(labelled, count[1], count[0]))
    model.exceptions = _phrases(labelled, model, count[1], count[0])
    # Ids may repeat in the documents: of their rows no more than twice train_rows come to the driver.
    rows = (
        _measured(labelled, model).select("row.doc_id", "row.toxic", "hits", "words")
        .orderBy(F.xxhash64("doc_id", "hits", "words"), "toxic").limit(2 * train_rows).collect()
    )
    y = np.array([r["toxic"] for r in rows], float)
    model.curve = _curve(np.array([r["hits"] for r in rows]), np.array([r["words"] for r in rows]), y)
    return model


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``row`` (the columns of ``docs`` but ``text``), ``hits``, ``score`` and ``predicted``."""
    return _measured(docs, model).drop("words").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


ship_by_value(__name__)
