"""Language identification by a byte convolutional network.

A whole text is cut into windows of a fixed number of bytes, the last filled up with zeros. The
network gives each window a probability per language; a text's are their mean, weighted by the
bytes of the windows. It is trained on the driver on a bounded sample: for each language (the
``MAX_LANGUAGES`` most frequent), windows spread over about ``DOCS_A_LANGUAGE`` texts chosen by a
hash of their id.

Defined results: ``und`` with score 0 for null texts, texts without a letter, and all texts when
there was nothing to learn from. Rows that repeat are judged each. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.cnn import ByteNetwork
from tillmark.llm.common import (
    received,
    row_type,
    sent_by_value,
    ship_by_value,
    sliced,
    text_apart,
)
from tillmark.llm.kernel import Texts, small_batches

WINDOW_BYTES = 256
DOCS_A_LANGUAGE = 400
WINDOWS_A_DOC = 4
MAX_LANGUAGES = 200
UNDETERMINED = "und"

_LATIN = re.compile(r"[A-Za-z]")


@dataclass
class LanguageModel:
    languages: list[str]
    network: ByteNetwork | None


def _window(text: bytes) -> np.ndarray:
    x = np.zeros(WINDOW_BYTES, np.uint8)
    part = np.frombuffer(text[:WINDOW_BYTES], np.uint8)
    x[: len(part)] = part
    return x


def train(docs: DataFrame, docs_a_language: int = DOCS_A_LANGUAGE) -> LanguageModel:
    """Learns from ``text`` and ``lang`` of the rows of ``docs`` that have both."""
    labelled = docs.where("lang IS NOT NULL AND length(text) > 0").select("doc_id", "lang", "text")
    counts = (
        labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()  # bounded by MAX_LANGUAGES
    )
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        return LanguageModel([], None)
    share = F.coalesce(*[F.when(F.col("lang") == r["lang"], F.lit(docs_a_language / r["n"])) for r in counts])
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 24)) / (1 << 24)
    spread = F.sequence(F.lit(0), F.lit(WINDOWS_A_DOC - 1))
    size = F.char_length("text")
    windows = F.array_distinct(F.transform(spread, lambda k: F.col("text").substr(
        F.floor(size * k / WINDOWS_A_DOC).cast("int") + 1, F.lit(WINDOW_BYTES))))
    sample = labelled.where(chance < share).select(
        "lang", F.explode(windows).alias("part"), F.xxhash64("doc_id").alias("h"))
    limit = 2 * docs_a_language * WINDOWS_A_DOC * len(languages)  # the chance may give a few more
    rows = sample.orderBy("h", "lang", "part").limit(limit).collect()
    x = np.stack([_window(r["part"].encode()) for r in rows]) if rows else np.zeros((0, WINDOW_BYTES), np.uint8)
    number = {lang: i for i, lang in enumerate(languages)}
    y = np.array([number[r["lang"]] for r in rows], np.int64)
    # Short texts are judged too: half of the windows are also shown cut short.
    short = x[::2].copy()
    for i, row in enumerate(short):
        row[8 + (i * 37) % (WINDOW_BYTES - 8):] = 0
    x, y = np.concatenate([x, short]), np.concatenate([y, y[::2]])
    per_class = np.bincount(y, minlength=len(languages))
    weights = 1.0 / np.maximum(per_class[y], 1)
    return LanguageModel(languages, ByteNetwork(len(languages)).train(x, y, weights=weights * len(y)))


def judge(texts: Texts, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Number of the likeliest language and its probability; -1 for an empty text."""
    lengths = np.diff(texts.off)
    n_windows = -(-lengths // WINDOW_BYTES)
    best, score = np.full(texts.rows, -1), np.zeros(texts.rows)
    if not n_windows.sum():
        return best, score
    row = np.repeat(np.arange(texts.rows), n_windows)
    first = np.concatenate([[0], np.cumsum(n_windows)])
    begin = texts.off[row] + (np.arange(len(row)) - first[row]) * WINDOW_BYTES
    size = np.minimum(texts.off[row + 1] - begin, WINDOW_BYTES)
    padded = np.concatenate([texts.buf, np.zeros(WINDOW_BYTES, np.uint8)])
    view = np.lib.stride_tricks.sliding_window_view(padded, WINDOW_BYTES)
    total = np.zeros((texts.rows, len(model.languages)))
    for i in range(0, len(row), 2048):
        x = view[begin[i: i + 2048]]
        x[np.arange(WINDOW_BYTES) >= size[i: i + 2048, None]] = 0
        np.add.at(total, row[i: i + 2048],
                  model.network.probabilities(x) * size[i: i + 2048, None])
    some = lengths > 0
    total[some] /= lengths[some, None]
    best[some] = total[some].argmax(1)
    score[some] = np.clip(total[some].max(1), 0, 1)
    return best, score


def _has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_LATIN.search(text)) or any(c.isalpha() for c in text))


def identify(docs: DataFrame, model: LanguageModel, with_text: bool = False) -> DataFrame:
    """``row`` (the columns of ``docs`` but ``text``), ``lang_pred`` and ``score``; ``text`` if asked."""
    sent = sent_by_value(docs.sparkSession, model)  # the network: under 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = received(sent)
        for batch in sliced(batches):
            text = batch.column("text")
            lang, score = [], []
            for at, part in small_batches(text):
                found, value = (judge(part, net) if net.network is not None
                                else (np.full(part.rows, -1), np.zeros(part.rows)))
                for i in range(part.rows):
                    known = found[i] >= 0 and _has_letter(text[at + i].as_py())
                    lang.append(net.languages[found[i]] if known else UNDETERMINED)
                    score.append(float(value[i]) if known else 0.0)
            back = {"row": batch.column("row")} | ({"text": text} if with_text else {})
            yield pa.RecordBatch.from_pydict(
                back | {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64())})

    apart = text_apart(docs)
    kept = row_type(apart) + (", text string" if with_text else "")
    return apart.mapInArrow(run, f"{kept}, lang_pred string, score double")


def held_out(doc_id: str = "doc_id", folds: int = 5, fold: int = 0):
    """Whether crc32 of the id as text leaves ``fold``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


ship_by_value(__name__)
