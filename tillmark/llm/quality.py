"""Quality by weak supervision: rules vote or abstain, and what they are worth is estimated.

Each rule says good, bad or nothing of a text. Nobody tells which texts are good: the rules'
accuracies and the share of good texts are what makes the votes seen most likely (expectation-
maximisation, rules independent given the quality), and a text's quality is its posterior. The
likelihood needs only how often each pattern of votes occurs: at most 3 to the number of rules, so
that one small table, counted over all texts, goes to the driver, whatever the number of texts.

Words are separated by space, tab, line feed, vertical tab, form feed and carriage return only.
Defined results: null counts as empty, with all counts 0, and fails the base rule. Rows that repeat
are judged each. Only the named columns are read. With no texts there is nothing to estimate.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.llm.common import (
    TEXTS_A_BATCH,
    kept_table,
    row_type,
    ship_by_value,
    sliced,
    text_apart,
)
from tillmark.llm.kernel import Texts, mix, rows_of, same_row, small_batches, window_hashes

GOOD, BAD, ABSTAIN = 1, 0, -1
SYMBOLS = b"#*$%&|<>"

#: Facts of a text that the rules read.
FACTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
         "n_ended_lines", "n_upper", "n_letters", "n_distinct_words", "n_letter_words")


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which of the keys occur more than once."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ordered[1:] == ordered[:-1]
    out = np.empty(len(keys), bool)
    out[order] = same[1:] | same[:-1]
    return out


def _later(keys: np.ndarray) -> np.ndarray:
    """Which of the keys also occur at an earlier place."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    out = np.zeros(len(keys), bool)
    out[order[1:]] = ordered[1:] == ordered[:-1]
    return out


def facts(texts: Texts) -> dict[str, np.ndarray]:
    """The facts of each text, as whole numbers."""
    b, n = texts.buf, texts.rows

    def per_text(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return sums[texts.off[1:]] - sums[texts.off[:-1]]

    starts, ends, first = texts.words()
    rows = rows_of(first)
    words = texts.hashes(starts, ends)
    gap = (b == 32) | ((b >= 9) & (b <= 13))
    out = {"n_words": np.diff(first), "word_chars": per_text(~gap & ((b & 0xC0) != 0x80)),
           "n_symbols": per_text(np.isin(b, np.frombuffer(SYMBOLS, np.uint8)))}

    salt = mix(np.arange(n, dtype=np.uint64) + np.uint64(1))
    within = same_row(rows, 3)
    triples = window_hashes(words, 3) ^ salt[rows[: max(0, len(rows) - 2)]]
    at = np.flatnonzero(within)[_repeated(triples[within])] if within.any() else np.zeros(0, int)
    covered = np.zeros(len(rows), bool)
    for j in range(3):
        covered[at + j] = True
    out["n_repeat_words"] = np.bincount(rows[covered], minlength=n)
    out["n_distinct_words"] = np.bincount(rows[~_later(words ^ salt[rows])], minlength=n)

    # A line with a word: the stretch between line feeds around it.
    begins, stops, line_first = texts.pieces(b == 10)
    line_rows = rows_of(line_first)
    in_line = np.searchsorted(begins, starts, "right") - 1
    worded = np.zeros(len(begins), bool)
    worded[in_line] = True
    line_keys = texts.hashes(begins, stops) ^ salt[line_rows]
    out["n_lines"] = np.bincount(line_rows[worded], minlength=n)
    dup = np.zeros(len(begins), bool)
    dup[np.flatnonzero(worded)[_later(line_keys[worded])]] = True
    out["n_dup_lines"] = np.bincount(line_rows[dup], minlength=n)
    last_word = np.full(len(begins), -1)
    last_word[in_line] = np.arange(len(starts))  # the last assignment stays
    ended = worded.copy()
    ended[worded] = np.isin(b[ends[last_word[worded]] - 1], np.frombuffer(b".!?\"'):;", np.uint8))
    out["n_ended_lines"] = np.bincount(line_rows[ended], minlength=n)

    upper = (b >= 65) & (b <= 90)
    letter = upper | ((b >= 97) & (b <= 122))
    out["n_upper"], out["n_letters"] = per_text(upper), per_text(letter)
    # Bytes beyond ASCII count as letters here, so that every script has words of letters.
    up_to = np.concatenate([[0], np.cumsum(letter | (b >= 128))])
    out["n_letter_words"] = np.bincount(rows[up_to[ends] > up_to[starts]], minlength=n)
    return out


def with_facts(docs: DataFrame) -> DataFrame:
    """``row`` (the columns of ``docs`` but ``text``) and the facts of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, TEXTS_A_BATCH):
            parts = [facts(t) for _, t in small_batches(batch.column("text"))]
            found = [pa.array(np.concatenate([p[f] for p in parts]) if parts else [], pa.int64())
                     for f in FACTS]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *found], names=["row", *FACTS])

    apart = text_apart(docs)
    return apart.mapInArrow(run, f"{row_type(apart)}, " + ", ".join(f"{f} long" for f in FACTS))


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def rules() -> Mapping[str, Column]:
    """The rules: a vote of each, from the facts of a text.

    A rule that looks for a fault says nothing of a text without it; only the last two find merits.
    """
    symbols, dups = _share("n_symbols", "n_words"), _share("n_dup_lines", "n_lines")
    repeats, length = _share("n_repeat_words", "n_words"), _share("word_chars", "n_words")
    upper, ended = _share("n_upper", "n_letters"), _share("n_ended_lines", "n_lines")
    distinct, n = _share("n_distinct_words", "n_words"), F.col("n_words")
    letters = _share("n_letter_words", "n_words")
    faults = {
        "too_short": n < 50,
        "symbols": symbols > 0.1,
        "repeated_lines": (dups > 0.3) & (F.col("n_lines") >= 6),
        "repeated_words": repeats > 0.3,
        "odd_word_length": ~length.between(3, 10),
        "shouted": upper > 0.3,
        "words_without_letters": letters < 0.8,
        "few_words": (distinct < 0.1) & (n < 5000),
        "lines_do_not_end": (ended < 0.1) & (n >= 20),
    }
    merits = {
        "plain": (symbols < 0.05) & (upper < 0.2) & (letters >= 0.8),
        "varied": (repeats <= 0.3) & (dups <= 0.3) & (n >= 50),
    }
    return (
        {k: F.when(f, BAD).otherwise(ABSTAIN) for k, f in faults.items()}
        | {k: F.when(f, GOOD).otherwise(ABSTAIN) for k, f in merits.items()}
    )


@dataclass
class VoteModel:
    """``good_share``, and per rule the chance of nothing, bad and good for bad and good texts."""

    good_share: float
    chances: np.ndarray  # [rule, quality, vote + 1]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance that a text is good, for rows of votes."""
        log = np.log(self.chances)
        like = np.stack([sum(log[r, q, votes[:, r] + 1] for r in range(votes.shape[1])) for q in (0, 1)])
        like += np.log([[1 - self.good_share], [self.good_share]])
        return 1 / (1 + np.exp(np.clip(like[0] - like[1], -500, 500)))


#: What is taken to be known of a rule before any text is seen: chances of nothing, bad and good,
#: for bad and for good texts. A fault is seldom found in a good text; merits are found in bad ones.
PRIOR = np.array([[0.50, 0.30, 0.20], [0.49, 0.01, 0.50]])


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 200, prior: float = 20.0) -> VoteModel:
    """Expectation-maximisation over vote patterns and how often they occur.

    The prior weighs as much as ``prior`` in 1000 texts. It keeps the two qualities from changing
    places, and gives rules that never vote an estimate.
    """
    n_rules = votes.shape[1]
    share = counts / counts.sum()
    pseudo = prior / 1000 * PRIOR
    model = VoteModel(0.7, np.repeat(PRIOR[None], n_rules, 0))
    for _ in range(rounds):
        good = model.posterior(votes)
        chances = np.empty_like(model.chances)
        for q, mass in enumerate((share * (1 - good), share * good)):
            for r in range(n_rules):
                got = np.bincount(votes[:, r] + 1, weights=mass, minlength=3) + pseudo[q]
                chances[r, q] = got / got.sum()
        new = VoteModel(float(np.clip((share * good).sum(), 0.05, 0.99)), chances)
        done = abs(new.good_share - model.good_share) < 1e-9 and np.allclose(new.chances, model.chances, atol=1e-9)
        model = new
        if done:
            break
    return model


def judged(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``row`` (the columns of ``docs`` but ``text``), the facts, ``base_failed``, ``posterior``, ``kept``."""
    named = rules()
    votes = [v.cast("int").alias(f"vote_{k}") for k, v in named.items()]
    voted = kept_table(with_facts(docs).select("*", *votes), "votes")
    names = [f"vote_{k}" for k in named]
    patterns = voted.groupBy(*names).count().collect()  # 3 ** len(rules) rows at most
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    if not patterns:
        return voted.select("row", *FACTS, base_failed.alias("base_failed"),
                            F.lit(0.0).alias("posterior"), F.lit(False).alias("kept"))
    seen = np.array([[r[c] for c in names] for r in patterns])
    posterior = estimate(seen, np.array([r["count"] for r in patterns], float)).posterior(seen)
    table = docs.sparkSession.createDataFrame(
        [(*map(int, v), float(p)) for v, p in zip(seen, posterior, strict=True)],
        ", ".join(f"{c} int" for c in names) + ", posterior double")
    scored = voted.join(F.broadcast(table), names)  # at most 3 ** len(rules) rows
    return scored.select(
        "row", *FACTS, base_failed.alias("base_failed"), "posterior",
        (~base_failed & (F.col("posterior") >= least)).alias("kept"))


ship_by_value(__name__)
