"""From raw documents to packed sequences: five stages, each a table read by the next.

Every stage but the last returns the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm import langid, line_dedup, near_dedup, packing, secret_scan
from tillmark.llm.common import documents, for_texts, kept_table

#: A text whose likeliest language is less likely than this is not taken for any.
LEAST_LANGUAGE_SCORE = 0.3
#: Fewer words than packing remembers by itself: here its tasks follow others in the same executors.
REMEMBERED = (200_000, 150_000)


def _with_text(df: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """The columns of ``documents`` from ``row`` and the new text."""
    new = {"text": F.col(text), "n_chars": F.char_length(text).cast("bigint")}
    return df.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language: those without a letter, or unlike any language learned, go."""
    for_texts(spark)
    model = langid.train(docs)
    judged = langid.identify(docs, model, with_text=True)
    sure = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return _with_text(judged.where(sure), "text", docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of repeated line runs; documents of which no line is left go."""
    deduped = line_dedup.dedup_lines(docs)
    left = (F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))
    return _with_text(deduped.where(left), "kept_text", docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: the one with the least id."""
    for_texts(spark)
    stay = near_dedup.near_duplicates(docs).where("kept").select("key", "txt").distinct()
    keyed = docs.select(F.struct("*").alias("row"), *near_dedup.text_key("doc_id", "text"))
    # Rows that repeat a document are one document: its key tells no more of them than one.
    one = keyed.join(stay, ["key", "txt"], "left_semi").dropDuplicates(["key", "txt"])
    return one.select("row.*")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces found secrets in the texts; every document stays."""
    for_texts(spark)
    scanned = secret_scan.scan(docs, secret_scan.train(docs), redact=True)
    return _with_text(scanned, "text", docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences for training: a row per piece, with its ids."""
    for_texts(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True,
                        remembered=REMEMBERED)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("secrets", secrets),
    ("sequences", sequences),
]

#: Networks and samples of weights cannot be said in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = kept_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
