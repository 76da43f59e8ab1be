"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm import (
    alignment,
    bpe,
    exact_dedup,
    langid,
    line_dedup,
    near_dedup,
    packing,
    prefix_trie,
    pu_quality,
    quality,
    secret_scan,
    substring_dedup,
    toxicity,
)
from tillmark.llm.common import documents, for_texts, sha256_hex, table_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(for_texts(spark), sf_dir)
    return fn


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines kept and removed, with the digest of what stays, for every document."""
    return line_dedup.dedup_lines(documents(spark, sf_dir)).select(
        "row.doc_id", "n_lines", "n_removed", "n_runs", "copied_lines",
        sha256_hex(F.coalesce("kept_text", F.lit(""))).alias("kept_sha256"),
    )


ORACLES["op1_line_dedup"] = r"""
WITH all_lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS line_no
  FROM documents
), worded AS (
  SELECT doc_id, line_no, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
         row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pos
  FROM all_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), summed AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM worded
), sized AS (
  SELECT a.doc_id, a.pos AS a, min(b.pos) AS b FROM summed a JOIN summed b
  ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.pos < a.pos + 5 AND b.upto - a.upto + a.words >= 5
  GROUP BY ALL
  UNION
  SELECT b.doc_id, max(a.pos) AS a, b.pos AS b FROM summed a JOIN summed b
  ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.pos < a.pos + 5 AND b.upto - a.upto + a.words >= 5
  GROUP BY ALL
), content AS (
  SELECT w.doc_id, w.a, w.b, string_agg(s.line, chr(10) ORDER BY s.pos) AS run
  FROM sized w JOIN summed s ON s.doc_id = w.doc_id AND s.pos BETWEEN w.a AND w.b GROUP BY ALL
), later AS (
  SELECT * FROM content QUALIFY (doc_id, a) <> min((doc_id, a)) OVER (PARTITION BY run)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS pos FROM later
), doubled AS (
  SELECT k.m, s.doc_id, s.pos, list(s.line) OVER (PARTITION BY k.m, s.doc_id ORDER BY s.pos
         ROWS BETWEEN CURRENT ROW AND k.m - 1 FOLLOWING) AS run
  FROM summed s, (SELECT CAST(pow(2, e) AS BIGINT) AS m FROM range(32) r(e) WHERE pow(2, e) <=
    (SELECT max(n) FROM (SELECT count(*) AS n FROM summed GROUP BY doc_id))) k
), copied AS (
  SELECT doc_id, max(m) AS m FROM (
    SELECT * FROM doubled WHERE len(run) = m
    QUALIFY (doc_id, pos) <> min((doc_id, pos)) OVER (PARTITION BY m, run)) GROUP BY doc_id
), kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.line_no) AS kept
  FROM all_lines l LEFT JOIN worded w ON w.doc_id = l.doc_id AND w.line_no = l.line_no
  LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.pos = w.pos
  WHERE g.doc_id IS NULL GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce((SELECT count(*) FROM worded w WHERE w.doc_id = d.doc_id), 0) AS n_lines,
       coalesce((SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id), 0) AS n_removed,
       coalesce((SELECT count(*) FROM gone g ANTI JOIN gone b ON b.doc_id = g.doc_id AND b.pos = g.pos - 1
                 WHERE g.doc_id = d.doc_id), 0) AS n_runs,
       coalesce(c.m, 0) AS copied_lines, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN copied c USING (doc_id)
"""


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of equal texts stays, for every document."""
    return exact_dedup.exact_duplicates(spark, table_path(sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


ORACLES["op8_exact_dedup"] = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and the bytes they decode to, as digests."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN, decoded=True)
    return encoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 4096 tokens."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(documents(spark, sf_dir), tokenizer).drop("ids")


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a network trained on those that are not held out."""
    docs = documents(spark, sf_dir)
    model = langid.train(docs.where(~langid.held_out()))
    return langid.identify(docs, model).select(
        "row.doc_id", langid.held_out("row.doc_id").alias("held_out"), "lang_pred", "score")


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: by fixed patterns, and those a network adds."""
    docs = documents(spark, sf_dir)
    return secret_scan.counts(secret_scan.scan(docs, secret_scan.train(docs)))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and the verdict of weighed votes for every document."""
    return quality.judged(documents(spark, sf_dir).select("doc_id", "text")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "posterior")


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by a lexicon learned from labels that are not held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = langid.held_out(folds=3, fold=1)
    labels = spark.read.parquet(table_path(sf_dir, "labels")).where(~held_out)
    model = toxicity.train(docs, labels)
    return toxicity.score(docs, model).select(
        "row.doc_id", langid.held_out("row.doc_id", 3, 1).alias("held_out"), "score", "predicted", "hits")


@query
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document, and whether it is the one that stays."""
    return near_dedup.near_duplicates(documents(spark, sf_dir)).drop("key", "txt")


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words kept and removed, with the digest of what stays, for every document."""
    return substring_dedup.dedup_substrings(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", sha256_hex(F.col("kept")).alias("kept_sha256"))


ORACLES["op2_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, unnest(range(1, len(words) - 18)) AS a FROM d WHERE len(words) >= 20
), windows AS (
  SELECT doc_id, a, hash(array_to_string(words[a : a + 19], ' ')) AS h1,
         md5(array_to_string(words[a : a + 19], ' ')) AS h2
  FROM starts JOIN d USING (doc_id)
), firsts AS (
  SELECT h2, min((doc_id, a)) AS place, count(*) AS n FROM windows GROUP BY h2 HAVING count(*) > 1
), later AS (
  SELECT doc_id, a FROM windows JOIN firsts USING (h2) WHERE (doc_id, a) <> place
), gone AS (
  SELECT doc_id, list(DISTINCT pos) AS gone
  FROM (SELECT doc_id, unnest(range(a, a + 20)) AS pos FROM later) GROUP BY doc_id
), kept AS (
  SELECT doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
         list_filter(words, lambda w, i: gone IS NULL OR NOT list_contains(gone, i)) AS kept
  FROM d LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
FROM kept
"""


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers lie over each other, for every document."""
    aligned = alignment.align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                              public_tokenizers.path("piece_bpe_32k.model"), groups="sha256")
    return aligned.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                          F.col("groups").alias("groups_sha256"))


@query
def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from good ones that are not held out and unlabelled ones."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(table_path(sf_dir, "labels"))
    model = pu_quality.train(docs, labels, trusted=~langid.held_out(folds=4, fold=2))
    return pu_quality.score(docs, model).select(
        "row.doc_id", langid.held_out("row.doc_id", 4, 2).alias("held_out"), "score", "predicted")


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    return prefix_trie.conversation_trie(spark.read.parquet(table_path(sf_dir, "conversations")))


# An id's hash is made a byte of its digits at a time, eight steps a byte.
ORACLES["op11_prefix_trie"] = """
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) - 1 AS pos, key, size
  FROM (SELECT conv_id, turn, strlen(coalesce(text, '')) AS size,
               sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key
        FROM conversations WHERE conv_id IS NOT NULL)
), hashed AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)) AS crc
  FROM (SELECT DISTINCT conv_id FROM own)
), ids AS (
  SELECT conv_id, base, xor(crc, 4294967295::BIGINT) % 9 AS h FROM hashed
), taken AS (
  SELECT i.conv_id, o.pos, o.key, o.size FROM ids i JOIN own o ON o.conv_id = i.base WHERE o.pos < i.h
), turns AS (
  SELECT * FROM taken
  UNION ALL
  SELECT o.conv_id, o.pos - i.h + (SELECT count(*) FROM taken t WHERE t.conv_id = i.conv_id), o.key, o.size
  FROM own o JOIN ids i USING (conv_id) WHERE o.pos >= i.h
), member AS (
  SELECT conv_id, 0 AS depth, '' AS prefix, 0 AS size FROM ids
  UNION ALL
  SELECT conv_id, pos + 1, string_agg(key, ',') OVER (PARTITION BY conv_id ORDER BY pos), size FROM turns
), last AS (
  SELECT conv_id, max(depth) AS depth FROM member GROUP BY conv_id
), node AS (
  SELECT prefix, m.depth, min(m.conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved,
         string_agg(CASE WHEN l.depth = m.depth THEN m.conv_id::VARCHAR END, ',' ORDER BY m.conv_id) AS ends
  FROM member m JOIN last l USING (conv_id) GROUP BY prefix, m.depth
), parented AS (
  SELECT n.*, up.prefix AS parent, up.conv_id AS parent_conv_id,
         NOT EXISTS (SELECT 1 FROM member m JOIN member b ON b.conv_id = m.conv_id AND b.depth = m.depth + 1
                     WHERE m.prefix = n.prefix AND m.depth = n.depth) AS leaf
  FROM node n LEFT JOIN member m ON m.conv_id = n.conv_id AND m.depth = n.depth - 1
  LEFT JOIN node up ON up.prefix = m.prefix AND up.depth = m.depth
), below AS (
  SELECT m.prefix, m.depth, sum(u.leaf::INT) AS n_leaves, sum(u.saved) AS saved_tokens,
         count(*) FILTER (u.depth = m.depth + 1) AS n_children
  FROM member m JOIN parented u ON u.conv_id = m.conv_id AND u.depth >= m.depth GROUP BY ALL
)
SELECT p.conv_id, p.depth, p.parent_conv_id, p.n_convs, b.n_children, b.n_leaves::BIGINT AS n_leaves,
       b.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(p.ends, '')) AS ends_sha256
FROM parented p JOIN below b USING (prefix, depth)
"""
