"""Byte-level BPE by overlapping chunks.

A text longer than a chunk is dealt out as chunks that overlap. Each chunk is pre-tokenised by
itself, from wherever it happens to begin; where its pre-token boundaries meet those of the chunk
before, the two have come into step, as what follows a boundary does not depend on what precedes
it. The text is cut there, each piece is encoded by itself, and a document's ids are put together in
order. A text that no two neighbours cut alike (a run longer than the overlap) is encoded whole, as
are the texts of a single chunk. Decoding joins the bytes of the ids.

Defined results: null counts as empty and has no ids. Rows that repeat get equal results, one each.
Only ``doc_id`` and ``text`` are read. Special tokens have no meaning in a text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmark.llm.common import digest16, kept_table, ship_by_value, sliced, worker_cache

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 1_024
# What follows the end of a chunk can move boundaries this near to it.
UNSURE_CHARS = 16


def _vocabulary(rank_file: bytes):
    def make():
        return {base64.b64decode(a): int(b) for a, b in
                (line.split() for line in rank_file.splitlines() if line)}
    return worker_cache(("bpe-ranks", hash(rank_file)), make, "bpe")


def _encoder(rank_file: bytes, pattern: str):
    import tiktoken

    def make():
        return tiktoken.Encoding("text", pat_str=pattern, mergeable_ranks=_vocabulary(rank_file),
                                 special_tokens={})
    return worker_cache(("bpe-encoder", pattern, hash(rank_file)), make, "bpe")


def encode_texts(texts: list[str | None], rank_file: bytes, pattern: str) -> list[bytes]:
    import numpy as np

    encode = _encoder(rank_file, pattern).encode_ordinary
    return [np.array(encode(t), "<u4").tobytes() if t else b"" for t in texts]


def decode_ids(ids: list[bytes | None], rank_file: bytes) -> list[bytes | None]:
    import numpy as np

    by_id = worker_cache(("bpe-bytes", hash(rank_file)),
                         lambda: {i: b for b, i in _vocabulary(rank_file).items()}, "bpe")
    return [None if x is None else b"".join(map(by_id.__getitem__, np.frombuffer(x, "<u4").tolist()))
            for x in ids]


def boundaries(text: str, first: int, last: int, pattern: str) -> list[int]:
    """Ends of pre-tokens of ``text`` in [first, last) at which it may be cut.

    Not after white space: there, the end of a piece would make one pre-token of two.
    """
    import regex

    compiled = worker_cache(("bpe-pattern", pattern), lambda: regex.compile(pattern))
    found = []
    for match in compiled.finditer(text):
        at = match.end()
        if at >= last:
            break
        if at >= first and not text[at - 1].isspace():
            found.append(at)
    return found


def _encoded(texts: DataFrame, rank_file, pattern: str, decoded: bool) -> DataFrame:
    """``text`` replaced by ``ids`` and ``decoded``, what they decode to, null unless asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids = encode_texts(batch.column("text").to_pylist(), rank_file.value, pattern)
            back = decode_ids(ids, rank_file.value) if decoded else [None] * len(ids)
            rest = {n: batch.column(n) for n in batch.schema.names if n != "text"}
            yield pa.RecordBatch.from_pydict(
                rest | {"ids": pa.array(ids, pa.binary()), "decoded": pa.array(back, pa.binary())})

    rest = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.schema if f.name != "text")
    return texts.mapInArrow(run, f"{rest}, ids binary, decoded binary")


def _chunks(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    starts = F.sequence(F.lit(0), F.char_length("text") - 1, F.lit(chunk))
    return long.select("key", "text", F.posexplode(starts).alias("n", "start")).select(
        "key", "n", F.col("text").substr(F.col("start") + 1, F.lit(chunk + overlap)).alias("text"),
    ).dropDuplicates(["key", "n"])


def _cuts(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Where in chunk ``n`` its piece begins and ends; null where neighbours are not in step."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column("text").to_pylist()
            head, tail = [], []
            for t in texts:
                found = boundaries(t, 0, len(t) if len(t) <= chunk else len(t) - UNSURE_CHARS, pattern)
                head.append([x for x in found if x < overlap])
                tail.append([x - chunk for x in found if x >= chunk])
            kind = pa.list_(pa.int32())
            names = ["key", "n", "head", "tail"]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n"), pa.array(head, kind), pa.array(tail, kind)],
                names=names)

    edges = chunks.mapInArrow(run, "key binary, n int, head array<int>, tail array<int>")
    doc = Window.partitionBy("key").orderBy("n")
    met = F.array_min(F.array_intersect("tail", F.lead("head").over(doc)))
    ends = edges.select("key", "n", F.lead("n").over(doc).isNull().alias("last"), met.alias("met"))
    return ends.select(
        "key", "n", "last", F.coalesce(F.lag("met").over(doc), F.lit(0)).alias("begin"),
        F.when(~F.col("last"), F.col("met") + chunk).alias("end"),
        F.max(~F.col("last") & F.col("met").isNull()).over(Window.partitionBy("key")).alias("unmet"))


def encode(docs: DataFrame, rank_path: str, pattern: str, chunk: int = CHUNK_CHARS,
           overlap: int = OVERLAP_CHARS, decoded: bool = False) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit) of every row of ``docs``, and if asked
    ``decoded``, the bytes that they decode to.

    ``rank_path`` is a file of ranks on the driver, which all executors get (about 1 MB).
    """
    with open(rank_path, "rb") as f:
        rank_file = docs.sparkSession.sparkContext.broadcast(f.read())
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    is_long = F.char_length("text") > chunk
    short = _encoded(texts.where(~is_long), rank_file, pattern, decoded)
    long = texts.where(is_long).select("doc_id", "text", digest16(F.col("text")).alias("key"))
    chunks = _chunks(long, chunk, overlap)
    cuts = kept_table(_cuts(chunks, pattern, chunk, overlap), "bpe-cuts")
    pieces = chunks.join(cuts.where(~F.col("unmet")), ["key", "n"]).select(
        "key", "n",
        F.when(F.col("last"), F.col("text").substr(F.col("begin") + 1, F.lit(chunk + overlap)))
        .otherwise(F.col("text").substr(F.col("begin") + 1, F.col("end") - F.col("begin"))).alias("text"))
    joined = _encoded(pieces, rank_file, pattern, decoded).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("n", "ids", "decoded"))).alias("parts")).select(
        "key", *[F.aggregate(f"parts.{c}", F.lit(b""), lambda a, x: F.concat(a, x)).alias(c)
                 for c in ("ids", "decoded")])
    unmet = cuts.where("unmet and last").select("key")
    whole = _encoded(long.join(unmet, "key", "left_semi").select("doc_id", "text"), rank_file,
                     pattern, decoded)
    in_parts = long.select("doc_id", "key").join(joined, "key").select("doc_id", "ids", "decoded")
    out = short.unionByName(in_parts).unionByName(whole)
    return out if decoded else out.drop("decoded")


def decode(encoded: DataFrame, rank_path: str) -> DataFrame:
    """``decoded`` (bytes) beside the columns of ``encoded``; null ids give null."""
    with open(rank_path, "rb") as f:
        rank_file = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = decode_ids(batch.column("ids").to_pylist(), rank_file.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    rest = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{rest}, decoded binary")


ship_by_value(__name__)
