"""Alignment of the tokens of two tokenizers over the same texts.

Every text, with a space before it, is encoded by both; a token is a range of its bytes. Per batch,
``pandas.merge_asof`` keyed by document finds for the start of each token the other side's token that
covers it; both directions together are all pairs whose ranges overlap (links). Offsets at which
tokens of both sides end cut them into groups.

How many documents of the corpus hold a pair of ids linked is counted by Spark. A task hands on, for
each unit (some documents, about ``UNIT_BYTES``), the distinct pairs of the unit with the number of its
documents that hold them, and for each document places in that list; the counts are summed by pair and
come back by unit, so that no pair is shuffled once for each document.

Both tokenizers break at a space or line feed that follows something else, so texts are encoded by the
stretches between, most of which recur and are remembered. Where a vocabulary has an entry across such a
break, whole texts are encoded.

Defined results: texts that are null or empty, or of which either tokenizer does not give back the
bytes, have no tokens: all numbers 0 and ``groups`` empty. Rows that repeat are documents each. Other
columns come back in ``row``, whatever their names. An empty table gives no rows. What a task holds is
some times a unit, or the longest text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.common import (
    kept_table,
    row_type,
    ship_by_value,
    sliced,
    text_apart,
    worker_cache,
)

UNIT_BYTES = 1 << 21
#: Stretches a task remembers, some 300 bytes each.
REMEMBERED = 600_000

_BREAK = re.compile(r"(?<=\S)(?=[ \n])")
_ACROSS = re.compile(r"\S[ \n]")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def _byte_of_letter() -> dict[str, int]:
    """The bytes that letters stand for in a byte-level vocabulary: printable ones for themselves."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """The side of a ``tokenizers`` file with a byte-level vocabulary."""

    def __init__(self, definition: str):
        import public_tokenizers
        import tiktoken

        parsed = json.loads(definition)
        special = {t["content"] for t in parsed["added_tokens"]}
        letters = _byte_of_letter()
        vocabulary = {k: i for k, i in parsed["model"]["vocab"].items() if k not in special}
        spelled = {bytes(letters[c] for c in k): i for k, i in vocabulary.items()}
        self.bytes = [b""] * (1 + max(spelled.values()))
        for k, i in spelled.items():
            self.bytes[i] = k
        self.across = any(_ACROSS.search(k.decode(errors="replace")) for k in spelled)
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in parsed["model"]["merges"]]
        if all(vocabulary.get(m) == 256 + i for i, m in enumerate(merged)):
            # Ids are in the order of the merges, so the quicker engine does the same by ranks.
            self.ids = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN,
                                         mergeable_ranks=spelled, special_tokens={}).encode_ordinary
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            whole = Tokenizer.from_str(definition)
            whole.encode_special_tokens = True
            self.ids = lambda text: whole.encode(text, add_special_tokens=False).ids

    def encode(self, stretches: list[str]) -> list[list[int]]:
        return [self.ids(s) for s in stretches]


class Pieces:
    """The side of a ``sentencepiece`` model that puts a space before what it is given."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = []
        for i, p in enumerate(pieces):
            one = _BYTE_PIECE.fullmatch(p) if self.model.is_byte(i) else None
            self.bytes.append(bytes([int(one[1], 16)]) if one else p.replace("▁", " ").encode())
        self.across = any(_ACROSS.search(x.decode(errors="replace")) for x in self.bytes)
        self.space = self.model.piece_to_id("▁")

    def encode(self, stretches: list[str]) -> list[list[int] | None]:
        # The space that the model adds is the stretch's own, or a piece by itself before a line feed.
        made = self.model.encode([s.removeprefix(" ") for s in stretches], num_threads=1)
        out = []
        for s, ids in zip(stretches, made, strict=True):
            if s == " ":
                ids = [self.space]
            elif s[0] != " ":
                ids = ids[1:] if ids[:1] == [self.space] else None
            out.append(ids)
        return out


class Sides:
    """Both tokenizers, and what they make of stretches seen before.

    The first ``remembered`` stretches stay: frequent ones are soon among them. When four times as many
    others have come since, the texts have changed, and it starts anew.
    """

    def __init__(self, definition: str, model: bytes, remembered: int = REMEMBERED):
        self.both = ByteLevel(definition), Pieces(model)
        self.in_stretches = not any(side.across for side in self.both)
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.limit, self.refused = remembered, 0
        self.sizes = [np.array([len(x) for x in side.bytes], np.int64) for side in self.both]
        # Ids as decimals, followed by a comma or by what ends a side's part of a group.
        self.names = [np.array([f"{i}{c}" for c in (",", stop) for i in range(len(side.bytes))], object)
                      for side, stop in zip(self.both, "|;", strict=True)]

    def _encode(self, stretches: list[str]) -> dict[str, tuple[bytes, bytes] | None]:
        """Ids of both sides; nothing for a stretch of which a side does not give back the bytes."""
        out: dict[str, tuple[bytes, bytes] | None] = {}
        for s, *sides in zip(stretches, *[side.encode(stretches) for side in self.both], strict=True):
            own = s.encode()
            whole = all(ids is not None and b"".join(map(side.bytes.__getitem__, ids)) == own
                        for side, ids in zip(self.both, sides, strict=True))
            out[s] = (array("I", sides[0]).tobytes(), array("I", sides[1]).tobytes()) if whole else None
        return out

    def _found(self, stretches: list[str]) -> list[tuple[bytes, bytes] | None]:
        lacking = [s for s in stretches if s not in self.known]
        made = self._encode(lacking)
        if len(self.known) < self.limit:
            self.known.update(made)
        else:
            self.refused += len(made)
        found = [made[s] if s in made else self.known[s] for s in stretches]
        if self.refused > 4 * self.limit:
            self.known, self.refused = {}, 0
        return found

    def tokens(self, texts: list[str | None]) -> tuple[Tokens, Tokens]:
        """The tokens of both sides; none of a text that either does not give back."""
        number: dict[str, int] = {}
        codes: list[int] = []
        until = [0]
        for text in texts:
            if text and "\u2581" not in text:  # that sign comes back as a space
                spaced = " " + text
                parts = _BREAK.split(spaced) if self.in_stretches else [spaced]
                codes.extend([number.setdefault(s, len(number)) for s in parts])
            until.append(len(codes))
        found = self._found(list(number))
        stretch, doc = np.array(codes, np.int64), np.repeat(np.arange(len(texts)), np.diff(until))
        lost = np.array([f is None for f in found], bool)
        if lost.any():
            stays = ~np.isin(doc, doc[lost[stretch]])
            stretch, doc = stretch[stays], doc[stays]
        out = []
        for i, sizes in enumerate(self.sizes):
            own = [b"" if f is None else f[i] for f in found]
            counts = np.array([len(x) // 4 for x in own], np.int64)
            flat = np.frombuffer(b"".join(own), np.uint32)
            n = counts[stretch]
            first = (np.cumsum(counts) - counts)[stretch] - (np.cumsum(n) - n)
            ids = flat[np.repeat(first, n) + np.arange(n.sum())].astype(np.int64)
            end = np.cumsum(sizes[ids])
            out.append(Tokens(np.repeat(doc, n), end - sizes[ids], end, ids))
        return out[0], out[1]


@dataclass
class Tokens:
    """One side's tokens of some documents: document, first byte, end and id.

    Bytes are counted on from document to document; those without tokens take none.
    """

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    id: np.ndarray

    def frame(self, name: str) -> pd.DataFrame:
        return pd.DataFrame({"start": self.start, "doc": self.doc, name: np.arange(len(self.doc))})


def links(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` of all pairs of tokens whose bytes overlap."""
    left, right = a.frame("a"), b.frame("b")
    over_a = pd.merge_asof(left, right, on="start", by="doc")["b"].to_numpy(np.int64)
    over_b = pd.merge_asof(right, left, on="start", by="doc")["a"].to_numpy(np.int64)
    # A pair that starts together is found from both sides.
    later = np.flatnonzero(a.start[over_b] != b.start)
    return np.concatenate([np.arange(len(a.doc)), over_b[later]]), np.concatenate([over_a, later])


def _groups(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of either side end where one of the other side does."""
    at = np.searchsorted(b.end, a.end)
    ends_a = b.end[at] == a.end
    ends_b = np.zeros(len(b.end), bool)
    ends_b[at[ends_a]] = True
    return ends_a, ends_b


def _spelled(a: Tokens, b: Tokens, ends_a: np.ndarray, ends_b: np.ndarray, names, rows: int) -> list[str]:
    """The groups of each document as ``a1,a2|b1;a3|b2``."""
    out = np.empty(len(a.id) + len(b.id), object)
    until_a, until_b = np.flatnonzero(ends_a) + 1, np.flatnonzero(ends_b) + 1
    # A token stands behind its own side's earlier ones, and the other side's of earlier groups.
    for tokens, ends, before, known in ((a, ends_a, np.concatenate([[0], until_b]), names[0]),
                                        (b, ends_b, np.append(until_a, 0), names[1])):
        place = np.arange(len(ends)) + before[np.cumsum(ends) - ends]
        out[place] = known[tokens.id + ends * (len(known) // 2)]
    counts = np.bincount(a.doc, minlength=rows) + np.bincount(b.doc, minlength=rows)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    return ["".join(out[i:j])[:-1] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]


def _unit(sides: Sides, texts: list[str | None], unit: int, spelled: bool) -> dict[str, pa.Array]:
    """The columns of a unit's documents; the first one carries the unit's pairs."""
    rows = len(texts)
    a, b = sides.tokens(texts)
    at_a, at_b = links(a, b)
    ends_a, ends_b = _groups(a, b)
    groups = _spelled(a, b, ends_a, ends_b, sides.names, rows)
    if not spelled:
        groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]

    codes, place = np.unique(a.id[at_a] << 32 | b.id[at_b], return_inverse=True)
    doc = a.doc[at_a]
    held, times = np.unique(doc * max(1, len(codes)) + place, return_counts=True)
    doc_of, place = np.divmod(held, max(1, len(codes)))
    bounds = np.searchsorted(doc_of, np.arange(rows + 1))
    in_docs = np.bincount(place, minlength=len(codes))

    def cut(values: np.ndarray) -> pa.Array:
        values = values.astype(np.uint32)
        return pa.array([values[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())

    def once(values: np.ndarray, kind: type) -> pa.Array:
        return pa.array([values.astype(kind).tobytes(), *[None] * (rows - 1)], pa.binary())

    def counted(of: np.ndarray) -> pa.Array:
        return pa.array(np.bincount(of, minlength=rows), pa.int64())

    return {"n_a": counted(a.doc), "n_b": counted(b.doc), "n_groups": counted(a.doc[ends_a]),
            "n_links": counted(doc), "groups": pa.array(groups, pa.string()),
            "unit": pa.array(np.full(rows, unit), pa.int64()), "places": cut(place), "times": cut(times),
            "pairs": once(codes, np.int64), "in_docs": once(in_docs, np.uint32)}


_KEPT = ("row", "n_a long", "n_b long", "n_groups long", "n_links long", "groups string")
_UNIT_TYPE = ("n_a long, n_b long, n_groups long, n_links long, groups string, unit long, "
              "places binary, times binary, pairs binary, in_docs binary")


def _units(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``limit`` bytes of text."""
    sizes = [len(t.as_buffer()) if t.is_valid else 0 for t in batch.column("text").cast(pa.large_binary())]
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > limit:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield batch.slice(begin)


def _aligned(docs: DataFrame, definition: str, model: bytes, spelled: bool, unit_bytes: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((definition, model))  # the vocabularies: 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = worker_cache(("sides", hash(sent.value)), lambda: Sides(*sent.value), "alignment")
        unit = TaskContext.get().partitionId() << 32
        for batch in sliced(batches, 1024):
            for part in _units(batch, unit_bytes):
                made = _unit(sides, part.column("text").to_pylist(), unit, spelled)
                yield pa.RecordBatch.from_pydict({"row": part.column("row"), **made})
                unit += 1

    apart = text_apart(docs)
    return apart.mapInArrow(run, f"{row_type(apart)}, {_UNIT_TYPE}")


def _pairs(aligned: DataFrame) -> DataFrame:
    """``unit``, ``a``, ``b`` and ``n``, how many documents of the unit hold the pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, codes, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                codes = np.frombuffer(codes, np.int64)
                yield pa.RecordBatch.from_pydict({
                    "unit": pa.array(np.full(len(codes), unit), pa.int64()),
                    "place": pa.array(np.arange(len(codes)), pa.int32()),
                    "a": pa.array(codes >> 32, pa.int32()), "b": pa.array(codes & 0xFFFFFFFF, pa.int32()),
                    "n": pa.array(np.frombuffer(n, np.uint32), pa.int64())})

    return aligned.where("pairs IS NOT NULL").select("unit", "pairs", "in_docs").mapInArrow(
        run, "unit long, place int, a int, b int, n long")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``a``, ``b``, ``n_docs`` of the corpus that hold them linked, and the highest for that ``a``."""
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("n_docs"))
    best = counts.groupBy("a").agg(F.max("n_docs").alias("highest"))  # the vocabulary of a: no growth
    return counts.join(best, "a")


def align(docs: DataFrame, byte_level_path: str, pieces_path: str, groups: str = "text",
          unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """A row per row of ``docs``: ``row`` (its columns but ``text``), ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``n_best``, ``count_sum`` and ``groups``, as text or as its ``sha256``.

    The paths are files on the driver, which all executors get.
    """
    if groups not in ("text", "sha256"):
        raise ValueError("groups must be 'text' or 'sha256'")
    with open(byte_level_path, encoding="utf-8") as f, open(pieces_path, "rb") as g:
        definition, model = f.read(), g.read()
    aligned = kept_table(_aligned(docs, definition, model, groups == "text", unit_bytes), "aligned")
    pairs = _pairs(aligned)
    known = pairs.join(pair_counts(pairs), ["a", "b"]).select(
        "unit", "place", "n_docs", (F.col("n_docs") == F.col("highest")).alias("is_best"))

    n_kept = len(_KEPT)

    def summed(own: pa.Table, found: pa.Table) -> pa.Table:
        # A unit's documents and its distinct pairs: bounded by unit_bytes, or one text.
        n_docs, is_best = np.zeros(len(found), np.int64), np.zeros(len(found), bool)
        at = found.column("place").to_numpy()
        n_docs[at], is_best[at] = found.column("n_docs").to_numpy(), found.column("is_best").to_numpy()
        best, total = [], []
        for places, times in zip(own.column("places").to_pylist(), own.column("times").to_pylist(), strict=True):
            at, n = np.frombuffer(places, np.uint32), np.frombuffer(times, np.uint32).astype(np.int64)
            best.append(int(n[is_best[at]].sum()))
            total.append(int((n * n_docs[at]).sum()))
        kept = own.select(range(n_kept))
        return kept.append_column("n_best", pa.array(best, pa.int64())).append_column(
            "count_sum", pa.array(total, pa.int64()))

    kept = ", ".join([f"row {aligned.schema['row'].dataType.simpleString()}", *_KEPT[1:]])
    names = [k.split()[0] for k in _KEPT]
    return (
        aligned.select(*names, "unit", "places", "times").groupBy("unit").cogroup(known.groupBy("unit"))
        .applyInArrow(summed, f"{kept}, n_best long, count_sum long")
    )


ship_by_value(__name__)
