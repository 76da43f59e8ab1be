"""Harmonic packing of token sequences.

Lengths fall into reciprocal classes of the capacity: a piece longer than capacity / (m + 1) and not
longer than capacity / m is of class m, and a bin of class m takes m pieces, whatever they are. Each
task fills the bins of its own documents, without asking any other. A document that fits a sequence
stays whole but for one case: a bin that has its m pieces waits with the room that is left, and the
next documents go there, whole where they fit; the first that does not is cut to close it. So there is
at most one cut a bin beside the full sequences that a longer document is cut into. No cut leaves less
than ``smallest`` tokens on either side; a bin with less room than that is padded. What a task is left
with at its end is laid in a row: full sequences, and from the last one sequences whose lengths are
powers of two, which need no padding (only there cuts may be shorter).

Defined results: a null or empty text is the end token alone. Rows that repeat are packed each.
Only ``doc_id`` and ``text`` are read. An empty table gives no pieces. What a task holds is bounded:
for each of the at most 2 * sqrt(capacity) classes an open bin and one that waits.
"""

from __future__ import annotations

import os
import string
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.common import ship_by_value, sliced, worker_cache

CAPACITY = 4096
END_TOKEN = 2
# Words as they stand and bare words that a task remembers: about 200 bytes each.
REMEMBERED = (800_000, 500_000)
ROWS_A_BATCH = 8192
# No document is cut to less.
SMALLEST = 32

_COLUMNS = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(),
            "doc_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64(),
            "padded_to": pa.int64(), "ids": pa.binary()}
_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
           "sequence_id long, `offset` long, padded_to long, ids binary")


class Remembered:
    """What was made for a key, for the first ``limit`` keys: the frequent ones are soon among them.

    When four times as many others have come since, the texts have changed, and it starts anew.
    """

    def __init__(self, limit: int):
        self.known: dict[str, bytes] = {}
        self.limit, self.refused = limit, 0

    def lacking(self, keys: set[str]) -> list[str]:
        known = self.known
        return [k for k in keys if k not in known]

    def add(self, made: dict[str, bytes]) -> None:
        if len(self.known) < self.limit:
            self.known.update(made)
            return
        self.refused += len(made)
        if self.refused > 4 * self.limit:
            self.known, self.refused = {}, 0


class WordTokenizer:
    """Ids of texts for a tokenizer that folds case and never joins across a space or line break.

    Most words come again and again: their ids are remembered, as they stand in the text and as
    bare words in lower case, without the stops that follow them. Bare words that are new are given to
    the tokenizer as one text: each is one piece there, and only a piece's last token ends with its
    suffix.
    """

    # All of ASCII's but the apostrophe, which can begin a piece with letters.
    _STOPS = string.punctuation.replace("'", "")

    def __init__(self, definition: str, remembered: tuple[int, int] = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.words, self.bare = map(Remembered, remembered)
        self.last = self._last_tokens()

    def _last_tokens(self) -> np.ndarray | None:
        """Which ids end a piece; None where the vocabulary does not tell for every piece."""
        from tokenizers.pre_tokenizers import ByteLevel

        suffix, vocab = getattr(self.tokenizer.model, "end_of_word_suffix", None), self.tokenizer.get_vocab()
        if not suffix or any(c + suffix not in vocab for c in ByteLevel.alphabet()):
            return None
        last = np.zeros(max(vocab.values()) + 1, bool)
        last[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        return last

    def _parts(self, word: str) -> tuple[str, str]:
        """The bare word and its stops, where these are separate tokens; else the word as it is."""
        low = word.lower()
        core = low.rstrip(self._STOPS)
        if len(low) == len(word) and core.isalpha() and (
                word.isascii() or ("\u03a3" not in word and unicodedata.is_normalized("NFC", word))):
            return core, low[len(core):]
        return word, ""

    def _one_by_one(self, words: list[str]) -> dict[str, bytes]:
        if not words:
            return {}
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return {x: struct.pack(f"<{len(ids)}I", *ids.ids) for x, ids in zip(words, found, strict=True)}

    def _at_once(self, bare: list[str]) -> dict[str, bytes]:
        if self.last is None or len(bare) < 2:
            return self._one_by_one(bare)
        found = self.tokenizer.encode_batch_fast([" ".join(bare)], add_special_tokens=False)[0].ids
        ids = np.array(found, "<u4")
        ends = (np.flatnonzero(self.last[ids]) + 1).tolist()
        if len(ends) != len(bare):  # a word that is a letter's to Python only
            return self._one_by_one(bare)
        data = ids.tobytes()
        return {x: data[4 * a: 4 * b] for x, a, b in zip(bare, [0, *ends], ends, strict=False)}

    def encode(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        found = list(map(self.words.known.get, words))
        try:
            return b"".join(found)
        except TypeError:  # some are not known
            places = [i for i, x in enumerate(found) if x is None]
        lacking = dict.fromkeys([words[i] for i in places])
        parts = list(map(self._parts, lacking))
        new, bare = self.bare.lacking({x for p in parts for x in p}), self.bare.known
        made = self._at_once([x for x in new if x.isalpha()])
        made |= self._one_by_one([x for x in new if x not in made])
        self.bare.add(made)
        for w, (core, stops) in zip(lacking, parts, strict=True):
            lacking[w] = (made[core] if core in made else bare[core]) + (made[stops] if stops in made else bare[stops])
        self.words.add(lacking)
        for i in places:
            found[i] = lacking[words[i]]
        return b"".join(found)


def cut_lengths(n: int, capacity: int, smallest: int = 1) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: full ones, then falling halves of the capacity."""
    cuts, size = [capacity] * (n // capacity), capacity // 2
    left = n % capacity
    while left:
        if left < smallest or size == 0:
            cuts.append(left)
            break
        if left >= size:
            cuts.append(size)
            left -= size
        size //= 2
    return cuts


def divide(length: int, room: int, smallest: int) -> int | None:
    """How much of a piece goes into a room: all if it fits, else so much that neither part is
    short; None if that cannot be."""
    if length <= room:
        return length
    take = min(room, length - smallest)
    return take if take >= smallest else None


class Piece:
    """Some of a document's ids, and where in the document they start."""

    __slots__ = ("doc", "start", "ids", "length", "tokens")

    def __init__(self, doc: int | None, start: int, ids: bytes, tokens: int):
        self.doc, self.start, self.ids, self.tokens = doc, start, ids, tokens
        self.length = len(ids) // 4

    def cut(self, take: int) -> tuple[Piece, Piece]:
        at = 4 * take
        return (Piece(self.doc, self.start, self.ids[:at], self.tokens),
                Piece(self.doc, self.start + take, self.ids[at:], self.tokens))


class Bins:
    """The bins of one task; ``closed`` collects rows of those that are done."""

    def __init__(self, task: int, capacity: int, smallest: int, with_ids: bool = False):
        self.next_id, self.capacity, self.smallest, self.with_ids = task << 36, capacity, smallest, with_ids
        self.open: dict[int, list[Piece]] = {}
        self.waiting: dict[int, tuple[int, list[Piece]]] = {}  # class: room, pieces
        self.closed: list[tuple] = []

    def add_document(self, doc: int | None, ids: bytes) -> None:
        tokens, start = len(ids) // 4, 0
        while tokens - start > self.capacity:
            take = min(self.capacity, tokens - start - self.smallest)
            part = Piece(doc, start, ids[4 * start: 4 * (start + take)], tokens)
            self.close([part]) if take == self.capacity else self.add(part)
            start += take
        self.add(Piece(doc, start, ids[4 * start:], tokens))

    def add(self, piece: Piece) -> None:
        for kind in list(self.waiting):
            room, pieces = self.waiting[kind]
            take = divide(piece.length, room, self.smallest)
            if take is None:
                continue
            whole = take == piece.length
            part, rest = (piece, None) if whole else piece.cut(take)
            self._wait(kind, room - take, [*pieces, part])
            if rest is None:
                return
            piece = rest
        kind = self.capacity // piece.length
        pieces = self.open.setdefault(kind, [])
        pieces.append(piece)
        if len(pieces) == kind:
            del self.open[kind]
            if kind in self.waiting:
                self.close(self.waiting.pop(kind)[1])
            self._wait(kind, self.capacity - sum(p.length for p in pieces), pieces)

    def _wait(self, kind: int, room: int, pieces: list[Piece]) -> None:
        if room < self.smallest:
            self.waiting.pop(kind, None)
            self.close(pieces)
        else:
            self.waiting[kind] = room, pieces

    def close(self, pieces: list[Piece]) -> None:
        total = sum(p.length for p in pieces)
        padded = total if total & (total - 1) == 0 else self.capacity
        at = 0
        for p in pieces:
            self.closed.append((p.doc, p.start, p.length, zlib.crc32(p.ids), p.tokens, self.next_id, at,
                                padded, p.ids if self.with_ids else None))
            at += p.length
        self.next_id += 1

    def finish(self) -> None:
        """What waits or is open, long pieces first, in a row of full sequences and a cut last one."""
        left = [p for _, pieces in self.waiting.values() for p in pieces]
        left += [p for pieces in self.open.values() for p in pieces]
        self.open, self.waiting = {}, {}
        row, room = [], self.capacity
        for piece in sorted(left, key=lambda p: -p.length):
            take = divide(piece.length, room, self.smallest)
            if take == piece.length:
                row.append(piece)
                room -= take
                continue
            if take is not None:
                part, piece = piece.cut(take)
                row.append(part)
            self.close(row)
            row, room = [piece], self.capacity - piece.length
        for size in cut_lengths(self.capacity - room, self.capacity):
            part = []
            while size:
                take = min(size, row[0].length)
                first = row.pop(0)
                if take < first.length:
                    first, rest = first.cut(take)
                    row.insert(0, rest)
                part.append(first)
                size -= take
            self.close(part)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_COLUMNS)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, _COLUMNS.values(), strict=True)], names=list(_COLUMNS))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_token: int = END_TOKEN,
         smallest: int = SMALLEST, with_ids: bool = False,
         remembered: tuple[int, int] = REMEMBERED) -> DataFrame:
    """A row per piece, with ``padded_to``, the length its sequence is padded to, and, if wanted,
    its ``ids``. ``capacity`` is a power of two, ``smallest`` at most half of it; ``tokenizer_path`` is
    a file on the driver, which all executors get (about 2 MB)."""
    if capacity & (capacity - 1) or not 0 < 2 * smallest <= capacity:
        raise ValueError("capacity must be a power of two, and smallest at most half of it")
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = definition.value
        tokenizer = worker_cache(("word-tokenizer", hash(text), remembered),
                                 lambda: WordTokenizer(text, remembered), "packing")
        end = end_token.to_bytes(4, "little")
        bins = Bins(TaskContext.get().partitionId(), capacity, smallest, with_ids)
        for batch in sliced(batches):
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                bins.add_document(doc, tokenizer.encode(value.as_py() or "") + end)
                if len(bins.closed) >= ROWS_A_BATCH:
                    yield _batch(bins.closed)
                    bins.closed = []
        bins.finish()
        yield _batch(bins.closed)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, _SCHEMA)


ship_by_value(__name__)
