"""Repeated passages by relative Lempel-Ziv parsing.

Every document is factored against the texts that come before it (smaller ``doc_id``, or the same
document further up). The index of the reference holds blocks: around each anchor the ``BLOCK``
words within which any window of ``WINDOW`` words that contains the anchor lies. Anchors are chosen
by the words alone: of the runs of ``GRAM`` words in a window, the one with the least hash is its
anchor, so that equal windows have equal anchors wherever they stand, and about one word in eight is
one. Blocks whose anchor occurs once in the whole corpus are dropped from the index at once.

A block whose words also form a block at an earlier place is taken as a whole; blocks that follow
one another there as here are one factor, taken greedily. At the boundaries of factors, where a
block is not found whole, each of its windows is looked up by itself. Blocks found whole need no such
look-up, and the first place of any window is always at a boundary or in a block found nowhere
before, so that nothing is lost by looking up the rest only. Every word in a window that also starts
earlier is a duplicate.

Equality is that of 128-bit hashes. Defined results: null and empty texts have no words. A null
``doc_id`` comes before all others. Rows with the same ``doc_id`` and text count as one document and
all get its result; with the same ``doc_id`` and other texts they are ordered by a hash of the text.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.common import TEXTS_A_BATCH, kept_table, ship_by_value, sliced
from tillmark.llm.kernel import Texts, _powers, mix, rows_of, same_row, small_batches, window_hashes

WINDOW = 20
GRAM = 6
REACH = WINDOW - GRAM  # how far before an anchor a window that contains it can start
BLOCK = WINDOW + REACH

_NO_ID = -(2 ** 63)
_MOST = np.uint64(2 ** 64 - 1)


class Ranges:
    """Hashes of any run of words, from running sums."""

    def __init__(self, words: np.ndarray, which: int):
        self.power, self.inverse = _powers(len(words) + 1, which)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * self.power[: len(words)], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray, more: np.ndarray) -> np.ndarray:
        h = (self.sums[b] - self.sums[a]) * self.inverse[a]
        return mix(mix(h + (b - a).astype(np.uint64)) + more.astype(np.uint64)).view(np.int64)


def _running(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Least (or largest) of each ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


class Parsed:
    """Words, windows and anchors of a few texts."""

    def __init__(self, texts: Texts):
        starts, ends, self.first = texts.words()
        self.rows = rows_of(self.first)
        self.n = len(starts)
        self.windows = same_row(self.rows, WINDOW)
        self.any = self.n >= WINDOW and bool(self.windows.any())
        if not self.any:
            return
        words = [texts.hashes(starts, ends, w) for w in (0, 1)]
        self.ranges = [Ranges(w, i) for i, w in enumerate(words)]
        self.grams = window_hashes(words[0], GRAM)
        self.grams[~same_row(self.rows, GRAM)] = _MOST
        self.least = self.least_of(self.grams)
        least = np.where(self.windows, self.least, np.uint64(0))
        padded = np.concatenate([np.zeros(REACH, np.uint64), least, np.zeros(REACH, np.uint64)])
        largest = _running(padded, REACH + 1, np.maximum)
        self.anchors = np.flatnonzero((largest == self.grams) & (largest > 0))

    def least_of(self, grams: np.ndarray) -> np.ndarray:
        return _running(grams, REACH + 1, np.minimum)

    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each anchor, where its block begins, and two hashes of it."""
        row = self.rows[self.anchors]
        a = np.maximum(self.first[row], self.anchors - REACH)
        b = np.minimum(self.first[row + 1], self.anchors + WINDOW)
        return a, *(r.of(a, b, self.anchors - a) for r in self.ranges)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("doc"),
                       F.xxhash64(text).alias("txt"), text.alias("text"))


def _anchors(keyed: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, TEXTS_A_BATCH):
            doc, txt = batch.column("doc").to_numpy(), batch.column("txt").to_numpy()
            for at, texts in small_batches(batch.column("text")):
                p = Parsed(texts)
                if not p.any:
                    continue
                row = p.rows[p.anchors]
                _, c1, c2 = p.blocks()
                yield pa.RecordBatch.from_pydict({
                    "doc": doc[at + row], "txt": txt[at + row],
                    "pos": (p.anchors - p.first[row]).astype(np.int32),
                    "anchor": p.grams[p.anchors].view(np.int64), "c1": c1, "c2": c2})

    return keyed.select("doc", "txt", "text").mapInArrow(
        run, "doc long, txt long, pos int, anchor long, c1 long, c2 long")


def _repeated_anchors(keyed: DataFrame) -> DataFrame:
    """Anchors that occur at two places or more. Each batch counts its own first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, TEXTS_A_BATCH):
            for _, texts in small_batches(batch.column("text")):
                p = Parsed(texts)
                if p.any:
                    found, n = np.unique(p.grams[p.anchors].view(np.int64), return_counts=True)
                    yield pa.RecordBatch.from_pydict({"anchor": found, "n": n.astype(np.int64)})

    counted = keyed.select("text").mapInArrow(run, "anchor long, n long")
    return counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")


def _packed(keyed: DataFrame) -> DataFrame:
    """The texts, compressed for the way to where what is known of them waits."""
    import zstandard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in sliced(batches, 1024):
            z = [squeeze(t.encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "doc": batch.column("doc"), "txt": batch.column("txt"),
                "z": pa.array(z, pa.binary())})

    kind = keyed.schema["doc_id"].dataType.simpleString()
    return keyed.mapInArrow(run, f"doc_id {kind}, doc long, txt long, z binary")


def _unpacked(column: pa.Array) -> list[bytes]:
    import zstandard

    return [zstandard.ZstdDecompressor().decompress(x) for x in column.to_pylist()]


def _marks(column: pa.Array, first: np.ndarray, n: int) -> np.ndarray:
    """Which words are named by a list of places for each text."""
    out = np.zeros(n, bool)
    for i, places in enumerate(column.to_pylist()):
        if places:
            out[first[i] + np.array(places)] = True
    return out


def _boundary_windows(packed: DataFrame, asked: DataFrame) -> DataFrame:
    """The windows of blocks not found whole that no block found whole contains."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = pa.array(_unpacked(batch.column("z")), pa.large_binary())
            doc, txt = batch.column("doc").to_numpy(), batch.column("txt").to_numpy()
            for at, part in small_batches(texts):
                p = Parsed(part)
                if not p.any:
                    continue
                n = len(p.grams)
                found = {}
                for name in ("whole", "open"):
                    marked = _marks(batch.column(name).slice(at, part.rows), p.first, p.n)[:n]
                    found[name] = p.least_of(np.where(marked, p.grams, _MOST)) == p.least
                s = np.flatnonzero(p.windows & found["open"] & ~found["whole"])
                row = p.rows[s]
                none = np.zeros(len(s))
                yield pa.RecordBatch.from_pydict({
                    "doc": doc[at + row], "txt": txt[at + row], "pos": (s - p.first[row]).astype(np.int32),
                    "c1": p.ranges[0].of(s, s + WINDOW, none), "c2": p.ranges[1].of(s, s + WINDOW, none)})

    return packed.join(asked, ["doc", "txt"]).mapInArrow(
        run, "doc long, txt long, pos int, c1 long, c2 long")


def _first_places(blocks: DataFrame, purpose: str) -> DataFrame:
    """Of each content that stands at several places, the first."""
    place = F.struct("doc", "txt", "pos")
    return kept_table(
        blocks.groupBy("c1", "c2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first <> last").drop("last"), purpose)


def _factored(docs: DataFrame) -> DataFrame:
    """Per document with anything repeated: ``found``, places of repeated blocks and windows (``a``
    the word, ``w`` whether a window alone, ``ref`` and ``at`` the earlier place)."""
    keyed = _keyed(docs)
    repeated = kept_table(_repeated_anchors(keyed), "sub-anchors")
    blocks = kept_table(_anchors(keyed).join(repeated, "anchor").drop("anchor"), "sub-blocks")
    first = _first_places(blocks, "sub-block-places")
    known = blocks.join(first, ["c1", "c2"], "left").select(
        "doc", "txt", "pos", F.when(F.struct("doc", "txt", "pos") != F.col("first"), F.col("first")).alias("ref"))
    known = kept_table(known, "sub-known")
    asked = known.groupBy("doc", "txt").agg(
        F.collect_list(F.when(F.col("ref").isNotNull(), F.col("pos"))).alias("whole"),
        F.collect_list(F.when(F.col("ref").isNull(), F.col("pos"))).alias("open"),
    ).where(F.size("open") > 0)
    windows = kept_table(_boundary_windows(_packed(keyed), asked), "sub-windows")
    window_first = _first_places(windows, "sub-window-places")
    later = windows.join(window_first, ["c1", "c2"]).select(
        "doc", "txt", "pos", F.lit(True).alias("w"), F.col("first").alias("ref")
    ).where(F.struct("doc", "txt", "pos") != F.col("ref"))
    whole = known.where("ref IS NOT NULL").select("doc", "txt", "pos", F.lit(False).alias("w"), "ref")
    return whole.unionByName(later).groupBy("doc", "txt").agg(
        F.collect_list(F.struct(F.col("pos").alias("a"), "w", F.col("ref.doc").alias("ref"),
                                F.col("ref.pos").alias("at"))).alias("found"))


def _parse(found: list[dict], n_words: int) -> list[tuple[int, int, int, int]]:
    """Greedy factors: start, end, reference document and start there; and they do not overlap."""
    runs: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for f in found:
        begin, end = ((f["a"], f["a"] + WINDOW) if f["w"] else
                      (max(0, f["a"] - REACH), min(n_words, f["a"] + WINDOW)))
        runs.setdefault((f["ref"], f["at"] - f["a"]), []).append((begin, end))
    factors = []
    for (ref, shift), parts in runs.items():
        parts.sort()
        begin, end = parts[0]
        for a, b in parts[1:]:
            if a > end:
                factors.append((begin, end, ref, begin + shift))
                begin, end = a, b
            end = max(end, b)
        factors.append((begin, end, ref, begin + shift))
    factors.sort(key=lambda f: (f[0], -f[1]))
    out, at, i = [], 0, 0
    best = None
    while i < len(factors) or best is not None:
        while i < len(factors) and (best is None or factors[i][0] <= at):
            if best is None:
                at = max(at, factors[i][0])
            if best is None or factors[i][1] > best[1]:
                best = factors[i]
            i += 1
        if best[1] > at:
            out.append((at, best[1], best[2], best[3] + at - best[0]))
            at = best[1]
        best = None
    return out


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed``, ``kept`` (the words that stay,
    joined by a space) and ``factors`` (start, length, reference document and start there)."""
    keyed = _keyed(docs)
    found = kept_table(_factored(docs), "sub-found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()),
                                   ("ref", pa.int64()), ("ref_start", pa.int32())]))
        for batch in sliced(batches):
            n_words, n_removed, kept, factors = [], [], [], []
            for text, places in zip(_unpacked(batch.column("z")), batch.column("found").to_pylist(), strict=True):
                words = text.split()
                spans = _parse(places, len(words)) if places else []
                stay, at = [], 0
                for a, b, _, _ in spans:
                    stay += words[at:a]
                    at = b
                stay += words[at:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(stay))
                kept.append(b" ".join(stay).decode())
                factors.append([{"start": a, "length": b - a, "ref": r, "ref_start": s} for a, b, r, s in spans])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.string()),
                "factors": pa.array(factors, kind)})

    joined = _packed(keyed).join(found, ["doc", "txt"], "left").select("doc_id", "z", "found")
    kind = keyed.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        run, f"doc_id {kind}, n_words long, n_removed long, kept string, "
             "factors array<struct<start:int,length:int,ref:long,ref_start:int>>")


ship_by_value(__name__)
