"""Words, shingles and their hashes for whole batches of texts at a time, in numpy.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return, so that bytes suffice and nothing is decoded. Hashes are polynomial, modulo 2^64, read off
running sums: a word or a window costs the same whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tillmark.llm.common import ship_by_value, worker_cache

BATCH_BYTES = 1 << 19
_BASE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers that spreads every bit (splitmix64's last step)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd number and of its inverse modulo 2^64."""
    size = max(1 << 16, 1 << int(n).bit_length())

    def make():
        base = int(_BASE[which])
        inverse = pow(base, -1, 1 << 64)
        tables = []
        for b in (base, inverse):
            t = np.full(size, np.uint64(b))
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        return tables[0], tables[1]

    if size > 4 * BATCH_BYTES:  # one huge text: not worth keeping
        return make()
    return worker_cache(("powers", size, which), make)


def _byte_values(which: int, fold_case: bool) -> np.ndarray:
    def make():
        codes = np.arange(256, dtype=np.uint64)
        if fold_case:
            codes[65:91] += np.uint64(32)
        return mix(codes * _BASE[1 - which] + np.uint64(which + 1))
    return worker_cache(("byte-values", which, fold_case), make)


class Texts:
    """A few texts as one run of bytes; ``off`` has where each begins, and the end."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.buf, self.off = buf, off
        self.rows = len(off) - 1

    def pieces(self, is_gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the runs between gaps, none across texts, and each text's first."""
        inside = np.empty(len(self.buf) + 2, bool)
        inside[0] = inside[-1] = False
        np.logical_not(is_gap, out=inside[1:-1])
        begins = inside[1:] & ~inside[:-1]
        # A text that begins within a run begins a new one.
        cut = self.off[(self.off > 0) & (self.off < len(self.buf))]
        cut = cut[inside[cut + 1]]
        begins[cut] = True
        starts = np.flatnonzero(begins)
        ends_mask = ~inside[1:] & inside[:-1]
        ends_mask[cut[inside[cut]]] = True
        ends = np.flatnonzero(ends_mask)
        return starts, ends, np.searchsorted(starts, self.off)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        b = self.buf
        return self.pieces((b == 32) | ((b >= 9) & (b <= 13)))

    def hashes(self, starts: np.ndarray, ends: np.ndarray, which: int = 0,
               fold_case: bool = False) -> np.ndarray:
        power, inverse = _powers(len(self.buf) + 1, which)
        sums = np.zeros(len(self.buf) + 1, np.uint64)
        np.cumsum(_byte_values(which, fold_case)[self.buf] * power[: len(self.buf)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """Hashes of all runs of ``n`` words, those across texts too."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(words) + 1, which)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[: len(words)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * inverse[: len(words) - n + 1] + np.uint64(n))


def rows_of(first: np.ndarray) -> np.ndarray:
    """For each piece, which text it belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def same_row(rows: np.ndarray, n: int) -> np.ndarray:
    """For each run of ``n`` pieces, whether it lies within one text."""
    if len(rows) < n:
        return np.zeros(0, bool)
    return rows[: len(rows) - n + 1] == rows[n - 1:]


def small_batches(column: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, Texts]]:
    """The column's texts, null as empty, in runs of about ``limit`` bytes, with the first's number."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(off, off[row] + limit, "right")) - 1)
        yield row, Texts(buf[off[row]: off[end]], off[row: end + 1] - off[row])
        row = end


ship_by_value(__name__)
