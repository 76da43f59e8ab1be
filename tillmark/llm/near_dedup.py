"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A shingle is five consecutive words, A-Z in lower case (all words, in a shorter text), and its
weight is how often the text has it times an inverse frequency. Frequencies are those of
``2 ** FEATURE_BITS`` classes of shingles over all texts, so that what the driver and the tasks hold
of them has one size for any corpus. The inverse frequency is damped to between 1 and
``1 + IDF_SHARE``: what thousands of copies share must not count for so little that they come apart.

Each of ``BANDS * ROWS`` samples of a text is drawn so that two texts agree with a chance of their
weighted Jaccard similarity. A text with repeated shingles is sampled once more with each of them
counted once, and stands in bands by both: so those meet whose plain similarity is high but that repeat
unequally. Texts that agree on all samples of a band meet there. Copies of one and
the same text meet as one. Where texts meet, no pairs are formed: all samples tell which text is
likely near which, and each text is paired with its likeliest few and with a hub, a text near many
others. Bands with more than ``MEET_AT_ONCE`` texts are split by a hash; hubs of the parts are then
put to all texts of the band. Pairs are decided on all shingles: a link is a weighted or plain
Jaccard similarity of ``SIMILARITY`` or more. The classes are the connected components of the links.

That shortens the work only. Where texts that met are not yet joined by links, every pair of them that
agrees on ``LEAST_AGREEING`` samples is decided too, in the task in which they meet again.

A link can be missed only if its two texts meet in no band (chance 0.0008 at similarity 0.8, falling
fast; at most 0.003 at plain similarity 0.8, as inverse frequencies may bring it down to 0.76), or agree
on too few samples.

Defined results: texts without a word are each in a class of their own. Rows that repeat are in one
class. A null ``doc_id`` comes before all others. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.llm.common import (
    TEXTS_A_BATCH,
    digest16,
    fresh_folder,
    kept_table,
    ship_by_value,
    sliced,
    stored,
    worker_cache,
)
from tillmark.llm.kernel import Texts, mix, rows_of, same_row, small_batches, window_hashes

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 10, 3
SAMPLES = BANDS * ROWS
FEATURE_BITS = 18
IDF_SHARE = 0.25
MEET_AT_ONCE = 512
LIKELIEST = 3
HUBS = 8
HUBS_A_STAR = 3
# Of 30 samples; at similarity 0.8 fewer than 15 agree once in 25,000 times.
LEAST_AGREEING = SAMPLES // 2
SURELY_NEAR = SAMPLES * 7 // 10
# Bits that tell which texts are asked for: 16 MB broadcast at most, when nearly all of them are set.
ASKED_BITS = 26

_NO_ID = -(2 ** 63)


def shingles(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, 32-bit shingle and how often, ordered by text and shingle."""
    starts, ends, first = texts.words()
    words = texts.hashes(starts, ends, fold_case=True)
    rows = rows_of(first)
    within = same_row(rows, WORDS)
    found_rows, found = [rows[: len(within)][within]], [window_hashes(words, WORDS)[within]]
    n_words = np.diff(first)
    for n in range(1, WORDS):
        short = np.flatnonzero(n_words == n)
        if len(short):
            found_rows.append(short)
            found.append(window_hashes(words, n)[first[short]])
    row, h = np.concatenate(found_rows), np.concatenate(found)
    keys, often = np.unique((row.astype(np.uint64) << np.uint64(32)) | (h >> np.uint64(32)), return_counts=True)
    return (keys >> np.uint64(32)).astype(np.int64), keys.astype(np.uint32), often


def features(shingle: np.ndarray) -> np.ndarray:
    return (shingle >> np.uint32(32 - FEATURE_BITS)).astype(np.int64)


# ---- weights ---------------------------------------------------------------------------------


def feature_weights(docs: DataFrame) -> np.ndarray:
    """The damped inverse document frequency of every class of shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << FEATURE_BITS, np.int64)
        for batch in sliced(batches, TEXTS_A_BATCH):
            for _, texts in small_batches(batch.column("text")):
                total += np.bincount(features(shingles(texts)[1]), minlength=len(total))
        some = np.flatnonzero(total)
        for i in range(0, len(some), 1 << 15):
            part = some[i: i + (1 << 15)]
            yield pa.RecordBatch.from_pydict({"feature": pa.array(part, pa.int32()), "n": pa.array(total[part])})

    counted = docs.select("text").mapInArrow(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()  # 2 ** FEATURE_BITS rows at most
    df = np.zeros(1 << FEATURE_BITS)
    df[rows.column("feature").to_numpy()] = rows.column("n").to_numpy()
    total = df.sum() + 1
    return (1 + IDF_SHARE * np.log(total / (df + 1)).clip(0) / np.log(total + 1)).astype(np.float32)


# ---- samples ---------------------------------------------------------------------------------


def _uniform(ids: np.ndarray, sample: int, stream: int) -> np.ndarray:
    """A number in (0, 1) for each class of shingles, fixed by class, sample and stream."""
    salt = np.uint64((sample * 8 + stream + 1) * 0x9E3779B97F4A7C15 & (2 ** 64 - 1))
    h = mix(mix(ids.astype(np.uint64) + np.uint64(1)) + salt)
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2 ** 53


class Sampler:
    """Draws of consistent weighted sampling: with r, c gamma and b uniform for each class,
    t = floor(log(weight) / r + b), y = exp(r (t - b)), and the class of least c / (y exp(r)) is drawn.

    Almost all shingles stand once in a text, so that their value is looked up. A draw is told by its
    value: equal values are equal classes and steps.
    """

    def __init__(self, weights: np.ndarray):
        self.log_weights = np.log(weights.astype(np.float64))
        every = np.arange(1 << FEATURE_BITS)
        self.once = np.stack([self._value(k, self.log_weights, every) for k in range(SAMPLES)])

    @staticmethod
    def _value(k: int, log_weight: np.ndarray, ids: np.ndarray) -> np.ndarray:
        u = [_uniform(ids, k, s) for s in range(5)]
        r, log_c = -np.log(u[0] * u[1]), np.log(-np.log(u[2] * u[3]))
        t = np.floor(log_weight / r + u[4])
        return (log_c - r * (t - u[4]) - r).astype(np.float32)

    def draw(self, row: np.ndarray, feature: np.ndarray, often: np.ndarray, n_rows: int) -> np.ndarray:
        """Samples of each text, by their bits; texts without a shingle have zeros."""
        out = np.zeros((n_rows, SAMPLES), np.uint32)
        if not len(row):
            return out
        begins = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        again = np.flatnonzero(often > 1)
        log_weight = self.log_weights[feature[again]] + np.log(often[again])
        for k in range(SAMPLES):
            value = self.once[k][feature]
            if len(again):
                value[again] = self._value(k, log_weight, feature[again])
            out[row[begins], k] = np.minimum.reduceat(value, begins).view(np.uint32)
        return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    wide = samples.astype(np.uint64).reshape(len(samples), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), wide.shape[:2])
    for j in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + wide[:, :, j])
    return key.view(np.int64)


def _signed(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc``, ``txt``, ``samples`` and ``bands``, the latter two null for texts without a word; ``once``
    and ``once_bands``, the same with each shingle counted once, null where they are no others."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)  # 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = worker_cache(("weights", hash(sent.value.tobytes())), lambda: Sampler(sent.value), "near")
        for batch in sliced(batches, 2048):
            samples, bands, empty, once, once_bands, same = [], [], [], [], [], []
            for _, texts in small_batches(batch.column("text")):
                row, shingle, often = shingles(texts)
                drawn = sampler.draw(row, features(shingle), often, texts.rows)
                samples += [x.tobytes() for x in drawn]
                bands.append(band_keys(drawn))
                empty.append(np.bincount(row, minlength=texts.rows) == 0)
                repeats = np.bincount(row[often > 1], minlength=texts.rows) > 0
                some = repeats[row]
                single = sampler.draw(row[some], features(shingle[some]), np.ones(some.sum(), np.int64), texts.rows)
                once += [x.tobytes() for x in single]
                once_bands.append(band_keys(single))
                same.append(~repeats | (single == drawn).all(1))
            no_others = np.concatenate(same)
            none = np.concatenate(empty)
            keys = np.concatenate(bands)
            yield pa.RecordBatch.from_pydict({
                "doc": batch.column("doc"), "txt": batch.column("txt"),
                "samples": pa.array(samples, pa.binary(), mask=none),
                "bands": pa.array(list(keys), pa.list_(pa.int64()), mask=none),
                "once": pa.array(once, pa.binary(), mask=no_others),
                "once_bands": pa.array(list(np.concatenate(once_bands)), pa.list_(pa.int64()), mask=no_others)})

    return docs.mapInArrow(run, "doc long, txt binary, samples binary, bands array<long>, "
                                "once binary, once_bands array<long>")


# ---- who is put to whom ----------------------------------------------------------------------


def likely_pairs(samples: np.ndarray, hubs_wanted: int = 0) -> tuple[np.ndarray, list[int]]:
    """Pairs (places in ``samples``) worth deciding: a few times as many as texts. And the texts
    that are likely near the most others."""
    n = len(samples)
    agree = np.zeros((n, n), np.int16)
    for k in range(samples.shape[1]):
        agree += samples[:, k, None] == samples[None, :, k]
    np.fill_diagonal(agree, 0)
    pairs = set()
    take = min(LIKELIEST, n - 1)
    best = np.argpartition(-agree, take - 1, axis=1)[:, :take]
    for i in range(n):
        pairs.update((min(i, int(j)), max(i, int(j))) for j in best[i] if agree[i, j] >= LEAST_AGREEING)
    near = agree >= SURELY_NEAR
    # How much a text agrees with all that are near it: what single estimates blur, their sum shows.
    hubs = [int(x) for x in np.argsort(-(agree * near).sum(1), kind="stable")[:hubs_wanted]]
    left = np.ones(n, bool)
    while True:
        central = (agree * (near & left[None, :])).sum(1)
        top = np.argsort(-central, kind="stable")[:HUBS_A_STAR].tolist()
        if central[top[0]] == 0:
            break
        for hub in top:
            pairs.update((min(hub, int(j)), max(hub, int(j)))
                         for j in np.flatnonzero((agree[hub] >= LEAST_AGREEING) & left) if j != hub)
        left[near[top[0]]] = False
        left[top[0]] = False
    return np.array(sorted(pairs), np.int64).reshape(-1, 2), hubs


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys of rows that arrive ordered by them, also across batches."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*waiting, batch]).combine_chunks()
        columns = [table.column(k).to_numpy() for k in keys]
        new = np.zeros(table.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist()]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield table.slice(a, b - a)
        waiting = table.slice(cuts[-1]).to_batches()
    if waiting:
        yield pa.Table.from_batches(waiting)


_ID = pa.struct([("doc", pa.int64()), ("txt", pa.binary())])


def _pairs_of(meeting: DataFrame) -> DataFrame:
    """``a``, ``b``; or ``key`` and ``a``, a hub, where ``part`` says that the band is split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, key = [], [], []
        for group in _grouped(batches, ["key", "part"]):
            node = group.column("node").to_pylist()
            samples = np.frombuffer(b"".join(group.column("samples").to_pylist()), np.uint32).reshape(-1, SAMPLES)
            split = group.column("parts")[0].as_py() > 1
            pairs, hubs = likely_pairs(samples, HUBS if split else 0)
            for i, j in pairs.tolist():
                a.append(node[i])
                b.append(node[j])
                key.append(None)
            for i in hubs:
                a.append(node[i])
                b.append(None)
                key.append(group.column("key")[0].as_py())
            if len(a) >= 4096:
                yield _as_batch(a, b, key)
                a, b, key = [], [], []
        yield _as_batch(a, b, key)

    ordered = meeting.repartition("key", "part").sortWithinPartitions("key", "part")
    return ordered.mapInArrow(run, "a struct<doc:long,txt:binary>, b struct<doc:long,txt:binary>, key long")


def _as_batch(a: list, b: list, key: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"a": pa.array(a, _ID), "b": pa.array(b, _ID), "key": pa.array(key, pa.int64())})


def _meeting(nodes: DataFrame) -> DataFrame:
    """``key``, ``band`` and ``node`` of the texts in each band with others; ``again``, whether by samples
    of shingles counted once, and ``n``, how many rows. A text may be in a band twice, by both of its
    samples. The samples are no part of it: they are ten times larger than the rest, and most bands
    have one text."""
    posts = nodes.select("node", F.lit(False).alias("again"), F.posexplode("bands").alias("band", "key")).unionByName(
        nodes.where("once IS NOT NULL").select(
            "node", F.lit(True).alias("again"), F.posexplode("once_bands").alias("band", "key")))
    node = F.xxhash64("node")
    shared = kept_table(posts.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min(node).alias("least"), F.max(node).alias("most")
    ).where("least < most").select("key", "n"), "near-bands")
    return kept_table(posts.join(shared, "key").select("key", "band", "node", "again", "n"), "near-meeting")


def _with_samples(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` (with ``node`` and ``again``) with the ``samples`` that they meet by, in place of ``again``."""
    of = nodes.select(F.col("node").alias("of"), F.col("samples").alias("all"), "once")
    return rows.join(of, F.col("node") == F.col("of")).withColumn(
        "samples", F.when(F.col("again"), F.col("once")).otherwise(F.col("all"))).drop("of", "all", "once", "again")


def _candidates(nodes: DataFrame, posts: DataFrame) -> DataFrame:
    """Pairs of texts, ``a`` before ``b``, that are worth deciding first."""
    parts = F.ceil(F.col("n") / MEET_AT_ONCE).cast("int")
    meeting = posts.select(
        "key", "node", "again", parts.alias("parts"),
        F.pmod(F.xxhash64("node"), parts).cast("int").alias("part"))
    found = kept_table(_pairs_of(_with_samples(meeting, nodes)), "near-found")
    pairs = found.where("b IS NOT NULL").select("a", "b")
    # Split bands: the hubs of the parts meet, the best of them are put to all texts of the band.
    hubs = found.where("b IS NULL").select("key", F.col("a").alias("node")).distinct()
    n_split = F.floor(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) * F.ceil(F.col("hubs") / MEET_AT_ONCE) / (1 << 30))
    with_samples = (
        hubs.join(hubs.groupBy("key").agg(F.count(F.lit(1)).alias("hubs")), "key")
        .join(nodes.select("node", "samples"), "node")
        .select("key", "node", "samples", F.lit(2).alias("parts"), n_split.cast("int").alias("part")))
    best = kept_table(_pairs_of(with_samples), "near-hubs")
    few = best.where("b IS NULL").groupBy("key").agg(
        F.slice(F.array_sort(F.collect_set("a")), 1, 4 * HUBS).alias("few"))
    put = posts.join(kept_table(few, "near-few"), "key").select("node", F.explode("few").alias("hub"))
    sides = put.where("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
    both = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).unionByName(sides).unionByName(
        best.where("b IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    return kept_table(both.where("a <> b").distinct(), "near-pairs")


# ---- deciding pairs --------------------------------------------------------------------------


def _similarity(a: bytes, b: bytes, weights: np.ndarray) -> float:
    """The larger of weighted and plain Jaccard similarity of two multisets of shingles."""
    return _similarity_of(_counted(a), _counted(b), weights)


def _counted(a: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.frombuffer(a, np.uint32), return_counts=True)


def _similarity_of(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], weights: np.ndarray) -> float:
    (x, nx), (y, ny) = a, b
    both, at_x, at_y = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    plain = len(both) / (len(x) + len(y) - len(both))
    shared = (weights[features(both)] * np.minimum(nx[at_x], ny[at_y])).sum()
    whole = (weights[features(x)] * nx).sum() + (weights[features(y)] * ny).sum() - shared
    return max(plain, float(shared / whole))


def _shingle_sets(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2048):
            sets = []
            for _, texts in small_batches(batch.column("text")):
                row, shingle, often = shingles(texts)
                full, rows = np.repeat(shingle, often), np.repeat(row, often)
                cut = np.searchsorted(rows, np.arange(texts.rows + 1))
                sets += [full[cut[i]: cut[i + 1]].tobytes() for i in range(texts.rows)]
            yield pa.RecordBatch.from_pydict({"txt": batch.column("txt"), "set": pa.array(sets, pa.binary())})

    return docs.select("txt", "text").mapInArrow(run, "txt binary, `set` binary")


def _likely_asked(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """The rows whose ``txt`` is asked for, and some others: by a bit of its hash, so that no text is
    shuffled. The bits are at most ``2 ** (ASKED_BITS - 6)`` rows of 64; the more texts are asked for,
    the more others stay."""
    def place(name: str) -> Column:
        return F.xxhash64(name).bitwiseAND(F.lit((1 << ASKED_BITS) - 1))

    bit = F.expr("shiftleft(1L, cast(place & 63 AS int))")
    words = asked.select(place("txt").alias("place")).select(
        F.shiftright("place", 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    known = (F.shiftright("place", 6) == F.col("word")) & (F.expr("getbit(bits, cast(place & 63 AS int))") == 1)
    return docs.withColumn("place", place("txt")).join(F.broadcast(words), known, "left_semi").drop("place")


def _sets_of(posts: DataFrame, docs: DataFrame) -> DataFrame:
    """``txt`` and ``set`` of the texts that meet others: made once for all that is decided of them."""
    asked = posts.select(F.col("node.txt").alias("txt")).distinct()
    # Copies of a text are one before they are shuffled. One plan for any size: merged, not broadcast.
    one_each = _shingle_sets(_likely_asked(docs, asked)).groupBy("txt").agg(F.first("set").alias("set"))
    return kept_table(one_each.join(asked.hint("merge"), "txt", "left_semi"), "near-sets")


def _links(pairs: DataFrame, sets: DataFrame, weights: np.ndarray, similarity: float) -> DataFrame:
    sent = sets.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1024):
            value = [_similarity(a, b, sent.value) for a, b in
                     zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)]
            near = pa.array([v >= similarity for v in value], pa.bool_())
            yield batch.select(["a", "b"]).filter(near)

    ready = (
        pairs.join(sets.select(F.col("txt").alias("ta"), F.col("set").alias("x")), F.col("a.txt") == F.col("ta"))
        .join(sets.select(F.col("txt").alias("tb"), F.col("set").alias("y")), F.col("b.txt") == F.col("tb"))
        .select("a", "b", "x", "y"))
    kind = "struct<doc:long,txt:binary>"
    return kept_table(ready.mapInArrow(run, f"a {kind}, b {kind}"), "near-links")


# ---- the rest --------------------------------------------------------------------------------


def open_pairs(samples: np.ndarray, root: np.ndarray, side: np.ndarray, band: int) -> np.ndarray:
    """Pairs of texts of different roots that are likely near and meet in no band before this one;
    of two sides, if there are two, one of each."""
    one = np.flatnonzero(side == side.min())
    other = np.flatnonzero(side == side.max())
    agree = np.zeros((len(one), len(other)), np.int16)
    before = np.zeros(agree.shape, bool)
    for b in range(BANDS):
        same = np.ones(agree.shape, bool)
        for k in range(b * ROWS, (b + 1) * ROWS):
            equal = samples[one, k, None] == samples[None, other, k]
            agree += equal
            same &= equal
        if b < band:
            before |= same
    found = (agree >= LEAST_AGREEING) & ~before & (root[one, None] != root[None, other])
    i, j = np.nonzero(found)
    i, j = one[i], other[j]
    if one[0] == other[0]:
        i, j = i[i < j], j[i < j]
    return np.stack([i, j], axis=1)


_UNIT = ["key", "i", "j"]
_MEMBER = ("key long, i int, j int, side int, band int, root long, "
           "node struct<doc:long,txt:binary>, samples binary")


def _open_of(group: pa.Table) -> np.ndarray:
    side = group.column("side").to_numpy()
    if len(np.unique(side)) < (2 if group.column("i")[0].as_py() < group.column("j")[0].as_py() else 1):
        return np.zeros((0, 2), np.int64)  # no text fell into the other part
    samples = np.frombuffer(b"".join(group.column("samples").to_pylist()), np.uint32).reshape(-1, SAMPLES)
    return open_pairs(samples, group.column("root").to_numpy(), side,
                      group.column("band")[0].as_py())


def _together(members: DataFrame) -> DataFrame:
    return members.repartition(*_UNIT).sortWithinPartitions(*_UNIT)


def _links_left(posts: DataFrame, nodes: DataFrame, roots: DataFrame, sets: DataFrame, weights: np.ndarray,
                similarity: float) -> DataFrame | None:
    """Links among texts that met and are in different components; none if no pair is left."""
    met = kept_table(posts.join(roots, "node", "left").select(
        "key", "band", "node", "again", F.xxhash64(F.coalesce("root", "node")).alias("root")), "near-met")
    units = _with_samples(_units(met), nodes).select("key", "i", "j", "side", "band", "root", "node", "samples")
    members = kept_table(_together(units).mapInArrow(_with_open_pairs, _MEMBER), "near-left")
    if members.isEmpty():
        return None
    sent = sets.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches, _UNIT):
            node, sets = group.column("node").to_pylist(), [_counted(x) for x in group.column("set").to_pylist()]
            # What links have joined meanwhile is one.
            joined = np.unique(group.column("root").to_numpy(), return_inverse=True)[1]
            a, b = [], []
            for i, j in _open_of(group).tolist():
                if joined[i] != joined[j] and _similarity_of(sets[i], sets[j], sent.value) >= similarity:
                    joined[joined == joined[j]] = joined[i]
                    a.append(node[i])
                    b.append(node[j])
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, _ID), "b": pa.array(b, _ID)})

    of = sets.withColumnRenamed("txt", "of")
    ready = members.join(of, F.col("node.txt") == F.col("of")).drop("of")
    kind = "struct<doc:long,txt:binary>"
    return kept_table(_together(ready).mapInArrow(run, f"a {kind}, b {kind}"), "near-links")


def _with_open_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in _grouped(batches, _UNIT):
        some = np.unique(_open_of(group))
        if len(some):
            yield from group.take(pa.array(some)).combine_chunks().to_batches()


def _units(met: DataFrame) -> DataFrame:
    """The texts of each band in which components meet, for each two parts that are compared.

    A band of more than ``MEET_AT_ONCE`` texts is in parts of its largest component, which need not be
    compared with each other, and in parts of the other texts, which are compared with all parts.
    """
    bands = kept_table(met.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(
        F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("root", F.struct("n", "root")).alias("main"),
        F.count(F.lit(1)).alias("roots")).where("roots > 1"), "near-open")
    split = F.col("n") > MEET_AT_ONCE
    mains = F.when(split, F.ceil(F.col("most") / MEET_AT_ONCE)).otherwise(0).cast("int")
    others = F.when(split, F.ceil((F.col("n") - F.col("most")) / MEET_AT_ONCE)).otherwise(1).cast("int")
    is_main = split & (F.col("root") == F.col("main"))
    side = F.when(is_main, others + F.pmod(F.xxhash64("node"), mains)).otherwise(
        F.pmod(F.xxhash64("node"), others)).cast("int")
    last = F.when(is_main, others).otherwise(others + mains) - 1
    dealt = met.join(bands, "key").select(
        "key", side.alias("side"), F.explode(F.sequence(F.lit(0), last)).alias("to"), "band", "root", "node", "again")
    return dealt.select("key", F.least("side", "to").alias("i"), F.greatest("side", "to").alias("j"), "side",
                        "band", "root", "node", "again")


# ---- classes ---------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its connected component, for every node of a link.

    Every node hands its least neighbour to its other neighbours, first to the larger ones, then
    to the smaller ones (alternating stars), until nothing changes. Each round is a table.
    """
    spark, folder = links.sparkSession, fresh_folder(links.sparkSession, "llm-components")
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                   f"{folder}/0")
    turn, before = 0, _checksum(edges)
    while True:
        turn += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{folder}/{turn}-least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), f"{folder}/{turn}-large")
        small_least = stored(large.groupBy("u").agg(F.min("v").alias("m")), f"{folder}/{turn}-small")
        handed = large.join(small_least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = stored(handed.where("u <> v").unionByName(
            small_least.select("u", F.col("m").alias("v"))).distinct(), f"{folder}/{turn}")
        after = _checksum(new)
        if after == before:
            roots = spark.read.schema(new.schema).parquet(f"{folder}/{turn}")
            return roots.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                roots.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        edges, before = new, after


def _checksum(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges only, for all practical purposes: a count and 128 bits, one row."""
    both = [F.bit_xor(F.xxhash64(F.lit(salt), "u", "v")) for salt in (1, 2)]
    return tuple(edges.agg(F.count(F.lit(1)), *both).first())


def text_key(doc_id: str, text: str) -> list[Column]:
    """What tells a document: ``key`` (its id, never null) and ``txt`` (digest of its text)."""
    return [F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_NO_ID)).alias("key"),
            digest16(F.coalesce(F.col(text), F.lit(""))).alias("txt")]


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id``, ``key`` and ``txt`` (as ``text_key``), ``class_id`` (the least ``doc_id`` of the
    class) and ``kept`` (whether the row is the one that stays) for every row of ``docs``.

    Of rows with the same ``doc_id`` and text none is told from the others: all have ``kept``.
    """
    keyed = docs.select(*text_key("doc_id", "text"), "text").withColumnRenamed("key", "doc")
    weights = feature_weights(keyed)
    signed = kept_table(_signed(keyed, weights), "near-signed")
    texts = signed.where("bands IS NOT NULL").groupBy("txt").agg(
        F.min("doc").alias("doc"), F.first("samples").alias("samples"), F.first("bands").alias("bands"),
        F.first("once").alias("once"), F.first("once_bands").alias("once_bands"))
    nodes = kept_table(texts.select(
        F.struct("doc", "txt").alias("node"), "samples", "bands", "once", "once_bands"), "near-nodes")
    posts = _meeting(nodes)
    sets = _sets_of(posts, keyed)
    roots = components(_links(_candidates(nodes, posts), sets, weights, similarity))
    more = _links_left(posts, nodes, roots, sets, weights, similarity)
    placed = nodes.select("node").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    if more is not None:
        # The links found last join components: only those are put together again, by their roots.
        placed = kept_table(placed, "near-first-roots")
        for side in ("a", "b"):
            of = placed.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
            more = more.join(of, side)
        joined = components(more.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
        joined = joined.select(F.col("node").alias("root"), F.col("root").alias("joined"))
        placed = placed.join(joined, "root", "left").select("node", F.coalesce("joined", "root").alias("root"))
    placed = kept_table(placed.select(F.col("node.txt").alias("txt"), "root"), "near-placed")
    # A text without a word is a class of its own.
    out = signed.select("doc", "txt").join(placed, "txt", "left").withColumn(
        "root", F.coalesce("root", F.struct("doc", "txt")))
    real = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return out.select(real("doc").alias("doc_id"), F.col("doc").alias("key"), "txt", real("root.doc").alias("class_id"),
                      (F.struct("doc", "txt") == F.col("root")).alias("kept"))


ship_by_value(__name__)
