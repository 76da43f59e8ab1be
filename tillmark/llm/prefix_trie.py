"""A trie of conversations by their turns, as ternary search trees over range shards.

A turn is known by a code: a digest of role and text, and how many bytes the text has. A conversation
is cut into blocks of ``BLOCK`` turns, each a string of codes; a block also carries a digest of all turns
before it, so that however long a conversation is, a row is short. Conversations with the same block
after the same turns are counted as one row before anything else is done with them.

Rows are sorted by range, and each run of about ``SHARD_ROWS`` rows is a shard. A task numbers the codes
of a shard in their order (its dictionary), puts the rows into a ternary search tree, the middle row of
each stretch first, and goes back over the nodes, children before parents, adding up members, leaves and
savings. A node can stand in two shards only where it lies on the way to the first or last row of one:
such boundary nodes are merged by their prefix, and what they lack (members elsewhere, children, the
conversation that stands for their parent) is made up by joins on those few.

Blocks after the first are gone through before the others: what hangs below the end of a block comes to
it as a sum. A node's conversations that end there are hashed as a stream, from strings of up to
``IDS_A_PART`` neighbouring ids made before the shuffle; it is one hash of one list, so it is made in one
task, from few rows.

Defined results: null role or text counts as empty; turns come by ``turn``, null first, equal ones by
their digest. Rows without a ``conv_id`` belong to no conversation. An empty table gives no nodes. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmark.llm.common import digest16, kept_table, ship_by_value

BLOCK = 64
SHARD_ROWS = 20_000
IDS_A_PART = 4_096
CODE_BYTES = 20
_EMPTY = hashlib.sha256().hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` from 0 on, and ``code`` (16 bytes of digest, 4 of length) of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary") for c in ("role", "text"))
    size = F.octet_length(role).cast("string").cast("binary")
    length = F.unhex(F.lpad(F.hex(F.octet_length(text)), 8, "0"))
    coded = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.concat(digest16(F.concat(size, F.lit(b":"), role, text)), length).alias("code"))
    # The running number is a stream within a task: it holds no conversation.
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "code")
    return coded.select("conv_id", (F.row_number().over(order) - 1).cast("bigint").alias("pos"), "code")


def rebuilt(own: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """All conversations, and their turns when the first few come from the first of their group.

    Conversation c takes the first h turns of conversation ``c - c % group`` (h from a hash of its id,
    below ``heads``), and then its own after its first h.
    """
    ids = own.select("conv_id").distinct().select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % heads).alias("h"))
    first = own.where(F.col("pos") < heads - 1)
    given = first.groupBy("conv_id").agg(F.count(F.lit(1)).alias("has")).withColumnRenamed("conv_id", "base")
    known = ids.join(given, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("has", F.lit(0))).alias("taken"))
    taken = known.where("h > 0").join(first.withColumnRenamed("conv_id", "base"), "base").where("pos < h")
    kept = own.join(known, "conv_id").where("pos >= h").withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    columns = ["conv_id", "pos", "code"]
    return ids.select("conv_id"), taken.select(columns).unionByName(kept.select(columns))


def blocks(ids: DataFrame, sequence: DataFrame, size: int = BLOCK) -> DataFrame:
    """``conv_id``, ``block``, ``p`` and ``q`` (what came before), ``seg`` (codes joined) and ``np``,
    ``nq`` (what comes before the next block).

    The last block of a conversation has fewer than ``size`` turns, and may have none.
    """
    codes = F.array_sort(F.collect_list(F.struct("pos", "code")))  # size turns at most
    joined = F.aggregate(codes, F.unhex(F.lit("")), lambda have, x: F.concat(have, x["code"]))
    cut = sequence.groupBy("conv_id", F.floor(F.col("pos") / size).alias("block")).agg(
        joined.alias("seg"), F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("pos", "code")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit("again"), "code", "pos")).alias("y"))
    cut = kept_table(cut, "blocks")
    nothing = [F.lit(0).cast("bigint").alias(c) for c in ("p", "q")]
    empty = F.unhex(F.lit("")).alias("seg")
    first = F.lit(0).cast("bigint").alias("block")
    short = cut.where((F.col("block") == 0) & (F.col("n") < size)).select("conv_id", "block", *nothing, "seg")
    none = ids.join(cut.where("block = 0"), "conv_id", "left_anti").select("conv_id", first, *nothing, empty)

    # Only conversations of a block and more: their blocks in turn, again as a stream.
    in_turn = Window.partitionBy("conv_id").orderBy("block")
    upto = in_turn.rowsBetween(Window.unboundedPreceding, 0)
    long = cut.where((F.col("block") > 0) | (F.col("n") == size)).select(
        "*", F.bit_xor("x").over(upto).alias("np"), F.bit_xor("y").over(upto).alias("nq"),
        F.lead("block").over(in_turn).alias("next"))
    own = F.struct("block", F.expr("np ^ x").alias("p"), F.expr("nq ^ y").alias("q"), "seg")
    ending = F.struct((F.col("block") + 1).alias("block"), F.col("np").alias("p"), F.col("nq").alias("q"), empty)
    ends_here = (F.col("n") == size) & F.col("next").isNull()
    spread = long.select("conv_id", "np", "nq", F.explode(
        F.when(ends_here, F.array(own, ending)).otherwise(F.array(own))).alias("b")).select("conv_id", "b.*", "np", "nq")
    full = F.octet_length("seg") == size * CODE_BYTES
    spread = spread.withColumns({c: F.when(full, F.col(c)) for c in ("np", "nq")})
    return short.unionByName(none).unionByName(spread, allowMissingColumns=True)


def _parts(rows: DataFrame, size: int) -> DataFrame:
    """Equal blocks as one row for each ``IDS_A_PART`` ids in a row, with the ids that end there."""
    ends = F.octet_length("seg") < size * CODE_BYTES
    part = F.when(ends, F.floor(F.col("conv_id") / IDS_A_PART)).otherwise(0)
    listed = F.array_join(F.array_sort(F.collect_list(F.when(ends, F.col("conv_id")))), ",")  # IDS_A_PART at most
    return rows.groupBy("block", "p", "q", "seg", part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), listed.alias("ids"),
        F.first("np").alias("np"), F.first("nq").alias("nq"))


@dataclass
class Row:
    """Equal blocks: what came before, the codes, members, and what hangs below a full one."""

    root: tuple[int, int, int]
    seg: bytes
    n: int
    least: int
    below: tuple[int, int, int, str] | None
    listed: bool = False
    hash: object = field(default_factory=hashlib.sha256)

    def take(self, n: int, least: int, ids: str) -> None:
        self.n += n
        self.least = min(self.least, least)
        self.list(ids)

    def list(self, ids: str) -> None:
        if ids:
            self.hash.update((f",{ids}" if self.listed else ids).encode())
            self.listed = True

    def ends(self) -> str:
        return self.hash.hexdigest() if self.listed else _EMPTY


class Tree:
    """A ternary search tree: below a node, a search tree of the next codes by ``less`` and ``more``,
    each with the node that follows it as itself. Node 0 stands for no code."""

    def __init__(self):
        self.code, self.less, self.more, self.below, self.parent = [-1], [-1], [-1], [-1], [-1]

    def child(self, node: int, code: int) -> int:
        at = self.below[node]
        if at < 0:
            self.below[node] = made = self._new(node, code)
            return made
        while self.code[at] != code:
            side = self.less if code < self.code[at] else self.more
            if side[at] < 0:
                made = self._new(node, code)
                side[at] = made
                return made
            at = side[at]
        return at

    def _new(self, parent: int, code: int) -> int:
        for column, value in ((self.code, code), (self.less, -1), (self.more, -1), (self.below, -1),
                              (self.parent, parent)):
            column.append(value)
        return len(self.code) - 1


def _middle_first(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of every stretch before the rest, so that sorted rows make level trees."""
    waiting = [(0, n)]
    while waiting:
        begin, end = waiting.pop()
        if begin < end:
            middle = (begin + end) // 2
            yield middle
            waiting += [(middle + 1, end), (begin, middle)]


_NODE = {"depth": pa.int64(), "conv_id": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(),
         "n_leaves": pa.int64(), "saved": pa.int64(), "parent_conv_id": pa.int64(), "ends": pa.string(),
         "key": pa.binary(), "parent_key": pa.binary(), "above": pa.list_(pa.binary()), "size": pa.int64(),
         "is_open": pa.bool_(), "block": pa.int64(), "p": pa.int64(), "q": pa.int64(), "step": pa.int64()}
_NODE_TYPE = ("depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved long, "
              "parent_conv_id long, ends string, key binary, parent_key binary, above array<binary>, "
              "size long, is_open boolean, block long, p long, q long, step long")


def _prefix_key(root: tuple[int, int, int], prefix: bytes) -> bytes:
    return hashlib.blake2b(struct.pack("<3q", *root) + prefix, digest_size=16).digest()


def _nodes_of(rows: list[Row], size: int, at_start: bool, at_end: bool) -> list[tuple]:
    """The nodes of sorted rows of one shard that share what came before.

    ``at_start`` and ``at_end`` say that the rows before or after may share it too.
    """
    root = rows[0].root
    flat = np.frombuffer(b"".join(r.seg for r in rows), np.dtype((np.void, CODE_BYTES)))
    dictionary, codes = np.unique(flat, return_inverse=True)
    sizes = [int.from_bytes(bytes(c)[16:], "big") for c in dictionary]
    until = np.cumsum([0, *[len(r.seg) // CODE_BYTES for r in rows]]).tolist()
    codes = codes.tolist()
    tree, end_of = Tree(), [0] * len(rows)
    for i in _middle_first(len(rows)):
        node = 0
        for code in codes[until[i]: until[i + 1]]:
            node = tree.child(node, code)
        end_of[i] = node

    count = len(tree.code)
    members, least = [0] * count, [None] * count
    children, leaves, saved = [0] * count, [0] * count, [0] * count
    ends, steps, is_open = [_EMPTY] * count, [0] * count, [False] * count
    for row, node in zip(rows, end_of, strict=True):
        members[node], least[node], ends[node] = row.n, row.least, row.ends()
        if row.below is not None:
            children[node], leaves[node], saved[node], ends[node] = row.below
            is_open[node] = True
    for node in range(1, count):  # parents are made before their children
        steps[node] = steps[tree.parent[node]] + 1
    boundary: dict[int, bytes] = {}
    for i in [0] * at_start + [len(rows) - 1] * at_end:
        node = end_of[i]
        while node >= 0:
            boundary.setdefault(node, _prefix_key(root, rows[i].seg[: steps[node] * CODE_BYTES]))
            node = tree.parent[node]

    for node in range(count - 1, -1, -1):
        if node not in boundary:  # what a boundary node is worth shows when it is merged
            if not children[node] and not is_open[node]:
                leaves[node] = 1
            if node:
                saved[node] += (members[node] - 1) * sizes[tree.code[node]]
        if node:
            up = tree.parent[node]
            members[up] += members[node]
            if least[up] is None or least[node] < least[up]:
                least[up] = least[node]
            leaves[up] += leaves[node]
            saved[up] += saved[node]
            if node not in boundary:
                children[up] += 1

    out = []
    for node in range(count):
        up, key = tree.parent[node], boundary.get(node)
        above = []
        if key is not None:
            at = up
            while at >= 0:
                above.append(boundary[at])
                at = tree.parent[at]
        out.append((root[0] * size + steps[node], least[node], members[node], children[node], leaves[node],
                    saved[node], None if up < 0 or up in boundary else least[up], ends[node], key,
                    boundary.get(up), above, sizes[tree.code[node]] if node else 0, is_open[node], *root,
                    steps[node]))
    return out


def _shards(parts: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[Row]]:
    """Runs of ``limit`` rows, equal blocks made one."""
    run: list[Row] = []
    for batch in parts:
        columns = [batch.column(c).to_pylist() for c in (
            "block", "p", "q", "seg", "n", "least", "ids", "children", "leaves", "saved", "ends")]
        for block, p, q, seg, n, least, ids, *below in zip(*columns, strict=True):
            root = (block, p, q)
            if run and run[-1].seg == seg and run[-1].root == root:
                run[-1].take(n, least, ids)
                continue
            if len(run) >= limit:
                yield run
                run = []
            run.append(Row(root, seg, n, least, None if below[0] is None else tuple(below)))
            run[-1].list(ids)
    if run:
        yield run


def _boundary_nodes(nodes: DataFrame) -> DataFrame:
    """Boundary nodes, each once, with all they lack: few for every shard."""
    merged = nodes.where("key IS NOT NULL").groupBy("key").agg(
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        F.min("conv_id").alias("conv_id"), F.max(F.when(F.col("ends") != _EMPTY, F.col("ends"))).alias("ends"),
        F.max("is_open").alias("is_open"),
        *[F.first(c).alias(c) for c in ("depth", "parent_key", "above", "size", "block", "p", "q", "step")])
    merged = kept_table(merged, "boundary-nodes")
    below = merged.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(
        F.count(F.lit(1)).alias("kids"))
    whole = merged.join(below, "key", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("kids", F.lit(0))).drop("kids")
    whole = whole.withColumn("leaf", ((F.col("n_children") == 0) & ~F.col("is_open")).cast("bigint"))
    whole = whole.withColumn("own", (F.col("n_convs") - 1) * F.col("size"))
    worth = whole.select(F.explode(F.array_append("above", F.col("key"))).alias("key"), "leaf", "own").groupBy(
        "key").agg(F.sum("leaf").alias("more_leaves"), F.sum("own").alias("more_saved"))
    tops = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("top"))
    return (
        whole.join(worth, "key").join(tops, "parent_key", "left")
        .withColumn("n_leaves", F.col("n_leaves") + F.col("more_leaves"))
        .withColumn("saved", F.col("saved") + F.col("more_saved"))
        .withColumn("ends", F.coalesce("ends", F.lit(_EMPTY)))
        .withColumn("parent_conv_id", F.col("top"))
    )


_OUT = ["depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends",
        "block", "p", "q", "step"]


def _trie(parts: DataFrame, size: int, shard_rows: int, purpose: str) -> DataFrame:
    """The nodes of all blocks in ``parts``, those before a block's first turn (``step`` 0) too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _shards(batches, shard_rows):
            begin = 0
            for i in range(1, len(rows) + 1):
                if i < len(rows) and rows[i].root == rows[begin].root:
                    continue
                made = _nodes_of(rows[begin:i], size, begin == 0, i == len(rows))
                for at in range(0, len(made), 50_000):
                    columns = zip(*made[at: at + 50_000], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, _NODE.values(), strict=True)], names=list(_NODE))
                begin = i

    spread = parts.repartitionByRange("block", "p", "q", "seg").sortWithinPartitions("block", "p", "q", "seg", "part")
    nodes = kept_table(spread.mapInArrow(run, _NODE_TYPE), purpose)
    boundary = _boundary_nodes(nodes)
    inner = nodes.where("key IS NULL")
    tops = boundary.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("top"))
    hanging = inner.where("parent_key IS NOT NULL").join(tops, "parent_key").withColumn("parent_conv_id", F.col("top"))
    return (
        inner.where("parent_key IS NULL").select(_OUT)
        .unionByName(hanging.select(_OUT)).unionByName(boundary.select(_OUT))
    )


def _hanging(parts: DataFrame, rows: DataFrame, size: int, shard_rows: int) -> DataFrame:
    """For blocks after the first, what hangs below their top in all: ``children``, ``leaves``,
    ``saved`` and ``ends``."""
    # Ends of full blocks are left open: what goes on there is in the block after.
    full = F.octet_length("seg") == size * CODE_BYTES
    open_ends = [F.when(full, F.lit("" if t == "string" else 0).cast(t)).alias(c) for c, t in _BELOW.items()]
    tops = _trie(parts.select("*", *open_ends), size, shard_rows, "trie-tails").where("step = 0")
    tops = kept_table(tops, "trie-tops")
    # A block's sums count for the conversation that stands for it; a conversation's sums from a block
    # on, added over the conversations of that block, are those of all blocks below it, each once.
    worth = rows.join(
        tops.select("block", "p", "q", "conv_id", "n_leaves", "saved"), ["block", "p", "q", "conv_id"], "left")
    onward = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, 0)
    summed = worth.select("block", "p", "q", *[
        F.sum(F.coalesce(c, F.lit(0))).over(onward).alias(c) for c in ("n_leaves", "saved")])
    all_below = summed.groupBy("block", "p", "q").agg(F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return tops.select("block", "p", "q", F.col("n_children").alias("children"), "ends").join(
        all_below, ["block", "p", "q"])


_BELOW = {"children": "bigint", "leaves": "bigint", "saved": "bigint", "ends": "string"}


def trie(ids: DataFrame, sequence: DataFrame, size: int = BLOCK, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A row per node of the conversations ``ids`` with the turns ``sequence`` (conv_id, pos, code).

    Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.
    """
    rows = kept_table(blocks(ids, sequence, size), "trie-rows")
    parts = kept_table(_parts(rows, size), "trie-parts")
    full = F.octet_length("seg") == size * CODE_BYTES
    tails = parts.where("block > 0")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in _BELOW.items()]
    if tails.isEmpty():  # no conversation has more than a block: nothing hangs anywhere
        known = parts.select("*", *nothing)
    else:
        below = _hanging(tails, rows.where("block > 0").select("conv_id", "block", "p", "q"), size, shard_rows)
        below = below.select((F.col("block") - 1).alias("block"), F.col("p").alias("np"), F.col("q").alias("nq"), *_BELOW)
        known = parts.where(full).join(below, ["block", "np", "nq"]).select(*parts.columns, *_BELOW).unionByName(
            parts.where(~full).select("*", *nothing))
    nodes = _trie(known, size, shard_rows, "trie-nodes")
    # The top of a later block is the end of the one before.
    return nodes.where("step > 0 OR block = 0").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, size: int = BLOCK, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The trie of the rebuilt conversations of a table (conv_id, turn, role, text)."""
    own = kept_table(turns(conversations), "turns")
    return trie(*rebuilt(own), size=size, shard_rows=shard_rows)


ship_by_value(__name__)
