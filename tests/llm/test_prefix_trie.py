"""The trie of conversations against a plain one of dictionaries."""

import hashlib
import random
import zlib

import pytest

from tillmark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    by_conv = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:".encode() + (role + text).encode()).digest()[:16]
            key += len(text.encode()).to_bytes(4, "big")
            by_conv.setdefault(conv, []).append((turn is not None, turn or 0, key, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(ts)] for c, ts in by_conv.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
    members = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children, out = {}, {}
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        kids = children.get(prefix, [])
        leaves[prefix] = sum(leaves[k] for k in kids) if kids else 1
        own_saved = (len(members[prefix]) - 1) * (len(prefix[-1][1].encode()) if prefix else 0)
        saved[prefix] = own_saved + sum(saved[k] for k in kids)
        ends = ",".join(map(str, sorted(c for c in members[prefix] if len(rebuilt[c]) == len(prefix))))
        out[prefix] = (min(members[prefix]), len(prefix), min(members[prefix[:-1]]) if prefix else None,
                       len(members[prefix]), len(kids), leaves[prefix], saved[prefix],
                       hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=str)


def made(df):
    return sorted(map(tuple, df.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256").collect()), key=str)


def conversations(seed, n, words, longest):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(n * 3), n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(words)))
    return rows


WORDS = ["", "a", "be", "çé", None, "日本"]


@pytest.mark.parametrize(("size", "shard_rows"), [(64, 20_000), (3, 20_000), (2, 2), (64, 3), (1, 1)])
def test_equals_brute_force(spark, size, shard_rows):
    rows = conversations(size, 60, WORDS[:3], 7)
    rows += [(c, t, "user", "same") for c in range(1000, 1030) for t in range(9)]  # copies
    rows += [(2000 + c, 0, "user", "first") for c in range(20)]
    rows += [(3000, None, "x", "y"), (3000, None, "x", "b"), (3000, 2, "x", "y"), (3000, 2, "x", "y"), (None, 1, "x", "z")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'e' AS seg", "1 AS pos", "'k' AS code").repartition(3)
    assert made(prefix_trie.conversation_trie(df, size, shard_rows)) == brute(rows)


def test_long_conversations_of_many_blocks(spark):
    rows = [(c, t, "u", f"turn {t % 7}" if t < 150 + c else f"own {c}") for c in (0, 5, 10, 16, 22) for t in range(200 + 64 * (c // 5))]
    rows += conversations(9, 20, WORDS, 130)
    df = spark.createDataFrame(rows, SCHEMA)
    assert made(prefix_trie.conversation_trie(df)) == brute(rows)


def test_many_copies_make_one_row_and_few_parts(spark):
    df = spark.range(50_000).selectExpr("id * 5 AS conv_id", "0L AS turn", "'u' AS role", "'same' AS text")
    rows = prefix_trie.blocks(*prefix_trie.rebuilt(prefix_trie.turns(df)))
    assert prefix_trie._parts(rows, prefix_trie.BLOCK).count() == 250_000 // prefix_trie.IDS_A_PART + 1
    got = made(prefix_trie.conversation_trie(df))
    ends = hashlib.sha256(",".join(str(5 * i) for i in range(50_000)).encode()).hexdigest()
    none = hashlib.sha256().hexdigest()
    assert got == [(0, 0, None, 50_000, 1, 1, 4 * 49_999, none), (0, 1, 0, 50_000, 0, 1, 4 * 49_999, ends)]


def test_no_conversation(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.conversation_trie(empty).count() == 0
    assert prefix_trie.conversation_trie(spark.createDataFrame([(None, 0, "a", "b")], SCHEMA)).count() == 0


def test_turnless_conversations_are_members_of_the_root(spark):
    # The first of the group is absent and all own turns are among those not taken.
    ids = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2][:6]
    rows = [(c, t, "u", "x") for c in ids for t in range(2)]
    got = made(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows) and got[0][3] == len(ids)
