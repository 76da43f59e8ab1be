import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tillmark.llm import near_dedup as nd


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def classes_by_brute_force(texts, similarity=0.8):
    sets, root = {d: shingles(t) for d, t in texts.items()}, {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def classes(df):
    return {r["doc_id"]: r["class_id"] for r in df.collect()}


def test_matches_brute_force(docs_of):
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(4000)}"
    texts, n = {}, 0
    for _ in range(40):
        base = [word() for _ in range(rng.randrange(3, 250))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            texts[n] = " ".join(copy)
            n += 1
    want = classes_by_brute_force(texts)
    got = classes(nd.near_duplicates(docs_of(*texts.items())))
    lost = [(a, b) for a in texts for b in texts if a < b and want[a] == want[b] and got[a] != got[b]]
    assert len(lost) <= 1
    sets = {d: shingles(t) for d, t in texts.items()}
    joined = [(a, b) for a in texts for b in texts if a < b and got[a] == got[b] and want[a] != want[b]]
    assert all(len(sets[a] & sets[b]) > 0.6 * len(sets[a] | sets[b]) for a, b in joined)


def test_large_group_of_near_copies(docs_of):
    """Copies near their original but not each other are one class, in bands that are split too."""
    rng = random.Random(1)
    base = [f"b{i}" for i in range(120)]
    texts = {}
    for d in range(700):
        copy = list(base)
        copy[rng.randrange(5, 115)] = f"x{d}"
        copy[rng.randrange(5, 115)] = f"y{d}"
        texts[d] = " ".join(copy if d != 350 else base)
    small = nd.MEET_AT_ONCE
    try:
        nd.MEET_AT_ONCE = 64
        got = classes(nd.near_duplicates(docs_of(*texts.items(), extra=False)))
    finally:
        nd.MEET_AT_ONCE = small
    near = [d for d, t in texts.items()
            if len(shingles(t) & shingles(texts[350])) >= 0.8 * len(shingles(t) | shingles(texts[350]))]
    assert sum(got[d] == got[350] for d in near) >= 0.999 * len(near)


def form_letters(rng, others, pairs):
    """Texts of one template, most just below a link, and pairs of them just above."""
    letters = []

    def letter(edits):
        words = [f"t{i}" for i in range(400)]
        for place, word in edits.items():
            words[5 * place + 2] = word
        letters.append(" ".join(words))

    def edits(places):
        return {place: f"x{rng.random()}" for place in places}

    for _ in range(others):
        letter(edits(rng.sample(range(80), 6)))
    for _ in range(pairs):
        places = rng.sample(range(80), 10)
        both = edits(places[:2])
        letter(both | edits(places[2:6]))
        letter(both | edits(places[6:]))
    return letters


def lost_pairs(texts, got):
    want = classes_by_brute_force(texts)
    assert len({want[d] for d in want}) < len(want)
    return [d for d in texts if want[d] != d and got[d] == d]


def test_near_pairs_among_many_texts_just_below(docs_of):
    texts = dict(enumerate(form_letters(random.Random(3), 240, 30)))
    got = classes(nd.near_duplicates(docs_of(*texts.items(), extra=False)))
    assert len(lost_pairs(texts, got)) <= 1


def test_near_pairs_in_crowded_bands(docs_of):
    """Near copies that a split band deals to different parts, beside a cluster that has all hubs."""
    rng = random.Random(4)
    letters = form_letters(rng, 100, 30)
    for d in range(300):
        words = [f"c{i}" if i % 50 == 7 else f"t{i}" for i in range(400)]
        words[rng.randrange(400)] = f"y{d}"
        letters.append(" ".join(words))
    texts = dict(enumerate(letters))
    small = nd.MEET_AT_ONCE
    try:
        nd.MEET_AT_ONCE = 32
        got = classes(nd.near_duplicates(docs_of(*texts.items(), extra=False)))
    finally:
        nd.MEET_AT_ONCE = small
    assert len(lost_pairs(texts, got)) <= 1


def test_copies_that_repeat_unequally(docs_of):
    texts = {}
    for d in range(0, 80, 2):
        words = [f"d{d}w{i}" for i in range(200)]
        texts[d] = " ".join(words)
        texts[d + 1] = " ".join(words + words[-10:] * 30)
    assert len(set(classes_by_brute_force(texts).values())) == 40
    got = classes(nd.near_duplicates(docs_of(*texts.items())))
    assert len(lost_pairs(texts, got)) <= 1


def test_hard_rows(docs_of):
    long = " ".join(f"t{i % 7000}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "One"), (6, "same words in this text"),
            (6, "same words in this text"), (None, "same words in this text"), (7, long), (8, long + " end"),
            (9, "other words")]
    got = sorted(((r["doc_id"], r["class_id"], r["kept"]) for r in nd.near_duplicates(docs_of(*rows)).collect()), key=repr)
    want = [(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (6, None, False), (6, None, False),
            (None, None, True), (7, 7, True), (8, 7, False), (9, 9, True)]
    assert got == sorted(want, key=repr)
    assert nd.near_duplicates(docs_of()).count() == 0


def test_samples_agree_as_often_as_weights_are_alike():
    rng = np.random.default_rng(0)
    weights = (1 + rng.random(1 << nd.FEATURE_BITS)).astype(np.float32)
    sampler = nd.Sampler(weights)
    agree, want = [], []
    for _ in range(40):
        feature = np.sort(rng.choice(1 << nd.FEATURE_BITS, 300, replace=False))
        a, b = feature[:240], feature[60:]
        often = [rng.integers(1, 3, len(x)) for x in (a, b)]
        drawn = [sampler.draw(np.zeros(len(x), int), x, o, 1)[0] for x, o in zip((a, b), often, strict=True)]
        agree.append((drawn[0] == drawn[1]).mean())
        full = np.zeros((2, 1 << nd.FEATURE_BITS))
        full[0, a], full[1, b] = weights[a] * often[0], weights[b] * often[1]
        want.append(full.min(0).sum() / full.max(0).sum())
    assert abs(np.mean(agree) - np.mean(want)) < 0.04


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (11, 12), (20, 5), (5, 6), (6, 20)] + [(100 + i, 101 + i) for i in range(17)]
    kind = "struct<doc:bigint,txt:binary>"
    df = spark.createDataFrame([((a, b"t"), (b, b"t")) for a, b in edges], f"a {kind}, b {kind}")
    found = defaultdict(set)
    for r in nd.components(df).collect():
        found[r["root"]["doc"]].add(r["node"]["doc"])
    assert dict(found) == {1: {1, 2, 3, 4}, 10: {10, 11, 12}, 5: {5, 6, 20}, 100: set(range(100, 118))}


def test_texts_not_asked_for_are_left_out_before_sets_are_made(spark, monkeypatch):
    docs = spark.range(2000).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("txt"), "id")
    asked = docs.where("id % 10 = 0").select("txt")
    left = {r["id"] for r in nd._likely_asked(docs, asked).collect()}
    assert set(range(0, 2000, 10)) <= left and len(left) < 220
    monkeypatch.setattr(nd, "ASKED_BITS", 6)  # one word of bits: all of them may stay, none is lost
    assert set(range(0, 2000, 10)) <= {r["id"] for r in nd._likely_asked(docs, asked).collect()}
    assert nd._likely_asked(docs, asked.where("false")).count() == 0


def test_samples_are_joined_to_the_rows_that_meet(spark):
    node = "struct(cast(id as bigint) as doc, cast(cast(id as string) as binary) as txt) as node"
    nodes = spark.range(4).selectExpr(
        node, "cast('s' as binary) as samples", "array(7L, id) as bands",
        "case when id = 3 then cast('o' as binary) end as once", "case when id = 3 then array(id, 2L) end as once_bands")
    met = nd._meeting(nodes)
    assert "samples" not in met.columns
    rows = sorted((r["key"], r["band"], r["node"]["doc"], bytes(r["samples"])) for r in nd._with_samples(met, nodes).collect())
    assert rows == [(2, 1, 2, b"s"), (2, 1, 3, b"o"), *[(7, 0, i, b"s") for i in range(4)]]
