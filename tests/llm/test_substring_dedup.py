import random

from tillmark.llm import substring_dedup as sd


def brute(docs: dict[int, str]) -> dict[int, tuple[int, str]]:
    seen, out = set(), {}
    for d in sorted(docs):
        words, gone = docs[d].encode().split(), set()
        for a in range(len(words) - 19):
            w = tuple(words[a: a + 20])
            if w in seen:
                gone.update(range(a, a + 20))
            seen.add(w)
        out[d] = (len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode())
    return out


def test_matches_brute_force(docs_of):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randrange(15, 90))] for _ in range(6)]
    texts = {}
    for d in range(60):
        words = []
        for _ in range(rng.randrange(1, 6)):
            if rng.random() < 0.5:
                p = rng.choice(passages)
                a = rng.randrange(len(p))
                words += p[a: a + rng.randrange(10, 80)]
            else:
                words += [rng.choice(vocabulary) for _ in range(rng.randrange(1, 40))]
        texts[d] = " ".join(words)
    texts[60] = "ha " * 100            # every window is the same
    texts[61] = "ab cd " * 60          # and of period two
    texts[62] = texts[0]               # an exact copy
    texts[63] = "é x\x1cy  z " * 30  # other spaces are part of words
    got = {r["doc_id"]: (r["n_removed"], r["kept"]) for r in sd.dedup_substrings(docs_of(*texts.items())).collect()}
    assert got == brute(texts)


def test_factors_point_to_equal_words(docs_of):
    rng = random.Random(9)
    words = [f"v{rng.randrange(10 ** 6)}" for _ in range(300)]
    texts = {1: " ".join(words), 2: " ".join(["x"] * 7 + words[40:150] + ["y"] + words[200:260])}
    rows = {r["doc_id"]: r for r in sd.dedup_substrings(docs_of(*texts.items())).collect()}
    assert rows[1]["factors"] == []
    found = [(f["start"], f["length"], f["ref"], f["ref_start"]) for f in rows[2]["factors"]]
    assert found == [(7, 110, 1, 40), (118, 60, 1, 200)]


def test_hard_rows(docs_of):
    long = " ".join(f"q{i}" for i in range(50_000))
    passage = " ".join(f"p{i}" for i in range(30))
    rows = sd.dedup_substrings(docs_of(
        (1, None), (2, ""), (3, " \n"), (4, "short"), (5, passage), (5, passage), (None, passage), (6, long),
        (7, long + " tail"))).collect()
    got = sorted(((r["doc_id"] is not None, r["doc_id"], r["n_words"], r["n_removed"]) for r in rows), key=repr)
    assert got == sorted([(False, None, 30, 0), (True, 1, 0, 0), (True, 2, 0, 0), (True, 3, 0, 0), (True, 4, 1, 0),
                          (True, 5, 30, 30), (True, 5, 30, 30), (True, 6, 50_000, 0),
                          (True, 7, 50_001, 50_000)], key=repr)
    assert sd.dedup_substrings(docs_of()).count() == 0
