"""The network of the secret scanner and its threshold come from all documents."""

import random

from tillmark.llm import secret_scan as ss


def shop_of(spark, n):
    rng = random.Random(6)
    pick = lambda chars, k: "".join(rng.choice(chars) for _ in range(k))
    rows = []
    for i in range(n):
        middle = [f"token = \"{pick('0123456789abcdef', 40)}\"", f"mail {pick('abcdef', 6)}.{i}@mail.example.com",
                  f"at {rng.randrange(255)}.{rng.randrange(255)}.{rng.randrange(255)}.17 on 2024-01-{i % 28 + 1:02}",
                  f"AKIA{pick('ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789', 16)}"][i % 4]
        rows.append((i, f"some words before {middle} and some after"))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_more_candidates_than_the_driver_takes_are_all_learned_from(spark, monkeypatch):
    docs = shop_of(spark, 2000)
    monkeypatch.setattr(ss, "MAX_CANDIDATES", 400)
    seen, counts = [], []
    averaged, margin_counts = ss._averaged, ss._margin_counts
    monkeypatch.setattr(ss, "_averaged", lambda dealt, shards, *rest: (
        seen.append((dealt.count(), shards)), averaged(dealt, shards, *rest))[1])
    monkeypatch.setattr(ss, "_margin_counts", lambda *args: (counts.append(margin_counts(*args)), counts[-1])[1])
    model = ss.train(docs)
    total = ss._windows(docs).count()
    assert total > 4 * 400 and [s for _, s in seen] == [-(-total // 400)] * ss.ROUNDS
    margin, kind, count = counts[0]
    assert seen[0][0] + count[kind < 2].sum() == total
    assert count[kind == 1].sum() == count[kind == 2].sum() > 0
    # The highest threshold that keeps the recall of findings kept apart, and of altered ones.
    score = 1 / (1 + ss.np.exp(-(model.slope * margin + model.shift)))
    kept = [count[(kind == k) & (score >= model.threshold)].sum() / count[kind == k].sum() for k in (1, 2)]
    assert min(kept) >= ss.RECALL
    texts = [r["text"] for r in docs.collect()]
    plain = [t for t in texts if "mail " in t or "on 2024" in t]
    assert sum(len(full) - len(base) for base, full in ss.all_findings(plain, model)) <= 0.02 * len(plain)
    found = ss.all_findings(["some words before ASIA7Q2K9ZP4M1XW8R5T and some after"], model)
    assert found[0][1] == [(18, 3, 38)]
    again = ss.train(docs)
    assert abs(again.threshold - model.threshold) < 1e-4
