import math
import random

import pytest

from tillmark.llm import toxicity as tx


def corpus(spark):
    rng = random.Random(2)
    vocabulary = [f"{a}{b}{c}" for a in ("ba", "ke", "lo") for b in ("ri", "mu", "ta") for c in ("n", "s", "", "lo")]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 200))]
        bad = i % 5 == 0
        if bad:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["grumbo", "snarkle", "vilk" + rng.choice("aeio")]))
        if i % 7 == 1 and not bad:
            words.insert(3, "dear snarkle")
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_learns_words_stems_and_exceptions(spark):
    docs, labels = corpus(spark)
    model = tx.train(docs, labels)
    assert " grumbo " in model.terms and any(t.startswith(" vilk") for t in model.terms)
    got = {r["row"]["doc_id"]: r["predicted"] for r in tx.score(docs, model).collect()}
    want = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert sum(got[i] == want[i] for i in got) >= 0.95 * len(got)


def test_exception_phrases_do_not_count():
    model = tx.ToxicityModel({" snarkle ": 5.0}, [" dear snarkle "], (-5.0, 3.0, 1.0))
    automaton = model.automaton()
    assert model.hits(tx.fold("you snarkle!"), automaton) == 5.0
    assert model.hits(tx.fold("my dear snarkle."), automaton) == 0.0
    assert model.hits(tx.fold("dear snarkle, snarkle"), automaton) == 5.0


def test_folding():
    assert tx.fold("Gr0mb0, GRUMBО! \"5narkle\" s.n.a.r.k.l.e") == " grombo grumbo snarkle snarkle "
    assert tx.fold("сидеть 2024 10") == " сидеть 2024 10 "
    assert tx.fold("") == " " and tx.fold(" .. ") == " "


def test_hard_rows(spark, docs_of):
    docs, labels = corpus(spark)
    model = tx.train(docs, labels)
    rows = [(1, None), (2, ""), (3, "grumbo grumbo grumbo"), (3, "grumbo grumbo grumbo"), (None, "loris"),
            (4, "baris " * 50_000 + "grumbo")]
    got = [(r["row"]["doc_id"], r["score"], r["predicted"]) for r in tx.score(docs_of(*rows), model).collect()]
    assert len(got) == 6 and all(0 <= s <= 1 for _, s, _ in got)
    assert [p for i, _, p in got if i == 3] == [1, 1] and [p for i, _, p in got if i in (1, 2)] == [0, 0]
    assert tx.score(docs_of(), model).count() == 0


def test_no_labels(spark, docs_of):
    _, labels = corpus(spark)
    model = tx.train(docs_of((1, "text")), labels.where("toxic = 0"))
    assert [tuple(r) for r in tx.score(docs_of((1, "text")), model).select("score", "predicted").collect()] == [(0.0, 0)]


def naive_hits(model, folded):
    """Every term and exception held against every place. The space that ends an exception is where the
    next word begins, which counts."""
    spared = [(i, i + len(e) - 1) for e in model.exceptions for i in range(len(folded)) if folded.startswith(e, i)]
    found = {}
    for i in range(len(folded)):
        weights = [w for t, w in model.terms.items() if folded.startswith(t, i)]
        if weights and max(weights) > 0 and not any(a <= i < b for a, b in spared):
            found[i] = max(weights)
    return sum(found.values())


def test_hits_as_by_brute_force():
    rng = random.Random(6)
    for _ in range(60):
        words = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 5))) for _ in range(40)]
        terms = {(f" {w}" if rng.random() < 0.5 else f" {w} "): rng.randrange(1, 9) / 2 for w in rng.sample(words, 6)}
        exceptions = [" " + " ".join(rng.sample(words, 2)) + " " for _ in range(4)]
        model = tx.ToxicityModel(terms, exceptions)
        text = tx.fold(" ".join(rng.choice(words) for _ in range(120)))
        assert model.hits(text, model.automaton()) == pytest.approx(naive_hits(model, text))


def test_scores_as_by_brute_force(spark):
    docs, labels = corpus(spark)
    model = tx.train(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    a, b, c = model.curve
    for r in tx.score(docs, model).collect():
        folded = tx.fold(texts[r["row"]["doc_id"]])
        hits, words = naive_hits(model, folded), len(texts[r["row"]["doc_id"]].split())
        z = a + b * math.log1p(hits) + c * math.log1p(1000 * hits / (words + 20))
        want = 1 / (1 + math.exp(-z))
        assert r["score"] == pytest.approx(want, abs=1e-6)
        assert r["predicted"] == int(r["score"] >= tx.THRESHOLD)


def test_an_empty_table_of_labels(spark, docs_of):
    _, labels = corpus(spark)
    model = tx.train(docs_of((1, "text"), (2, None)), labels.limit(0))
    assert tx.score(docs_of((1, "text")), model).select("score", "predicted").collect() == [(0.0, 0)]


def test_ids_that_repeat_in_the_documents(spark):
    """The sample is of ids; what comes to the driver is bounded by rows."""
    docs, labels = corpus(spark)
    many = docs.unionAll(docs.where("doc_id IN (5, 8)").crossJoin(spark.range(3000)).select("doc_id", "text"))
    model = tx.train(many, labels, train_rows=500)
    assert model.curve is not None and " grumbo " in model.terms
    got = {r["row"]["doc_id"]: r["predicted"] for r in tx.score(docs, model).collect()}
    want = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert sum(got[i] == want[i] for i in got) >= 0.9 * len(got)
