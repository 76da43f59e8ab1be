"""The quality classifier: features by brute force, slopes by differences, held-out accuracy."""

import re

import numpy as np
import pyarrow as pa
import pytest

from tillmark.llm import langid, pu_quality
from tillmark.llm.kernel import small_batches

SF = "/root/testdata/sf0.01"
TEXTS = ["", "a", "One two. ONE two! one two.\n\nsame line\nsame line\n", "tab\tand ÄÖÜ 日本 | pipe $$$ 12",
         "word " * 300, "x\ny\nx\ny", " lead and trail ", "a" * 25 + " short"]


def _naive(text):
    of = pu_quality._class_of_byte()
    raw = text.encode()
    counts = np.zeros(256)
    for x, y in zip(raw, raw[1:], strict=False):
        counts[of[x] * 16 + of[y]] += 1
    words = [w.lower() if w.isascii() else w for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
    lines = [x for x in text.split("\n") if x]
    triples = list(zip(words, words[1:], words[2:], strict=False))

    def later(items):
        return sum(x in items[:i] for i, x in enumerate(items))

    def root(n, whole):
        return (n / max(1, whole)) ** 0.5

    sizes = [len(w.encode()) for w in words]
    return np.concatenate([np.sqrt(counts / max(1, len(raw) - 1)), [
        root(later(words), len(words)), root(sum(a == b for a, b in zip(words, words[1:], strict=False)), len(words)),
        root(later(triples), len(words)), root(later(lines), len(lines)), root(sum(s > 20 for s in sizes), len(words)),
        np.log1p(len(words)), np.log1p(len(raw)), np.log1p(len(lines)), np.log1p(sum(sizes) / max(1, len(words)))]])


def test_features_equal_brute_force():
    got = np.concatenate([pu_quality.features(t) for _, t in small_batches(pa.array([*TEXTS, None]))])
    assert np.allclose(got, np.stack([_naive(t) for t in [*TEXTS, ""]]), atol=1e-5)


@pytest.mark.parametrize("shift", [2.0, -4.0])
def test_slopes_of_the_risk(shift):
    rng = np.random.default_rng(1)
    zp, zu, prior = rng.normal(1, 1, 7), rng.normal(0, 1, 9) + shift, 0.6
    slope_p, slope_u, bad = pu_quality.risk_slopes(zp, zu, prior)

    def risk(zp, zu):
        part = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        return prior * np.logaddexp(0, -zp).mean() + part if bad >= 0 else -part

    assert (bad < 0) == (shift < 0)
    for z, slope in ((zp, slope_p), (zu, slope_u)):
        for i in range(len(z)):
            z[i] += 1e-5
            up = risk(zp, zu)
            z[i] -= 2e-5
            down = risk(zp, zu)
            z[i] += 1e-5
            assert abs((up - down) / 2e-5 - slope[i]) < 1e-6


def test_prior_of_made_up_scores():
    rng = np.random.default_rng(2)
    positive = rng.normal(2, 1, 4000)
    for share in (0.3, 0.8):
        n = int(5000 * share)
        unlabelled = np.concatenate([rng.normal(2, 1, n), rng.normal(-2, 1, 5000 - n)])
        assert abs(pu_quality.bound_of_prior(positive, unlabelled) - share) < 0.05


def test_held_out_documents(spark):
    from tillmark.llm.queries import QUERIES

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = QUERIES["op12_quality_classifier"](spark, SF).where("held_out").join(labels, "doc_id").collect()
    good, bad = ([r for r in got if r["quality"] == q] for q in (1, 0))
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    assert np.mean([r["predicted"] for r in good]) > 0.97
    assert np.mean([r["predicted"] for r in bad]) < 0.2


def test_held_out_labels_and_other_columns_change_nothing(spark, docs_of):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    trusted = ~langid.held_out(folds=4, fold=2)
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    one = pu_quality.train(docs, labels, trusted=trusted)
    two = pu_quality.train(docs.selectExpr("doc_id", "text", "'x' AS h", "7 AS quality", "'s' AS source"), other, trusted=trusted)
    assert one.prior == two.prior
    assert all(np.array_equal(x, y) for x, y in zip(one.network.weights, two.network.weights, strict=True))


def test_hard_rows(spark, docs_of):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (None, 1), (3, None), (4, 7)], "doc_id long, quality int")
    hard = docs_of((None, None), (1, None), (2, ""), (2, ""), (3, "\n \n"), (4, "word " * 50_000), (5, "x"))
    for ones in (labels, labels.limit(0)):
        model = pu_quality.train(hard, ones)
        rows = pu_quality.score(hard, model).select("row.doc_id", "row.score", "score", "predicted").collect()
        assert len(rows) == 7 and all(0 <= r[2] <= 1 for r in rows)
    assert model.network is None and {r[2] for r in rows} == {0.0}
    model = pu_quality.train(docs_of(), labels)
    assert model.network is None and pu_quality.score(docs_of(), model).count() == 0
