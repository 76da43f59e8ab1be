import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillmark.llm import langid
from tillmark.llm.cnn import ByteNetwork

ALPHABETS = {"aa": "abcdef", "bb": "ghijkl", "cc": "éèüöñß"}


def made(lang, rng, n):
    return " ".join("".join(rng.choice(ALPHABETS[lang]) for _ in range(rng.randrange(2, 8))) for _ in range(n))


def labelled(spark, per_language=60):
    rng = random.Random(4)
    rows = [(k * 1000 + i, made(lang, rng, rng.randrange(2, 120)), lang)
            for k, lang in enumerate(ALPHABETS) for i in range(per_language)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_texts_are_recognised(spark):
    docs = labelled(spark)
    model = langid.train(docs.where(~langid.held_out()))
    assert model.languages == sorted(ALPHABETS)
    out = langid.identify(docs, model).where(langid.held_out("row.doc_id"))
    assert out.where("row.lang <> lang_pred").count() <= 1
    assert out.where("score < 0 or score > 1").isEmpty()


def test_hard_rows(spark, docs_of):
    model = langid.train(labelled(spark))
    docs = docs_of((1, None), (2, ""), (3, "12 34 !?"), (4, "abc fed " * 40_000), (4, "abc fed"), (4, "abc fed"),
                   (None, "ghi jkl ghi jkl"), (5, "é"))
    got = [(r["row"]["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(docs, model).collect()]
    assert {g[1] for g in got if g[0] in (1, 2, 3)} == {"und"} and {g[2] for g in got if g[0] in (1, 2, 3)} == {0.0}
    assert [g[1] for g in got if g[0] == 4] == ["aa"] * 3 and [g[1] for g in got if g[0] is None] == ["bb"]
    assert len(got) == 8
    assert langid.identify(docs_of(), model).count() == 0


def test_nothing_to_learn_from(spark, docs_of):
    model = langid.train(docs_of((1, "text without a language"), (2, None)))
    assert langid.identify(docs_of((1, "abc")), model).select("lang_pred").collect()[0][0] == "und"


def test_whole_text_counts(spark):
    """A text whose second, larger part is in another language is judged by that part."""
    model = langid.train(labelled(spark))
    rng = random.Random(8)
    text = made("aa", rng, 200) + " " + made("bb", rng, 2000)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert langid.identify(df, model).select("lang_pred").collect()[0][0] == "bb"


def test_held_out_is_the_stated_fold(spark):
    import zlib

    df = spark.range(200).select(F.col("id").alias("doc_id"), langid.held_out("id").alias("h"))
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in df.collect())


def naive_probabilities(network, window):
    """Every filter at every place of a window, the largest value kept, and a softmax over classes."""
    kept = []
    for width, table, bias in zip(network.widths, network.tables, network.bias, strict=True):
        for f in range(network.filters):
            values = [sum(float(table[j][window[at + j]][f]) for j in range(width))
                      for at in range(len(window) - width + 1)]
            kept.append(max(max(values) + float(bias[f]), 0.0))
    z = [sum(k * float(network.out[i][c]) for i, k in enumerate(kept)) + float(network.out_bias[c])
         for c in range(network.out.shape[1])]
    e = [math.exp(v - max(z)) for v in z]
    return [v / sum(e) for v in e]


@pytest.mark.parametrize("widths", [(2, 3, 4), (1, 5), (3,)])
def test_network_as_by_brute_force(widths):
    rng = np.random.default_rng(3)
    network = ByteNetwork(3, widths=widths, filters=4, seed=5)
    network.bias = [rng.normal(0, 0.2, 4).astype(np.float32) for _ in widths]
    x = rng.integers(0, 256, (6, 24)).astype(np.uint8)
    x[1, 10:] = 0
    x[2] = 0
    got = network.probabilities(x)
    for row, window in zip(got, x, strict=True):
        assert row == pytest.approx(naive_probabilities(network, window.tolist()), abs=1e-4)


def test_identified_as_by_brute_force(spark, docs_of):
    """A text's windows one by one, weighted by their bytes."""
    model = langid.train(labelled(spark))
    rng = random.Random(9)
    texts = [made(lang, rng, n) for lang in ALPHABETS for n in (1, 5, 90)]
    got = {r["row"]["doc_id"]: r for r in langid.identify(docs_of(*enumerate(texts)), model).collect()}
    for i, text in enumerate(texts):
        codes = list(text.encode())
        total = [0.0] * len(model.languages)
        for at in range(0, len(codes), langid.WINDOW_BYTES):
            part = codes[at: at + langid.WINDOW_BYTES]
            p = naive_probabilities(model.network, part + [0] * (langid.WINDOW_BYTES - len(part)))
            total = [t + q * len(part) / len(codes) for t, q in zip(total, p, strict=True)]
        assert got[i]["lang_pred"] == model.languages[total.index(max(total))]
        assert got[i]["score"] == pytest.approx(max(total), abs=1e-3)
