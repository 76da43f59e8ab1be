"""The registered text queries on the smallest supplied tables."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
from tillmark.llm.queries import ORACLES, QUERIES
from tools import compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no supplied tables")


def test_all_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert compare.difference(QUERIES[name](spark, SF), compare.duck(SF), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op5_packing"}))
def test_one_row_per_document(spark, name):
    want = sorted(r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    assert sorted(r[0] for r in QUERIES[name](spark, SF).select("doc_id").collect()) == want


def test_pipeline_stages_keep_the_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    schema, n = [(f.name, f.dataType) for f in docs.schema], docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert [(f.name, f.dataType) for f in docs.schema] == schema
        assert 0 < docs.count() <= n
        assert docs.where("n_chars <> length(text)").isEmpty()
        n = docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_pipeline_stages_on_hard_rows(spark, docs_of):
    import corpus_pipeline

    hard = [(None, None), (1, None), (2, ""), (3, "\n\n \t"), (4, "12 34"), (5, "word"), (5, "word"),
            (6, "a long text " * 20_000), (7, "same line of five words\nother"),
            (8, "same line of five words\nother things here")]
    for rows in (hard, []):
        docs = docs_of(*rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF).cache()
            docs.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()
