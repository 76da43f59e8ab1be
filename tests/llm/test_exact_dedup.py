from pyspark.sql import functions as F

from tillmark.llm import exact_dedup


def result(df):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in df.collect()), key=repr)


def test_groups_by_text_and_folds_ascii_case_only(spark, docs_of, parquet_of):
    path = parquet_of(docs_of((1, "Same Ä"), (2, "same Ä"), (3, "same ä"), (4, None), (5, ""), (6, "x" * 300_000)))
    got = result(exact_dedup.exact_duplicates(spark, f"{path}/documents.parquet"))
    assert got == sorted([(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 5, 2, False), (5, 5, 2, True),
                          (6, 6, 1, True)], key=repr)


def test_equal_digests_of_unequal_texts_are_told_apart(spark, docs_of, parquet_of):
    path = parquet_of(docs_of((1, "aa"), (2, "bb"), (3, "aa"), (4, "c"), (5, "c")))
    by_length = lambda text: F.char_length(text).cast("string")
    got = result(exact_dedup.exact_duplicates(spark, f"{path}/documents.parquet", digest=by_length))
    assert got == [(1, 3, 2, False), (2, 2, 1, True), (3, 3, 2, True), (4, 5, 2, False), (5, 5, 2, True)]


def test_repeated_rows_and_null_ids(spark, docs_of, parquet_of):
    path = parquet_of(docs_of((7, "t"), (7, "t"), (None, "t")))
    got = result(exact_dedup.exact_duplicates(spark, f"{path}/documents.parquet"))
    assert sorted(k for *_, k in got) == [False, False, True]
    assert {g[1] for g in got} == {7} and {g[2] for g in got} == {3}


def test_empty_table(spark, docs_of, parquet_of):
    path = parquet_of(docs_of())
    assert exact_dedup.exact_duplicates(spark, f"{path}/documents.parquet").count() == 0


def test_state_takes_in_only_new_files(spark, docs_of, parquet_of, tmp_path):
    path, state = parquet_of(docs_of((1, "a"), (2, "b"))) + "/documents.parquet", f"{tmp_path}/state"
    exact_dedup.update_state(spark, path, state)
    docs_of((3, "a")).coalesce(1).write.mode("append").parquet(path)
    exact_dedup.update_state(spark, path, state)
    seen = exact_dedup.retained_state(spark, state).select("keep.doc_id", "n").collect()
    assert sorted(map(tuple, seen)) == [(2, 1), (3, 2)]


def test_no_python_in_the_plan(spark, docs_of, parquet_of):
    path = parquet_of(docs_of((1, "a")))
    plan = exact_dedup.exact_duplicates(spark, f"{path}/documents.parquet")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
