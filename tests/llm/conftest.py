from __future__ import annotations

import pytest

ROWS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) pairs, with columns named like the operators' own."""
    def make(*pairs, extra=True):
        df = spark.createDataFrame(
            [(i, t, None, "s", None if t is None else len(t)) for i, t in pairs], ROWS)
        if not extra:
            return df
        clashing = ("row", "key", "txt", "doc", "place", "kept", "score", "digest", "n_words")
        return df.selectExpr("*", *[f"'x' AS `{c}`" for c in clashing])

    return make


@pytest.fixture(scope="session")
def parquet_of(tmp_path_factory):
    """Writes a frame as ``documents.parquet`` of a new folder and gives the folder."""
    def make(df, **others):
        folder = tmp_path_factory.mktemp("tables")
        df.coalesce(1).write.parquet(f"{folder}/documents.parquet")
        for name, other in others.items():
            other.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
        return str(folder)

    return make
