"""Database tables read in parts. No database is started: the reader is replaced by one over a table
Spark has, which answers what it is asked."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from tillmark.sources.dimensions import (
    JdbcTable,
    cut_points,
    hash_predicates,
    range_predicates,
    read_dimension,
    sql_literal,
)

PARTS = 8


def parts_of(df, predicates):
    """How many rows meet each condition."""
    counts = df.agg(*[F.count_if(F.expr(p)).alias(str(i)) for i, p in enumerate(predicates)]).first()
    return list(counts)


def once_each(df, predicates):
    met = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates), F.lit(0))
    return df.where(met != 1).isEmpty()


@pytest.fixture
def skewed(spark):
    """Nine tenths of the keys lie in a hundred-thousandth of the range; a few rows have none."""
    key = "CASE WHEN id % 10 = 0 THEN id * 100000 WHEN id % 997 = 1 THEN NULL ELSE id END"
    return spark.range(20_000).selectExpr(f"{key} k", "id v")


@pytest.fixture
def asked(spark, skewed, monkeypatch):
    calls = []

    def jdbc(self, url, table, **kw):
        calls.append((table, kw))
        if table.startswith("(SELECT MIN"):
            return skewed.agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
        if "predicates" not in kw:
            return skewed
        parts = [skewed.where(p) for p in kw["predicates"]]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionAll(part)
        return whole

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    return calls


def test_parts_of_a_skewed_key_are_balanced(spark, skewed, asked, rows_of):
    got = read_dimension(spark, JdbcTable("jdbc:x", "t", {"user": "u"}, "k", PARTS, balanced=True))
    assert rows_of(got) == rows_of(skewed)
    (bounds, _), (_, even), (table, last) = asked
    assert even["numPartitions"] == PARTS and even["column"] == "k"
    assert table == "t" and set(last) == {"properties", "predicates"}
    counts = parts_of(skewed, last["predicates"])
    assert len(counts) == PARTS and max(counts) <= 2 * 20_000 / PARTS and sum(counts) == 20_000
    # In equal steps one part would have nine tenths of the rows.
    step = (even["upperBound"] - even["lowerBound"]) // PARTS
    assert skewed.where(f"k < {step} OR k IS NULL").count() > 0.9 * 20_000


def test_parts_by_a_hash(spark, skewed, asked, rows_of):
    got = read_dimension(spark, JdbcTable("jdbc:x", "t", num_partitions=PARTS, hash_of="hash(k)"))
    assert rows_of(got) == rows_of(skewed) and len(asked) == 1
    counts = parts_of(skewed, asked[0][1]["predicates"])
    assert len(counts) == PARTS and max(counts) <= 2 * 20_000 / PARTS


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "decimal(12,2)", "double", "int"])
def test_every_row_is_in_one_part(spark, kind):
    text = {"date": "date_add(DATE '2020-01-01', CAST(id AS INT))",
            "timestamp_ntz": "CAST(TIMESTAMP '2020-01-01 00:00:01' + make_interval(0,0,0,id) AS timestamp_ntz)"}
    df = spark.range(300).selectExpr(
        f"CAST(CASE WHEN id % 50 = 7 THEN NULL ELSE {text.get(kind, 'id * id - 70')} END AS {kind}) k")
    cuts = cut_points(df, "k", PARTS)
    assert len(cuts) == PARTS - 1
    predicates = range_predicates("k", cuts)
    assert once_each(df, predicates) and max(parts_of(df, predicates)) <= 2 * 300 / PARTS


def test_few_or_no_keys(spark):
    none = spark.range(3).selectExpr("CAST(NULL AS bigint) k")
    assert cut_points(none, "k", PARTS) == [] and range_predicates("k", []) == ["1 = 1"]
    one = spark.range(5).selectExpr("7 k")
    predicates = range_predicates("k", cut_points(one, "k", PARTS))
    assert predicates == ["k < 7 OR k IS NULL", "k >= 7"] and once_each(one, predicates)
    assert cut_points(one, "k", 1) == []


def test_conditions_as_the_database_gets_them():
    assert range_predicates("k", [1, 5]) == ["k < 1 OR k IS NULL", "k >= 1 AND k < 5", "k >= 5"]
    assert hash_predicates("CRC32(code)", 2) == [
        "MOD(ABS(CRC32(code)), 2) = 0 OR (CRC32(code)) IS NULL", "MOD(ABS(CRC32(code)), 2) = 1"]
    assert sql_literal(dt.date(2024, 1, 2)) == "DATE '2024-01-02'" and sql_literal(D("1.50")) == "1.50"
    assert sql_literal(dt.datetime(2024, 1, 2, 3)) == "TIMESTAMP '2024-01-02 03:00:00'"
    with pytest.raises(TypeError):
        sql_literal("'; DROP")


def test_contradictions_are_refused():
    with pytest.raises(ValueError, match="not by both"):
        JdbcTable("jdbc:x", "t", partition_column="k", hash_of="k")
    with pytest.raises(ValueError, match="need a partition_column"):
        JdbcTable("jdbc:x", "t", balanced=True)
