"""Column expressions on single values."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillmark.functions.columns import (
    base_name,
    extra_columns,
    full_name,
    incentive,
    missing_columns,
    pack_extras,
    plain_path,
    sales_month,
)


def value(spark, column, **cells):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cells.items()] or ["id"])
    return frame.select(column).first()[0]


@pytest.mark.parametrize("date, month", [
    (dt.date(2023, 3, 3), "2023-03"), (dt.date(1999, 12, 31), "1999-12"), (None, None)])
def test_sales_month(spark, date, month):
    assert value(spark, sales_month(F.lit(date).cast("date"))) == month


def test_full_name(spark):
    assert value(spark, full_name("a", "b"), a="Ann", b="Lee") == "Ann Lee"
    assert value(spark, full_name("a", "b"), a="Ann", b=None) is None


@pytest.mark.parametrize("total, paid", [
    ("12.50", "0.13"), ("234.50", "2.35"), ("0.49", "0.00"), ("0.50", "0.01"), ("-12.50", "-0.13"),
    ("9999999999999999.99", "100000000000000.00")])
def test_incentive_rounds_half_up(spark, total, paid):
    amount = F.lit(total).cast("decimal(18,2)")
    assert value(spark, incentive(amount, F.lit(True))) == D(paid)
    assert value(spark, incentive(amount, F.lit(False))) == D("0.00")


def test_header_differences(spark):
    header = F.array(*[F.lit(c) for c in ("z", "b", "a", "y")])
    assert value(spark, missing_columns(header, ("a", "c", "b", "d"))) == ["c", "d"]
    assert value(spark, extra_columns(header, ("a", "b"))) == ["z", "y"]


def test_pack_extras(spark):
    assert value(spark, pack_extras(["a", "b"]), a=None, b="p1") == "p1"
    assert value(spark, pack_extras(["a", "b"]), a=None, b=None) == ""
    assert value(spark, pack_extras([])) is None


@pytest.mark.parametrize("encoded, plain", [
    ("file:/a/b%20c.csv", "file:/a/b c.csv"), ("file:/a/b+c.csv", "file:/a/b+c.csv"),
    ("file:/a/100%25.csv", "file:/a/100%.csv")])
def test_plain_path(spark, encoded, plain):
    assert value(spark, plain_path(F.lit(encoded))) == plain
    assert value(spark, base_name(F.lit(plain))) == plain.rsplit("/", 1)[-1]
