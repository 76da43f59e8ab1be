"""The library's own registered queries against their SQL, on the smallest supplied tables."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
from tillmark.registry.oracles import ORACLES
from tillmark.registry.queries import QUERIES
from tools import compare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no supplied tables")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_driver_gets_every_query():
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).columns == [
        "store_id", "sales_person_id", "full_name", "sales_month", "total_sales", "incentive"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    df = driver.queries()[name](spark, SF)
    assert compare.difference(df, compare.duck(SF), driver.oracle_sql()[name]) is None
