from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tillmark.schema import (  # noqa: E402
    CUSTOMER_SCHEMA,
    SALES_SCHEMA,
    SALES_TEAM_SCHEMA,
    STORE_SCHEMA,
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


class World:
    """A small hand-made shop: sales by line, dimensions with invented people."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.customer = spark.createDataFrame([
            (1, "Ann", "Lee", "North", "111", "9100000001", None),
            (2, "Bob", "Ray", "South", "222", "9100000002", None),
            (3, None, "Fox", "East", "333", "9100000003", None),
        ], CUSTOMER_SCHEMA)
        self.store = spark.createDataFrame([
            (10, "Mall", "111", "Max", None, None), (20, "Pier", "222", "Mia", None, None),
        ], STORE_SCHEMA)
        self.sales_team = spark.createDataFrame([
            (100, "Sam", "One", 900, "N", "West", "444", None),
            (101, "Sue", "Two", 900, "N", "West", "444", None),
            (102, "Sid", "Three", 900, "Y", "West", "444", None),
        ], SALES_TEAM_SCHEMA)

    def sales(self, *rows):
        """(customer, store, seller, date, total) per sale."""
        return self.spark.createDataFrame([
            (c, st, "thing", dt.date.fromisoformat(d) if d else None, se,
             Decimal("1.00"), 1, None if t is None else Decimal(t), None)
            for c, st, se, d, t in rows
        ], SALES_SCHEMA)

    @property
    def dims(self):
        return self.customer, self.store, self.sales_team


@pytest.fixture(scope="session")
def world(spark):
    return World(spark)


@pytest.fixture(scope="session")
def ALL_SMALL():
    return frozenset({"customer", "store", "sales_team"})


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


@pytest.fixture(scope="session")
def rows_of():
    return rows
