"""Dimension tables: customer, store, sales team."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcTable:
    """A database table, read whole over one connection unless it says how to part it.

    With ``partition_column``, a number, date or timestamp, the scan runs in parallel over its range:
    in equal steps, which suits ids without large gaps, or with ``balanced`` in parts with about as many
    rows each, for which all its values are read once beforehand. With ``hash_of``, an expression in the
    database's SQL that gives a whole number for a row (such as ``CRC32(code)``), the parts are its
    remainders: for tables without such a column, or where one value of it has very many rows.
    """

    url: str
    table: str
    properties: Mapping[str, str] = field(default_factory=dict)
    partition_column: str | None = None
    num_partitions: int = 16
    balanced: bool = False
    hash_of: str | None = None

    def __post_init__(self):
        if self.hash_of is not None and self.partition_column is not None:
            raise ValueError("a table is read in parts by a column or by a hash, not by both")
        if self.balanced and self.partition_column is None:
            raise ValueError("balanced parts need a partition_column")
        if self.num_partitions < 1:
            raise ValueError("a table has at least one part")


@dataclass(frozen=True)
class FileTable:
    """A table kept as files in a format Spark reads."""

    path: str
    format: str = "parquet"
    schema: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)


class DuplicateKey(ValueError):
    """A dimension has two rows for one key, which would multiply the sales joined to it."""


def bounds_query(table: JdbcTable) -> str:
    """The subquery that asks the database for the range of the partition column."""
    col = table.partition_column
    return f"(SELECT MIN({col}) AS lo, MAX({col}) AS hi FROM {table.table}) key_range"


def scan_bounds(lo: object, hi: object) -> tuple[object, object]:
    """Bounds for a partitioned scan, the upper one beyond the last key.

    Spark takes numbers, dates and timestamps; the latter two are handed over as text.
    """
    if isinstance(hi, bool) or not isinstance(hi, (int, float, Decimal, dt.date)):
        raise TypeError(f"a table can be read in parts by a number, a date or a timestamp, not {hi!r}")
    if isinstance(hi, dt.datetime):
        return str(lo), str(hi + dt.timedelta(seconds=1))
    if isinstance(hi, dt.date):
        return str(lo), str(hi + dt.timedelta(days=1))
    return math.floor(lo), math.floor(hi) + 1


def cut_points(keys: DataFrame, column: str, parts: int) -> list[object]:
    """At most ``parts - 1`` different keys, in order, between which there are about as many rows.

    Spark's approximate quantiles, by ranks that are right to a hundredth of a part. Nulls do not count.
    """
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    found = keys.agg(F.percentile_approx(column, shares, 100 * parts).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def sql_literal(value: object) -> str:
    """A number, date or timestamp in standard SQL."""
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value}'"
    if isinstance(value, dt.date):
        return f"DATE '{value}'"
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal)):
        raise TypeError(f"a table can be read in parts by a number, a date or a timestamp, not {value!r}")
    return str(value)


def range_predicates(column: str, cuts: Sequence[object]) -> list[str]:
    """One condition a part; every row meets exactly one. Rows without a key are in the first part."""
    if not cuts:
        return ["1 = 1"]
    at = [sql_literal(c) for c in cuts]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(at, at[1:], strict=False)]
    return [f"{column} < {at[0]} OR {column} IS NULL", *between, f"{column} >= {at[-1]}"]


def hash_predicates(expression: str, parts: int) -> list[str]:
    """One condition for each remainder of the expression; rows where it is null are in the first part."""
    rest = f"MOD(ABS({expression}), {parts})"
    return [f"{rest} = 0 OR ({expression}) IS NULL", *(f"{rest} = {i}" for i in range(1, parts))]


def read_dimension(spark: SparkSession, source: JdbcTable | FileTable) -> DataFrame:
    """The whole table. A database is read in ``num_partitions`` parts at once, if it says by what."""
    if isinstance(source, FileTable):
        reader = spark.read.format(source.format).options(**source.options)
        return (reader.schema(source.schema) if source.schema else reader).load(source.path)
    properties = dict(source.properties)
    if source.hash_of is not None:
        return spark.read.jdbc(source.url, source.table, properties=properties,
                               predicates=hash_predicates(source.hash_of, source.num_partitions))
    if source.partition_column is None:
        return spark.read.jdbc(source.url, source.table, properties=properties)
    lo, hi = spark.read.jdbc(source.url, bounds_query(source), properties=properties).first()
    if lo is None:
        return spark.read.jdbc(source.url, source.table, properties=properties)
    lower, upper = scan_bounds(lo, hi)
    even = spark.read.jdbc(
        source.url, source.table, column=source.partition_column, lowerBound=lower,
        upperBound=upper, numPartitions=source.num_partitions, properties=properties,
    )
    if not source.balanced:
        return even
    # Of the even parts only the key column is asked for.
    cuts = cut_points(even.select(source.partition_column), source.partition_column, source.num_partitions)
    return spark.read.jdbc(source.url, source.table, properties=properties,
                           predicates=range_predicates(source.partition_column, cuts))


def assert_unique_key(df: DataFrame, keys: Sequence[str], name: str = "table") -> None:
    """Raises ``DuplicateKey`` when two rows share a key. Null keys never join, so they may repeat."""
    present = df.dropna(subset=list(keys))
    doubled = present.groupBy(*keys).count().filter(F.col("count") > 1).first()
    if doubled is not None:
        key = ", ".join(f"{k}={doubled[k]}" for k in keys)
        raise DuplicateKey(f"{name}: {doubled['count']} rows for {key}")
