"""What may be broadcast: only tables whose size has been measured."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast table is held whole by the driver and by every executor.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
MAX_BROADCAST_ROWS = 1_000_000


def estimated_bytes(df: DataFrame) -> int:
    """What the plan's sources hold by Spark's estimate; for files their size, without a job.

    The sources are added up, as Spark's estimate for a join is the product of its sides.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def planned_bytes(df: DataFrame) -> int:
    """Spark's estimate for the whole plan: good for what is read from files, too large for joins."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _width(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 16
    return F.lit(16)


def _widths(name: str, df: DataFrame) -> DataFrame:
    width = reduce(lambda a, b: a + b, [_width(f) for f in df.schema.fields], F.lit(16))
    return df.select(F.lit(name).alias("name"), width.cast("bigint").alias("bytes"))


def small_tables(tables: Mapping[str, DataFrame], max_bytes: int = MAX_BROADCAST_BYTES,
                 max_rows: int = MAX_BROADCAST_ROWS, narrowed: int = 1) -> frozenset[str]:
    """Names of the tables that fit the limits, by counting their rows and bytes.

    One job measures all of them. A table whose files alone exceed ``narrowed`` times the limit is
    not read: so many rows of its files may become one.
    """
    likely = {n: df for n, df in tables.items() if estimated_bytes(df) <= narrowed * max_bytes}
    if not likely:
        return frozenset()
    measured = (
        reduce(DataFrame.unionAll, [_widths(n, df) for n, df in likely.items()])
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes"))
    )
    # One row per table; an empty table has none.
    too_large = {
        r["name"] for r in measured.collect()
        if r["rows"] > max_rows or r["bytes"] > max_bytes
    }
    return frozenset(likely.keys() - too_large)
