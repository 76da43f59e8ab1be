"""Monthly tables with one row per key and month, however many runs a month's sales come in.

A run's sums are noted as they are, in a table laid out by month and run (the state). A month's totals
are the sums of all its runs; only the months a run has touched are summed again and rewritten in the
published table, where the best sellers of these months are then decided anew. A run that is repeated
under its id replaces its own sums, so nothing counts twice, wherever an earlier attempt stopped.

Names are taken from the dimensions when a month is rewritten. Sales without a date form a month of
their own, as everywhere.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.operators.monthly import MONTH, monthly_totals, with_month_start
from tillmark.sinks.parquet import brought_together
from tillmark.storage import literal_path, path_exists

RUN = "run"
_SUM = T.DecimalType(28, 2)

Finish = Callable[[DataFrame], DataFrame]


def _state_schema(keys: Sequence[str]) -> T.StructType:
    ids = [T.StructField(k, T.LongType()) for k in keys if k != MONTH]
    return T.StructType([*ids, T.StructField("total_cost", _SUM), T.StructField(MONTH, T.DateType()),
                         T.StructField(RUN, T.StringType())])


def state_rows(spark: SparkSession, state: str, keys: Sequence[str]) -> DataFrame:
    """The noted sums: keys, ``total_cost``, the month's first day and the run."""
    schema = _state_schema(keys)
    if not path_exists(spark, state):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(literal_path(state))


def _one_of(column: str, months: Sequence[dt.date | None]) -> Column:
    known = [m for m in months if m is not None]
    return F.col(column).isin(known) | (F.col(column).isNull() if None in months else F.lit(False))


def _replace_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replaces the partitions of ``path`` that occur in ``df``."""
    (
        brought_together(df, columns).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)
    )


def totals_of_run(spark: SparkSession, state: str, keys: Sequence[str], run_id: str) -> DataFrame:
    """The sums that a run has noted, by ``keys``."""
    return state_rows(spark, state, keys).where(F.col(RUN) == run_id).select(*keys, "total_cost")


def note_run(mart: DataFrame, keys: Sequence[str], state: str, run_id: str) -> list[dt.date | None]:
    """Notes the sums of a run's mart by ``keys`` (ids and month) and returns the months touched.

    Summed in the tasks that read before anything is shuffled. The months go to the driver: the
    calendar bounds them.
    """
    ids = [k for k in keys if k != MONTH]
    sums = monthly_totals(with_month_start(mart.select(*ids, "sales_date", "total_cost")), keys)
    columns = _state_schema(keys).names
    noted = sums.withColumns({RUN: F.lit(run_id), "total_cost": F.col("total_cost").cast(_SUM)})
    _replace_partitions(noted.select(columns), state, MONTH, RUN)
    own = totals_of_run(mart.sparkSession, state, keys, run_id)
    return sorted((r[0] for r in own.select(MONTH).distinct().collect()), key=lambda m: (m is None, m))


def month_totals(spark: SparkSession, state: str, keys: Sequence[str], months: Sequence[dt.date | None]
                 ) -> DataFrame:
    """Totals of these months over all runs; the other months' files are not opened."""
    rows = state_rows(spark, state, keys).where(_one_of(MONTH, months))
    return rows.groupBy(*keys).agg(F.sum("total_cost").cast(_SUM).alias("total_cost"))


def merge_run(mart: DataFrame, keys: Sequence[str], root: str, run_id: str, finish: Finish, month: str
              ) -> list[dt.date | None]:
    """Merges a run's mart into the monthly table below ``root``.

    ``finish`` makes the published rows of whole months from their totals by ``keys``; ``month`` is the
    column of them that has the month as text.
    """
    touched = note_run(mart, keys, f"{root}/state", run_id)
    rewrite_months(mart.sparkSession, keys, root, touched, finish, month)
    return touched


def rewrite_months(spark: SparkSession, keys: Sequence[str], root: str, touched: Sequence[dt.date | None],
                   finish: Finish, month: str) -> None:
    """The monthly table below ``root`` with these months made anew from the noted sums."""
    if touched:
        totals = month_totals(spark, f"{root}/state", keys, touched)
        _replace_partitions(finish(totals), f"{root}/months", month)


def read_months(spark: SparkSession, root: str, month: str) -> DataFrame:
    """The published monthly table; the month stays text."""
    return spark.read.option("basePath", f"{root}/months").parquet(f"{root}/months").withColumn(
        month, F.col(month).cast("string"))
