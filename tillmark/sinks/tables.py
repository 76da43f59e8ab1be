"""Appending results to a database table (or to a table kept as Parquet files)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.storage import path_exists
from tillmark.sources.dimensions import FileTable, JdbcTable, read_dimension

RUN_ID = "run_id"


class AppendMismatch(RuntimeError):
    """After an append the table does not hold the run's rows exactly once."""


def _append(df: DataFrame, target: JdbcTable | FileTable) -> None:
    if isinstance(target, JdbcTable):
        df.write.option("numPartitions", target.num_partitions).jdbc(
            target.url, target.table, mode="append", properties=dict(target.properties)
        )
    else:
        df.write.format(target.format).options(**target.options).mode("append").save(target.path)


def _rows_of_run(df: DataFrame, target: JdbcTable | FileTable, run_id: str) -> DataFrame | None:
    spark = df.sparkSession
    if isinstance(target, JdbcTable):
        table = read_dimension(spark, target)  # in key ranges, if the table names a column for it
    elif path_exists(spark, target.path):
        table = spark.read.format(target.format).options(**target.options).load(target.path)
    else:
        return None
    return table.filter(F.col(RUN_ID) == run_id)


def append_table(df: DataFrame, target: JdbcTable | FileTable) -> None:
    """Appends all rows. Errors are raised; nothing is swallowed."""
    _append(df, target)


def append_run(df: DataFrame, target: JdbcTable | FileTable, run_id: str, keys: Sequence[str]
               ) -> None:
    """Appends a run's rows, each at most once however often the run is repeated.

    Rows carry ``run_id``. Rows of this run that the table already holds (by ``keys``, nulls equal)
    are left out, which completes an append that stopped half way; ``df`` must hold the same rows
    each time, as the published snapshot of a run does. Afterwards the run's rows are counted: a
    task that was lost after its database commit and then repeated shows as ``AppendMismatch``. A
    unique index on ``run_id`` and the keys makes the database refuse such rows in the first place.

    The table must have the ``run_id`` column; a database table must exist beforehand.
    """
    present = _rows_of_run(df, target, run_id)
    missing = df
    if present is not None:
        held = present.select(*[F.col(k).alias(f"held_{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"held_{k}")) for k in keys]
        missing = df.join(held, same, "left_anti")
    _append(missing.withColumn(RUN_ID, F.lit(run_id)), target)
    expected, found = df.count(), _rows_of_run(df, target, run_id).count()
    if expected != found:
        raise AppendMismatch(f"run {run_id}: {found} rows in the table, {expected} expected")
