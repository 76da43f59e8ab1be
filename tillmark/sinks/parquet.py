"""Parquet marts and their snapshots."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.operators.sizing import planned_bytes
from tillmark.storage import child_folders, path_exists

PARTITION_COLUMNS = ("sales_month", "store_id")


class NoSnapshot(LookupError):
    """Nothing complete has been published for a mart."""


def write_mart(df: DataFrame, path: str) -> None:
    """Overwrites the Parquet mart at ``path``."""
    df.write.mode("overwrite").parquet(path)


def _advised_bytes(spark: SparkSession) -> int:
    text = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def brought_together(df: DataFrame, columns: Sequence[str], wanted: Sequence[str] | None = None) -> DataFrame:
    """The rows arranged by the columns they are to be laid out by, so that each task writes few files.

    ``wanted`` says which columns of them are shuffled, if not all.

    For rows of more than the advised size for every core, the rebalance hint has Spark split a
    partition that is much larger than the others over several tasks (and files) and join small
    ones. Fewer rows would all be joined into a task or two that write file after file: their
    partitions are spread over the shuffle partitions instead. The rows are the same either way.
    """
    by = [F.col(c) for c in columns]
    spark = df.sparkSession
    rows = df if wanted is None else df.select(*wanted)
    if planned_bytes(df) > spark.sparkContext.defaultParallelism * _advised_bytes(spark):
        return rows.hint("rebalance", *by)
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *by)


#: Columns that are shuffled, and what makes the mart's rows of these again.
Narrow = tuple[Sequence[str], Callable[[DataFrame], DataFrame]]


def write_partitioned_mart(df: DataFrame, path: str, replace: str = "all", narrow: Narrow | None = None) -> None:
    """Overwrites the mart at ``path``, laid out by month and store.

    Where columns can be had again without a shuffle, such as a small dimension's, ``narrow`` says so: then
    these are not shuffled to their month and store, but added there.

    ``replace="all"`` replaces the whole mart, ``"touched"`` only the partitions that occur in
    ``df``. The whole mart counts once it has its ``_SUCCESS``: so tasks move their files into place
    themselves, instead of leaving all of them to the driver.
    """
    mode, version = {"all": ("static", "2"), "touched": ("dynamic", "1")}[replace]
    wanted, complete = narrow or (None, lambda rows: rows)
    (
        complete(brought_together(df, PARTITION_COLUMNS, wanted)).write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .option("mapreduce.fileoutputcommitter.algorithm.version", version)
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(path)
    )


def read_partitioned_mart(spark: SparkSession, path: str) -> DataFrame:
    """The mart read back with the partition columns' types stated.

    Left to guess, Spark might take a month for a date and widen or narrow the store's type.
    """
    return (
        spark.read.parquet(path)
        .withColumn("sales_month", F.col("sales_month").cast("string"))
        .withColumn("store_id", F.col("store_id").cast("bigint"))
    )


def snapshot_path(root: str, mart: str, epoch_ms: int) -> str:
    return f"{root}/{mart}/{epoch_ms}"


def publish_snapshot(df: DataFrame, root: str, mart: str, epoch_ms: int,
                     partitioned: bool = False, narrow: Narrow | None = None) -> str:
    """Writes a mart straight to ``<root>/<mart>/<epoch_ms>/`` and returns that path.

    Earlier snapshots stay. Writing the same epoch again replaces that snapshot, so a run can be
    repeated.
    """
    path = snapshot_path(root, mart, epoch_ms)
    if partitioned:
        write_partitioned_mart(df, path, narrow=narrow)
    else:
        write_mart(df, path)
    return path


def latest_epoch(spark: SparkSession, root: str, mart: str) -> int:
    """The newest epoch whose snapshot is complete (Spark left its ``_SUCCESS`` marker)."""
    epochs = [int(n) for n in child_folders(spark, f"{root}/{mart}") if n.isdigit()]
    for epoch in sorted(epochs, reverse=True):
        if path_exists(spark, f"{snapshot_path(root, mart, epoch)}/_SUCCESS"):
            return epoch
    raise NoSnapshot(f"no complete snapshot of {mart} below {root}")


def latest_snapshot(spark: SparkSession, root: str, mart: str, partitioned: bool = False
                    ) -> DataFrame:
    """The newest complete snapshot of a mart; one that is still being written is passed over."""
    path = snapshot_path(root, mart, latest_epoch(spark, root, mart))
    return read_partitioned_mart(spark, path) if partitioned else spark.read.parquet(path)
