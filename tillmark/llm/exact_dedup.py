"""Exact deduplication by keyed streaming state, native: DataFrame functions only.

The documents arrive as a stream. For every digest of a normalised text the stream keeps, without
expiry and on disk (RocksDB, snapshots in the shared folder), how many rows had it, the largest
``doc_id`` (the stable identifier) and where that row's content lies: file and row in it. A later
run on the same state folder takes in only files that have come since. The state is then read as a
table; digests that were hit more than once are checked on their full bytes.

Defined results: null text counts as empty, so null and empty texts are equal. A null ``doc_id``
is smaller than any other. Of rows that share both text and ``doc_id`` the one last by file and row
stays. Other columns, whatever their names, are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.common import fresh_folder, literal_path, lower_ascii, sha256_hex

_STATE = "spark.sql.streaming.stateStore."
_STATE_SETTINGS = {
    _STATE + "providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Else every state store, one a partition, takes megabytes of disk before it holds anything.
    _STATE + "rocksdb.allowFAllocate": "false",
}

Digest = Callable[[Column], Column]


def normalised(text: Column) -> Column:
    return lower_ascii(F.coalesce(text, F.lit("")))


def _as_pattern(path: str) -> str:
    """The same path as a pattern: a stream's source takes a single file only by a pattern."""
    plain = literal_path(path.rstrip("/"))
    return f"{plain[:-1]}[{plain[-1]}]"


@contextmanager
def _disk_backed_state(spark: SparkSession):
    before = {k: spark.conf.get(k, None) for k in _STATE_SETTINGS}
    for k, v in _STATE_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _rows(table: DataFrame, digest: Digest) -> DataFrame:
    norm = normalised(F.col("text"))
    return table.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), norm.alias("norm"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
    ).withColumn("digest", digest(F.col("norm")))


def update_state(spark: SparkSession, path: str, state: str, digest: Digest = sha256_hex) -> None:
    """Takes the files at ``path`` that ``state`` has not seen into the keyed state."""
    schema = spark.read.parquet(path).schema
    arriving = _rows(spark.readStream.schema(schema).parquet(_as_pattern(path)), digest)
    retained = arriving.groupBy("digest").agg(
        F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("n"),
    )
    with _disk_backed_state(spark):
        (
            retained.writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", state)
            .trigger(availableNow=True).start().awaitTermination()
        )


def retained_state(spark: SparkSession, state: str) -> DataFrame:
    """``digest``, ``keep`` (doc_id, file, row) and ``n`` of every text seen so far."""
    return spark.read.format("statestore").load(state).select(
        F.col("key.digest").alias("digest"), F.col("value.max").alias("keep"),
        F.col("value.count").alias("n"),
    )


def exact_duplicates(spark: SparkSession, path: str, state: str | None = None,
                     digest: Digest = sha256_hex) -> DataFrame:
    """One row per row of the Parquet table at ``path``.

    Columns: ``doc_id``, ``keep_id`` (of the row that stays), ``group_size``, ``kept``, ``digest``.
    ``state`` is the folder of the keyed state, a new one unless given.
    """
    state = state or fresh_folder(spark, "llm-exact-state")
    update_state(spark, path, state, digest)
    seen = retained_state(spark, state)
    rows = _rows(spark.read.parquet(path), digest)

    # Full bytes: all texts of a digest are one text if the smallest equals the largest. Each task
    # first does that for its own rows, so a large group sends one text a task.
    bytes_checked = rows.groupBy("digest").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi"))
    clash = bytes_checked.where("lo <> hi").select("digest")
    if clash.isEmpty():
        placed = rows.select("doc_id", "file", "row", "digest").join(seen, "digest")
    else:
        own = rows.join(clash, "digest", "left_semi")
        by_text = own.groupBy("digest", "norm").agg(
            F.max(F.struct("doc_id", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("n"))
        columns = ["doc_id", "file", "row", "digest", "keep", "n"]
        rest = rows.join(clash, "digest", "left_anti").join(seen, "digest")
        placed = own.join(by_text, ["digest", "norm"]).select(columns).unionByName(rest.select(columns))
    is_keeper = (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))
    return placed.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        is_keeper.alias("kept"), "digest",
    )
