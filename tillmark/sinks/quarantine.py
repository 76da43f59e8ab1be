"""Keeping what could not be processed: rejected files and malformed rows.

The landing area is left as it is. Quarantine holds, per run, a manifest of the rejected files,
their bytes as they are, and the malformed rows of accepted files. Files in the manifest are not
looked at again unless they change.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions.columns import base_name, plain_path
from tillmark.sources.any_header import FAULTS
from tillmark.sources.catalog import FILES_A_TASK, PEEK_SCHEMES, open_stream
from tillmark.sources.sales_csv import RAW_LINE, SOURCE_FILE
from tillmark.storage import CODEC, literal_path, path_exists, scheme_of

# Tasks get this module's functions with their code, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE_BYTES = 4 << 20

_COPY_SCHEMA = "file_id string, piece int, content binary, error string"

_ROWS_SCHEMA = "path string, file_name string, line string, faults array<string>, run_id string"

MANIFEST_SCHEMA = (
    "path string, file_name string, modificationTime timestamp, length bigint, "
    "reason string, missing array<string>, file_id string, run_id string"
)


def _file_id(path: Column) -> Column:
    """Folder name for a file's lines; two files of one name in different folders stay apart."""
    return F.md5(path)


def _pieces(path: str) -> Iterator[tuple[int, bytes | None, str | None]]:
    """A file's bytes in pieces that end with a line where one ends; an error in place of the rest."""
    number, held = 0, b""
    try:
        with open_stream(path) as stream:
            while block := stream.read(PIECE_BYTES):
                held += block
                cut = held.rfind(b"\n") + 1 or (len(held) if len(held) >= PIECE_BYTES else 0)
                if cut:
                    yield number, held[:cut], None
                    number, held = number + 1, held[cut:]
        if held or not number:
            yield number, held, None
    except OSError as fault:
        yield number, None, f"{type(fault).__name__}: {fault}"


def _copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, file_id in zip(*(batch.column(c).to_pylist() for c in ("path", "file_id")), strict=True):
            for number, content, error in _pieces(path):
                yield pa.RecordBatch.from_pydict({
                    "file_id": pa.array([file_id], pa.string()), "piece": pa.array([number], pa.int32()),
                    "content": pa.array([content], pa.binary()), "error": pa.array([error], pa.string())})


def _copied(files: DataFrame) -> DataFrame:
    spark = files.sparkSession
    first = files.select("path").first()["path"]
    if scheme_of(spark, first) in PEEK_SCHEMES:
        tasks = -(-files.count() // FILES_A_TASK)
        return files.select("path", "file_id").repartition(tasks).mapInArrow(_copy, _COPY_SCHEMA)
    # Names only; the reader needs them to plan its scan. It takes each file as one piece.
    paths = [literal_path(r["path"]) for r in files.select("path").collect()]
    return spark.read.option("ignoreCorruptFiles", "true").format("binaryFile").load(paths).select(
        _file_id(F.col("path")).alias("file_id"), F.lit(0).alias("piece"), "content",
        F.lit(None).cast("string").alias("error"))


def quarantine_files(rejected: DataFrame, root: str, run_id: str) -> None:
    """Writes the manifest of rejected files, then copies their bytes, compressed ones as they are.

    Tasks copy the files, each in pieces of about ``PIECE_BYTES``, so a file of any size is never
    held whole. A file that cannot be copied does not fail the run: its ``error`` takes the place of
    its bytes, and the manifest has it all the same.
    """
    files = rejected.select("path", "file_name", "modificationTime", "length", "reason", "missing",
                            _file_id(F.col("path")).alias("file_id"))
    if files.isEmpty():
        return
    files.write.mode("overwrite").parquet(f"{root}/files/run_id={run_id}")
    _copied(files).write.mode("overwrite").option("compression", CODEC).parquet(f"{root}/contents/run_id={run_id}")


def quarantine_rows(malformed: DataFrame, root: str, run_id: str) -> None:
    """Writes malformed rows with the file they came from and, where ``with_faults`` added them,
    their ``faults``."""
    known = F.col(FAULTS) if FAULTS in malformed.columns else F.lit(None).cast("array<string>")
    (
        malformed.select(
            plain_path(SOURCE_FILE).alias("path"),
            base_name(plain_path(SOURCE_FILE)).alias("file_name"),
            F.col(RAW_LINE).alias("line"),
            known.alias(FAULTS),
        )
        .write.mode("overwrite").option("compression", CODEC).parquet(f"{root}/rows/run_id={run_id}")
    )


def quarantined_files(spark: SparkSession, root: str) -> DataFrame:
    """The manifest of all runs."""
    if not path_exists(spark, f"{root}/files"):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/files")


def quarantined_contents(spark: SparkSession, root: str) -> DataFrame:
    """``file_id, piece, content, error, run_id``: the bytes of rejected files, in pieces in order."""
    return spark.read.schema(f"{_COPY_SCHEMA}, run_id string").parquet(f"{root}/contents")


def quarantined_lines(spark: SparkSession, root: str) -> DataFrame:
    """``value, run_id, file_id`` of all lines of rejected files that are not compressed.

    A line longer than a piece comes in parts.
    """
    packed = F.lower("file_name").rlike(r"\.(gz|bz2|zst|lz4|snappy|deflate)$")
    plain = quarantined_files(spark, root).filter(~packed).select("file_id", "run_id")
    text = F.decode("content", "UTF-8")
    return (
        quarantined_contents(spark, root).filter("octet_length(content) > 0")
        .join(plain.distinct(), ["file_id", "run_id"])
        .select(F.explode(F.split(F.regexp_replace(text, r"\r?\n\z", ""), r"\r?\n")).alias("value"),
                "run_id", "file_id")
    )


def quarantined_rows(spark: SparkSession, root: str) -> DataFrame:
    """``path, file_name, line, faults, run_id`` of all malformed rows.

    ``faults`` is null for rows written without them.
    """
    return spark.read.schema(_ROWS_SCHEMA).parquet(f"{root}/rows")
