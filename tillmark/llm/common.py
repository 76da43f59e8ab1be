"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import pickle
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.storage import fresh_folder, literal_path, stored

LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ship_by_value(module_name: str) -> None:
    """Task code travels with the task, so that executors need no installed package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def sent_by_value(spark: SparkSession, model: object) -> Broadcast:
    """A broadcast of an object and the code of its class; ``received`` makes it in the task."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def received(sent: Broadcast) -> object:
    return pickle.loads(sent.value)


def worker_cache(key: object, make: Callable[[], object], user: str | None = None) -> object:
    """What ``make`` returns, made once in each Python worker and kept for its later tasks.

    Workers outlive stages. What one ``user`` has kept goes when another comes; without a user it
    stays.
    """
    kept = sys.modules.setdefault("tillmark_llm_cache", types.ModuleType("tillmark_llm_cache")).__dict__
    held = kept.setdefault("held", {})
    if user is not None and kept.get("user") != user:
        kept["user"] = user
        for other in [k for k, (owner, _) in held.items() if owner is not None]:
            del held[other]
    if key not in held:
        held[key] = (user, make())
    return held[key][1]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


#: Rows that Spark hands to Python at a time. Its own default, 10,000, is made for short rows; of
#: texts that would be hundreds of MB in the executor and again in its Python.
TEXTS_A_BATCH = 512


def for_texts(spark: SparkSession) -> SparkSession:
    """The session, set to hand texts to Python in small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS_A_BATCH))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "documents"))


def digest16(text: Column) -> Column:
    """The first 16 bytes of SHA-256: equal for equal texts only, for all practical purposes."""
    return F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32))


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _give_back() -> None:
    """Hands memory that is free back to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in small parts, so that a task holds the results of a few rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    _give_back()


def text_apart(docs: DataFrame) -> DataFrame:
    """``text``, and all other columns as ``row``, whatever their names."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*rest).alias("row"), "text")


def row_type(apart: DataFrame) -> str:
    return f"row {apart.schema['row'].dataType.simpleString()}"


def kept_table(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, readable after any executor is lost."""
    return stored(df, fresh_folder(df.sparkSession, f"llm-{purpose}"))


__all__ = [
    "TEXTS_A_BATCH", "digest16", "documents", "for_texts", "fresh_folder", "kept_table",
    "literal_path", "lower_ascii", "received", "row_type", "sent_by_value", "sha256_hex",
    "ship_by_value", "sliced", "stored",
    "table_path", "text_apart", "worker_cache",
]
ship_by_value(__name__)
