"""A table of appended runs whose rows show once, all together, or not at all.

A Python data source writes it: each task puts its rows into a file of its own in a hidden folder and
tells the driver the name; when all tasks have ended, the driver lists these names in one small file for
the run, and only what is listed there is read. So rows of a task that was lost after it had written,
of a second attempt of the same task, or of a run that failed are never seen, whatever lies in the
folder; and a run that is listed already is not listed again.

Tasks open the files themselves, in stores that ``catalog.open_stream`` can open too.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tillmark.storage import child_files, literal_path, path_exists

# Tasks get this module's classes with their code, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "tillmark_committed"
_STAGED, _RUNS = "_staged", "_runs"
RUN_ID = "run_id"


def _store(path: str):
    """The file system of a path, and the path in it."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file" or not rest:
        return fs.LocalFileSystem(), "/" + (rest or path).lstrip("/")
    bucket, _, key = rest.lstrip("/").partition("/")
    store, _ = fs.FileSystem.from_uri(f"{'s3' if scheme.startswith('s3') else scheme}://{bucket}")
    return store, f"{bucket}/{key}"


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: a file's name, none for no rows."""

    file: str | None
    rows: int


class CommittedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, run_id: str):
        self.path, self.run_id = path.rstrip("/"), run_id

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        store, root = _store(self.path)
        name, rows, out = f"{self.run_id}-{uuid.uuid4().hex}.parquet", 0, None
        for batch in batches:
            if batch.num_rows:
                if out is None:
                    store.create_dir(f"{root}/{_STAGED}", recursive=True)
                    out = pq.ParquetWriter(f"{root}/{_STAGED}/{name}", batch.schema, filesystem=store)
                out.write_batch(batch)
                rows += batch.num_rows
        if out is not None:
            out.close()
        return Written(name if out is not None else None, rows)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        told = [m for m in messages if m is not None]
        listing = {"files": sorted(m.file for m in told if m.file), "rows": sum(m.rows for m in told)}
        store.create_dir(f"{root}/{_RUNS}", recursive=True)
        final = f"{root}/{_RUNS}/{self.run_id}.json"
        if store.get_file_info(final).is_file:  # listed by an earlier attempt: these rows are not needed
            self._remove(listing["files"])
            return
        # Written aside and moved, so that a list is whole when it shows.
        aside = f"{root}/{_RUNS}/.{uuid.uuid4().hex}"
        with store.open_output_stream(aside) as out:
            out.write(json.dumps(listing).encode())
        store.move(aside, final)

    def abort(self, messages: list[Written | None]) -> None:
        self._remove([m.file for m in messages if m is not None and m.file])

    def _remove(self, files: list[str]) -> None:
        store, root = _store(self.path)
        for name in files:
            store.delete_file(f"{root}/{_STAGED}/{name}")


class CommittedTable(DataSource):
    """``df.write.format(FORMAT).option("path", ...).option("run_id", ...).mode("append").save()``"""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> CommittedWriter:
        if overwrite:
            raise ValueError("a committed table is only appended to")
        run_id = self.options.get(RUN_ID, "")
        if not run_id or "/" in run_id or run_id.startswith((".", "_")):
            raise ValueError(f"not a run id: {run_id!r}")
        return CommittedWriter(self.options["path"], run_id)


def append_committed(df: DataFrame, path: str, run_id: str) -> None:
    """Appends a run's rows once: nothing happens for a run that the table has."""
    spark = df.sparkSession
    if path_exists(spark, f"{path}/{_RUNS}/{run_id}.json"):
        return
    spark.dataSource.register(CommittedTable)
    rows = df.withColumn(RUN_ID, F.lit(run_id))
    rows.write.format(FORMAT).option("path", path).option(RUN_ID, run_id).mode("append").save()


def committed_runs(spark: SparkSession, path: str) -> DataFrame:
    """``run_id``, ``rows`` and ``files`` of every run that the table has."""
    schema = "files array<string>, rows long"
    names = [n for n in child_files(spark, f"{path}/{_RUNS}") if n.endswith(".json") and not n.startswith(".")]
    if not names:
        return spark.createDataFrame([], f"{schema}, run_id string")
    # Named one by one, as Spark's readers pass over folders that begin with a line.
    lists = spark.read.schema(schema).json([f"{literal_path(path)}/{_RUNS}/{literal_path(n)}" for n in names])
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    return lists.withColumn(RUN_ID, F.regexp_replace(name, r"\.json$", ""))


def read_committed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all runs that the table has. ``schema`` is that of the appended rows."""
    schema = spark.createDataFrame([], schema).withColumn(RUN_ID, F.lit("")).schema
    files = committed_runs(spark, path).select(F.explode("files").alias("name")).collect()  # names only
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{literal_path(path)}/{_STAGED}/{literal_path(r['name'])}" for r in files])
