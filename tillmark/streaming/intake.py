"""Taking landed files in once, as a stream, and moving them away.

The landing folder is the source of a stream that runs until nothing new is left. Spark's file source
remembers in the checkpoint which files it has handed on, so a call sees new names only; those handed on
are moved to the archive by Spark when the next files are taken in, so what has to be listed is what came
since the last call and the files before that, whatever has landed in all the time.

A batch is handed on again, with the same number and files, if the call stopped before it was finished:
what handles it must give the same result twice. Files whose name begins with ``_`` or ``.`` are none to
Spark: they are neither handed on nor moved. An empty file is moved like the others, but it makes no row.
A file that changes after it was handed on is not seen again, unless under another name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions.columns import base_name
from tillmark.storage import LISTERS, fresh_folder, remove_folder

#: What Spark's binary source has; the contents are never selected, so they are not read.
_FILE = "path string, modificationTime timestamp, length bigint, content binary"

#: Threads of the driver that move files: moving is a rename or a copy in the store.
MOVERS = 8

Handle = Callable[[DataFrame, int], None]


def arriving_files(spark: SparkSession, landing: str, archive: str, files_a_batch: int | None = None
                   ) -> DataFrame:
    """A stream of files below ``landing``, as ``catalog.file_catalog`` lists them."""
    reader = (
        spark.readStream.format("binaryFile").schema(_FILE)
        .option("recursiveFileLookup", "true")
        .option("cleanSource", "archive").option("sourceArchiveDir", archive)
    )
    if files_a_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    return reader.load(landing).select(
        "path", "modificationTime", "length", F.lit(False).alias("hidden"), base_name("path").alias("file_name"))


def take_in(spark: SparkSession, landing: str, archive: str, checkpoint: str, handle: Handle,
            files_a_batch: int | None = None) -> list[int]:
    """Hands new files to ``handle`` in batches, and returns the numbers of the batches.

    ``archive`` must lie outside ``landing``; files keep their whole path below it. An error of
    ``handle`` is raised, and its batch is the first one of the next call.
    """
    if f"{archive.rstrip('/')}/".startswith(f"{landing.rstrip('/')}/"):
        raise ValueError("the archive must lie outside the landing folder")
    done: list[int] = []

    def one(files: DataFrame, number: int) -> None:
        # The stream's own session plans without adaptive execution: what follows runs in the caller's.
        path = fresh_folder(spark, "arrived")
        files.write.parquet(path)
        handle(spark.read.schema(files.schema).parquet(path), number)
        remove_folder(spark, path)
        done.append(number)

    # The source gives its reader each batch's paths one by one, and those of the last batch again when a
    # call begins: it asks about them in the caller's session, by no more tasks than there are cores.
    settings = {"spark.sql.streaming.fileSource.cleaner.numThreads": str(MOVERS),
                LISTERS: str(spark.sparkContext.defaultParallelism)}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        stream = (
            arriving_files(spark, landing, archive, files_a_batch)
            .writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        stream.awaitTermination()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    return done
