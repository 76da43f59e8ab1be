"""Small questions to the file system behind a path, asked through Spark's own client."""

from __future__ import annotations

import os
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


# What Spark and Hadoop write beside data.
_MARKER = re.compile(r"_SUCCESS|_temporary|_spark_metadata|_committed.*|_started.*|\..*\.crc")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def literal_path(path: str) -> str:
    """A path Spark's readers take as it is, even with characters that would form a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


#: Paths that a task of Spark's asks the store about, when it is given them to read.
PATHS_A_LISTER = 64
LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_listing = Lock()


@contextmanager
def few_listers(spark: SparkSession, paths: int) -> Iterator[None]:
    """So many paths are given to a reader within: Spark then asks about many in a task, instead of one."""
    with _listing:
        before = spark.conf.get(LISTERS)
        spark.conf.set(LISTERS, str(min(int(before), max(1, -(-paths // PATHS_A_LISTER)))))
        try:
            yield
        finally:
            spark.conf.set(LISTERS, before)


#: Whether Spark removes a query's shuffle files when the query ends.
FILES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_within: Counter[str] = Counter()
_before: dict[str, str] = {}
_going = Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is run within leaves no shuffle files: each query's are removed when it ends.

    Else they stay until the driver happens to collect its garbage, so that a run of many steps holds
    all of its shuffles on disk. For steps that each plan anew what they run, as those that end in files
    do; a frame that is run twice would be shuffled again. May be nested, also side by side.
    """
    app = spark.sparkContext.applicationId
    with _going:
        _within[app] += 1
        if _within[app] == 1:
            _before[app] = spark.conf.get(FILES_GO, "false")
            spark.conf.set(FILES_GO, "true")
    try:
        yield
    finally:
        with _going:
            _within[app] -= 1
            if not _within[app]:
                spark.conf.set(FILES_GO, _before.pop(app))


def scheme_of(spark: SparkSession, path: str) -> str:
    """``file``, ``hdfs``, ``s3a`` ...; also for a path that leaves it to the cluster's default."""
    return _fs(spark, path)[0].getUri().getScheme()


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Renames a folder; nothing may be at ``to`` yet."""
    fs, target = _fs(spark, to)
    if fs.exists(target):
        raise FileExistsError(to)
    fs.mkdirs(target.getParent())
    if not fs.rename(_fs(spark, path)[1], target):
        raise OSError(f"cannot move {path} to {to}")


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file written from the driver."""
    fs, p = _fs(spark, path)
    out = fs.create(p)
    out.write(bytearray(content), 0, len(content))
    out.close()


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; empty when it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below ``path``; empty when it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]


def count_files(spark: SparkSession, path: str, pattern: str) -> int:
    """How many names directly below ``path`` are of a pattern; the names stay with Spark's client."""
    fs, p = _fs(spark, f"{literal_path(path)}/{pattern}")
    return len(fs.globStatus(p) or [])


def hidden_files(spark: SparkSession, root: str) -> list[tuple[str, int, int]]:
    """Path, milliseconds of change and length of files that Spark's readers do not list.

    That is, files whose name, or a folder's name on the way from ``root``, begins with ``_`` or
    ``.``. What Spark and Hadoop leave behind themselves is passed over. The store is asked for these
    names only, level by level, so that what comes back is as many rows as there are such files.
    """
    fs, base = _fs(spark, literal_path(root.rstrip("/")))
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found: dict[str, tuple[int, int]] = {}
    depth = 0
    while True:
        level = f"{base}" + "/*" * depth
        hidden = fs.globStatus(path_of(f"{level}/{{_,.}}*"))
        for status in hidden or []:
            if _MARKER.fullmatch(status.getPath().getName()):
                continue
            within = [status] if status.isFile() else _all_below(fs, status.getPath())
            for file in within:
                if not _MARKER.fullmatch(file.getPath().getName()):
                    found[file.getPath().toString()] = (file.getModificationTime(), file.getLen())
        if not len(fs.globStatus(path_of(f"{level}/*")) or []):
            return [(path, *facts) for path, facts in sorted(found.items())]
        depth += 1


def _all_below(fs, folder):
    files = fs.listFiles(folder, True)
    while files.hasNext():
        yield files.next()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: the cluster's ``spark.checkpoint.dir``.

    Where none is set, a session on a single machine (a test) gets one in its warehouse, which goes
    when the session's JVM ends; on a cluster that is an error, as nobody has said which folder its
    executors share.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    made = f"{warehouse}/shared-{uuid.uuid4().hex}"
    sc.setCheckpointDir(made)
    fs, path = _fs(spark, made)
    fs.deleteOnExit(path)
    return made


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return os.path.join(shared_folder(spark), f"{purpose}-{uuid.uuid4().hex}")


#: How sales are compressed that only a run itself, or a look into its quarantine, reads: they take a fourth to
#: a third less room than by Spark's default. Not for dimensions: Spark takes a table for small by its file's size.
CODEC = "zstd"


def stored(df: DataFrame, path: str, **options: str) -> DataFrame:
    """The frame as written to and read back from Parquet: computed once, and cut from its past."""
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """What the jobs return. They run at the same time, so that one's last tasks leave no core idle.

    An error is raised when all have ended: none goes on behind the caller's back.
    """
    with ThreadPool(len(jobs)) as pool:
        running = [pool.apply_async(inheritable_thread_target(spark)(job)) for job in jobs]
        for one in running:
            one.wait()
    return [one.get() for one in running]
