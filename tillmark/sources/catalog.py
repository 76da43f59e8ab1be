"""Which files wait in the landing area, and which of them can be used.

Everything here is about files, not rows: one row per file, and only the first line of a file is
read. No file is opened on the driver.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.functions.columns import (
    base_name,
    extra_columns,
    missing_columns,
    plain_path,
)
from tillmark.storage import few_listers, hidden_files, literal_path, scheme_of

# Tasks get this module's functions with their code, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NAMES = T.ArrayType(T.StringType())
_FOUND = [T.StructField("header", _NAMES), T.StructField("problem", T.StringType())]

FILES_A_TASK = 64

# Stores that a Python task can open without Hadoop's client libraries.
PEEK_SCHEMES = {"file", "s3", "s3a", "s3n", "gs"}


class NoInputFiles(ValueError):
    """The landing area holds nothing to process."""


def file_catalog(spark: SparkSession, landing: str) -> DataFrame:
    """One row per file at any depth below ``landing``: path, file_name, modificationTime, length, hidden.

    Spark does the listing; the contents are not read. ``hidden`` files, whose name or folder begins
    with ``_`` or ``.``, Spark does not list: the store is asked for them, and only the marks that
    Spark and Hadoop leave are passed over. An empty or absent folder raises ``NoInputFiles``.
    """
    try:
        listing = (
            spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
        )
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            raise NoInputFiles(f"no such landing folder: {landing}") from err
        raise
    listing = listing.select("path", "modificationTime", "length")
    names = listing._jdf.inputFiles()
    hidden = hidden_files(spark, landing)
    if not len(names) and not hidden:
        raise NoInputFiles(f"no files below {landing}")
    if len(names) > listing.count():
        listing = _with_empty_files(listing, names)
    listing = listing.withColumn("hidden", F.lit(False))
    if hidden:
        unlisted = spark.createDataFrame(hidden, "path string, changed bigint, length bigint").select(
            "path", F.timestamp_millis("changed").alias("modificationTime"), "length",
            F.lit(True).alias("hidden"))
        listing = listing.unionByName(unlisted)
    return listing.withColumn("file_name", base_name("path"))


def _with_empty_files(listing: DataFrame, names) -> DataFrame:
    """The listing with files of length 0, which a scan leaves out, from the names in Spark's file index.

    Joined so that the files, which the scan asks the store about one by one, are scanned once.
    """
    spark = listing.sparkSession
    # One call for all names; they are percent-encoded and hold no line break.
    text = spark.sparkContext._jvm.org.apache.hadoop.util.StringUtils.join("\n", names)
    encoded = spark.createDataFrame([(n,) for n in text.split("\n")], "value string")
    path = F.regexp_replace(plain_path("value"), "^file:/+", "file:/")
    return listing.join(encoded.select(path.alias("path")), "path", "full").select(
        "path", F.coalesce("modificationTime", F.timestamp_seconds(F.lit(0))).alias("modificationTime"),
        F.coalesce("length", F.lit(0).cast("bigint")).alias("length"),
    )


def triage_extension(catalog: DataFrame) -> DataFrame:
    """Adds ``is_csv``: whether the name ends in ``.csv`` (lower case only)."""
    return catalog.withColumn("is_csv", F.col("path").endswith(".csv"))


# ---- headers ---------------------------------------------------------------------------------


def parse_header(line: str | None) -> list[str]:
    """Column names in one header line, under the names Spark's CSV reader would give them.

    Quoted names may hold commas. An empty name becomes ``_c<position>``; names that occur more
    than once (ignoring case) get their position appended.
    """
    if not line or not line.strip():
        return []
    names = next(csv.reader([line], escapechar="\\", doublequote=True), [])
    folded = [n.lower() for n in names]
    return [
        f"_c{i}" if not n else (f"{n}{i}" if folded.count(n.lower()) > 1 else n)
        for i, n in enumerate(names)
    ]


def open_stream(path: str):
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file" or not rest:
        local = "/" + (rest or path).lstrip("/")
        return fs.LocalFileSystem().open_input_stream(local, compression=None, buffer_size=1 << 16)
    bucket, _, key = rest.lstrip("/").partition("/")
    store, _ = fs.FileSystem.from_uri(f"{'s3' if scheme.startswith('s3') else scheme}://{bucket}")
    return store.open_input_stream(f"{bucket}/{key}", compression=None, buffer_size=1 << 16)


def _first_line(path: str) -> str | None:
    """The first line that is not blank; reads on until it is complete, however long it is."""
    with open_stream(path) as raw, io.TextIOWrapper(
        raw, encoding="utf-8-sig", errors="replace"
    ) as text:
        return next((line.rstrip("\n") for line in text if line.strip()), None)


def _peeked(path: str) -> tuple[list[str] | None, str | None]:
    try:
        return parse_header(_first_line(path)), None
    except (OSError, csv.Error, EOFError) as fault:
        return None, f"cannot be read: {type(fault).__name__}"


def _peek(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [_peeked(p) for p in batch["path"]]
        yield batch.assign(header=[h for h, _ in found], problem=[e for _, e in found])


def _peek_headers(files: DataFrame) -> DataFrame:
    schema = T.StructType([*files.schema.fields, *_FOUND])
    # Opening files takes time, not data: tasks by the number of files.
    tasks = -(-files.count() // FILES_A_TASK)
    return files.repartition(max(1, tasks)).mapInPandas(_peek, schema)


@F.pandas_udf(_NAMES)
def _parse_headers(lines: pd.Series) -> pd.Series:
    return lines.map(parse_header)


def _scan_headers(files: DataFrame) -> DataFrame:
    spark = files.sparkSession
    # Names only; the reader needs them to plan its scan. A hidden file cannot be scanned.
    paths = [literal_path(r["path"]) for r in files.where("length > 0 AND NOT hidden").select("path").collect()]
    if not paths:
        return files.withColumns({"header": F.array().cast(_NAMES), "problem": F.lit(None).cast("string")})
    with few_listers(spark, len(paths)):
        text = spark.read.text(paths)
    lines = (
        text
        .select("value", F.col("_metadata.file_path").alias("encoded"),
                F.col("_metadata.file_block_start").alias("block"))
        .filter((F.col("block") == 0) & F.col("value").rlike(r"\S"))
        # A file's first block is read by one task, in order.
        .withColumn("position", F.monotonically_increasing_id())
    )
    first = lines.groupBy("encoded").agg(F.min_by("value", "position").alias("line"))
    named = first.select(
        plain_path("encoded").alias("path"), _parse_headers("line").alias("header")
    )
    return files.join(named, "path", "left").withColumns({
        "header": F.coalesce("header", F.array().cast(_NAMES)), "problem": F.lit(None).cast("string")})


def discover_headers(files: DataFrame, landing: str, method: str = "auto") -> DataFrame:
    """Adds ``header``, the column names in the first line with more than white space (empty for a
    file without one), and ``problem``, why a file could not be read (then ``header`` is null).

    ``peek`` lets each task open its files, ``FILES_A_TASK`` of them, and read only as far as that
    line. ``scan`` is for stores a Python task cannot open: one Spark job over the text of these
    files, as a scan cannot stop after the first line; a file it cannot read fails it. ``auto`` takes
    ``peek`` where the store allows it. Both find the same headers.
    """
    if method == "auto":
        method = "peek" if scheme_of(files.sparkSession, landing) in PEEK_SCHEMES else "scan"
    if method == "peek":
        return _peek_headers(files)
    if method == "scan":
        return _scan_headers(files)
    raise ValueError(f"unknown method {method!r}")


# ---- manifest --------------------------------------------------------------------------------


def build_manifest(catalog: DataFrame, landing: str, method: str = "auto") -> DataFrame:
    """One row per file with its verdict.

    Columns: path, file_name, modificationTime, length, header, missing, extras, accepted, reason.
    A file is rejected for its extension, for a name that Spark's readers pass over, because it
    cannot be read, or for lacking mandatory columns; the order of columns and the presence of others
    do not matter.
    """
    triaged = triage_extension(catalog)
    usable = F.col("is_csv") & ~F.col("hidden")
    none = F.array().cast(_NAMES)
    checked = discover_headers(triaged.filter(usable), landing, method)
    read = F.col("problem").isNull()
    checked = checked.withColumn("header", F.coalesce("header", none)).withColumns({
        "missing": F.when(read, missing_columns("header")).otherwise(none),
        "extras": F.when(read, extra_columns("header")).otherwise(none)})
    others = triaged.filter(~usable).withColumns(
        {"header": none, "missing": none, "extras": none, "problem": F.lit(None).cast("string")}
    )
    reason = (
        F.when(~F.col("is_csv"), F.lit("not a .csv file"))
        .when(F.col("hidden"), F.lit("name begins with _ or ."))
        .when(F.col("problem").isNotNull(), F.col("problem"))
        .when(F.size("missing") > 0, F.concat(F.lit("missing columns: "), F.array_join("missing", ",")))
    )
    return (
        checked.unionByName(others)
        .withColumn("reason", reason)
        .withColumn("accepted", F.col("reason").isNull())
        .drop("is_csv", "hidden", "problem")
    )


def split_manifest(manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected)."""
    return manifest.filter("accepted"), manifest.filter("NOT accepted")
