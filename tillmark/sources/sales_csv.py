"""Landing CSV files as one typed sales relation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.functions.columns import pack_extras
from tillmark.schema import ADDITIONAL, MANDATORY, MANDATORY_TYPES, SALES_SCHEMA
from tillmark.storage import CODEC, few_listers, literal_path

SOURCE_FILE = "source_file"
RAW_LINE = "malformed_line"

STAGED_SCHEMA = T.StructType(
    SALES_SCHEMA.fields
    + [T.StructField(SOURCE_FILE, T.StringType()), T.StructField(RAW_LINE, T.StringType())]
)


def empty_sales(spark: SparkSession, schema: T.StructType = SALES_SCHEMA) -> DataFrame:
    """The sales relation with no rows."""
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, extras: Sequence[str], keep: Sequence[str] = (), pack=pack_extras
            ) -> DataFrame:
    """The sales columns in their fixed order, with any other columns packed into one."""
    return df.select(*MANDATORY, pack(extras).alias(ADDITIONAL), *keep)


def union_files(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames, duplicates kept, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_layout(spark: SparkSession, header: Sequence[str], paths: Sequence[str],
                pack=pack_extras) -> DataFrame:
    """One scan over all files that share a header.

    Types are stated, so nothing is inferred. A row with a cell that does not parse, or with too
    few or too many cells, keeps its text in ``malformed_line``.
    """
    raw = RAW_LINE
    while raw in header:
        raw = "_" + raw
    schema = T.StructType(
        [T.StructField(n, MANDATORY_TYPES.get(n, T.StringType()), True) for n in header]
        + [T.StructField(raw, T.StringType(), True)]
    )
    with few_listers(spark, len(paths)):
        rows = (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", raw)
            .option("dateFormat", "yyyy-MM-dd")
            .csv([literal_path(p) for p in paths])
        )
    extras = [n for n in header if n not in MANDATORY_TYPES]
    return conform(
        rows, extras,
        [F.col("_metadata.file_path").alias(SOURCE_FILE), F.col(raw).alias(RAW_LINE)], pack,
    )


def _files_by_header(accepted: DataFrame) -> dict[tuple[str, ...], list[str]]:
    """File names, which Spark's own file index holds on the driver as well; never rows."""
    files: dict[tuple[str, ...], list[str]] = {}
    for row in accepted.select("header", "path").collect():
        files.setdefault(tuple(row["header"]), []).append(row["path"])
    return dict(sorted(files.items()))


def read_sales_csv(spark: SparkSession, accepted: DataFrame, pack=pack_extras) -> DataFrame:
    """Every row of every accepted file: the sales columns, ``source_file``, ``malformed_line``.

    A CSV scan matches columns by position, so files are read together only when their headers
    are equal: the plan has one scan per distinct header, however many files there are. Use
    ``stage_sales`` to tell good rows from bad, and for more headers than a plan should hold.
    """
    files = _files_by_header(accepted)
    if not files:
        return empty_sales(spark, STAGED_SCHEMA)
    return union_files(read_layout(spark, h, paths, pack) for h, paths in files.items())


def stage_sales(spark: SparkSession, accepted: DataFrame, path: str, pack=pack_extras,
                headers_per_job: int = 64) -> DataFrame:
    """The rows of ``read_sales_csv`` written to Parquet at ``path`` and read back.

    The files are parsed once, whole. Splitting well-formed from malformed rows must start from
    here: on the raw files a query that needs few columns would have Spark parse only those, and
    a fault in another column would go unseen. Any number of distinct headers is dealt with by
    writing in several jobs.
    """
    files = list(_files_by_header(accepted).items())
    empty_sales(spark, STAGED_SCHEMA).write.mode("overwrite").parquet(path)
    for start in range(0, len(files), headers_per_job):
        layouts = files[start:start + headers_per_job]
        union_files(read_layout(spark, h, paths, pack) for h, paths in layouts).write.mode(
            "append").option("compression", CODEC).parquet(path)
    return spark.read.schema(STAGED_SCHEMA).parquet(path)


def well_formed(staged: DataFrame) -> DataFrame:
    """The sales columns of rows that were read without fault."""
    return staged.filter(F.col(RAW_LINE).isNull()).select(*SALES_SCHEMA.names)


def malformed(staged: DataFrame) -> DataFrame:
    """``source_file, malformed_line`` of rows that were not."""
    return staged.filter(F.col(RAW_LINE).isNotNull()).select(SOURCE_FILE, RAW_LINE)
