"""Lines of landing files with any number of different headers, read in one scan.

Every line is parsed to cells by position; which cell is which column comes from a table with a row
a file. So the plan is the same for two headers and for thousands: it grows only with the number of
different widths. The same parsing says which cells of a row are at fault.

Cells are read by Spark's own CSV functions with the options that ``sales_csv`` reads files with, so
that both give the same rows, the partly read ones too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.functions.columns import extra_columns, plain_path
from tillmark.operators.sizing import small_tables
from tillmark.schema import ADDITIONAL, MANDATORY, MANDATORY_TYPES
from tillmark.sources.sales_csv import RAW_LINE, SOURCE_FILE, STAGED_SCHEMA, stage_sales
from tillmark.storage import CODEC, few_listers, literal_path

FAULTS = "faults"
#: The fault of a line that has not as many cells as its file's header.
CELL_COUNT = "number of cells"

# With more different headers than this, one scan a header makes too large a plan.
FEW_HEADERS = 64

_TYPED = tuple(c for c, t in MANDATORY_TYPES.items() if not isinstance(t, T.StringType))
_LAYOUTS = "layouts"
# A character that ends no cell of a text file: lines are read as the only cell of theirs.
_NEVER = "\u0001"
_AS_IT_IS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "mode": "PERMISSIVE"}


def file_layouts(accepted: DataFrame) -> DataFrame:
    """``path, width, places, extras`` a file: where the sales columns are, and the others in order."""
    places = F.array(*[F.array_position("header", c).cast("int") for c in MANDATORY])
    extras = F.transform(extra_columns("header"), lambda c: F.array_position("header", c).cast("int"))
    return accepted.select("path", F.size("header").alias("width"), places.alias("places"),
                           extras.alias("extras"))


def raw_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``source_file, line`` of all lines but blank ones and each file's header."""
    schema = f"line string, {RAW_LINE} string"
    with few_listers(spark, len(paths)):
        rows = (
            spark.read.schema(schema).option("header", True).option("enforceSchema", True)
            .option("sep", _NEVER).option("quote", "").option("columnNameOfCorruptRecord", RAW_LINE)
            .csv([literal_path(p) for p in paths])
        )
    return rows.select(F.col("_metadata.file_path").alias(SOURCE_FILE),
                       F.coalesce(RAW_LINE, "line").alias("line"))


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _cells(line: str, width: int) -> Column:
    """The first ``width`` cells of a line, and whether they are all it has."""
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)]
                          + [T.StructField(RAW_LINE, T.StringType())])
    parsed = F.from_csv(line, schema.simpleString()[len("struct<"):-1].replace(":", " "),
                        {**_AS_IT_IS, "columnNameOfCorruptRecord": RAW_LINE})
    return _once(parsed, lambda p: F.struct(
        F.array(*[p[f"c{i}"] for i in range(width)]).alias("cells"), p[RAW_LINE].isNull().alias("whole")))


def _typed(cells: str, places: str) -> Column:
    """The typed sales columns as a struct, read from text by Spark's CSV parser.

    A cell that does not parse is null there; the others are what they are.
    """
    text = F.struct(*[F.get(cells, F.get(places, F.lit(MANDATORY.index(c))) - 1).alias(c) for c in _TYPED])
    schema = ", ".join(f"{c} {MANDATORY_TYPES[c].simpleString()}" for c in _TYPED)
    return F.from_csv(F.to_csv(text, _AS_IT_IS), f"{schema}, {RAW_LINE} string",
                      {**_AS_IT_IS, "columnNameOfCorruptRecord": RAW_LINE, "dateFormat": "yyyy-MM-dd"})


def _widths(layouts: DataFrame) -> list[int]:
    """The different widths of headers: a handful, as they are numbers of columns."""
    return [r["width"] for r in layouts.select("width").distinct().orderBy("width").collect()]


def parse_lines(lines: DataFrame, layouts: DataFrame) -> DataFrame:
    """The rows of ``lines`` (``source_file, line``) as staged rows, with ``faults``.

    ``faults`` names the columns whose cell does not parse, or ``number of cells``; it is empty for a
    row without fault, and only such a row has no ``malformed_line``. The layouts are broadcast if
    they are small by measure, else joined by a shuffle.
    """
    if small_tables({_LAYOUTS: layouts.select("path", "width")}):
        layouts = F.broadcast(layouts)
    read = F.coalesce(F.lit(None).cast("struct<cells:array<string>,whole:boolean>"), *[
        F.when(F.col("width") == w, _cells("line", w)) for w in _widths(layouts)])
    found = (
        lines.withColumn("path", plain_path(SOURCE_FILE)).join(layouts, "path")
        .withColumn("read", read).withColumns({"cells": F.col("read.cells"), "whole": F.col("read.whole")})
        .withColumn("typed", _typed("cells", "places"))
    )

    def text_of(c: str) -> Column:
        return F.get("cells", F.get("places", F.lit(MANDATORY.index(c))) - 1)

    wrong = F.array_compact(F.array(*[
        F.when(text_of(c).isNotNull() & F.col("typed")[c].isNull(), F.lit(c)) for c in _TYPED]))
    extras = F.array_join(F.transform("extras", lambda i: F.get("cells", i - 1)), ",")
    packed = F.when(F.size("extras") > 0, extras)
    values = [(F.col("typed")[c] if c in _TYPED else text_of(c)).alias(c) for c in MANDATORY]
    faults = F.when(F.col("whole"), wrong).otherwise(F.array(F.lit(CELL_COUNT)))
    return found.select(*values, packed.alias(ADDITIONAL), SOURCE_FILE, "line", faults.alias(FAULTS)).select(
        *MANDATORY, ADDITIONAL, SOURCE_FILE,
        F.when(F.size(FAULTS) > 0, F.col("line")).alias(RAW_LINE), FAULTS)


def stage_any_header(spark: SparkSession, accepted: DataFrame, path: str) -> DataFrame:
    """What ``stage_sales`` stages, with ``faults``, by one job and one scan whatever the headers.

    ``stage_sales`` parses each line once instead of up to three times, and is the better choice as
    long as headers are few.
    """
    # Names only; the reader needs them to plan its scan.
    paths = [r["path"] for r in accepted.select("path").collect()]
    schema = T.StructType([*STAGED_SCHEMA.fields, T.StructField(FAULTS, T.ArrayType(T.StringType()))])
    rows = parse_lines(raw_lines(spark, paths), file_layouts(accepted)) if paths else (
        spark.createDataFrame([], schema))
    rows.write.mode("overwrite").option("compression", CODEC).parquet(path)
    return spark.read.schema(schema).parquet(path)


def stage_files(spark: SparkSession, accepted: DataFrame, path: str,
                few_headers: int = FEW_HEADERS) -> DataFrame:
    """The staged rows by whichever of the two ways suits the number of different headers."""
    headers = accepted.select("header").distinct().limit(few_headers + 1).count()
    if headers <= few_headers:
        return stage_sales(spark, accepted, path)
    return stage_any_header(spark, accepted, path).drop(FAULTS)


def with_faults(malformed: DataFrame, accepted: DataFrame) -> DataFrame:
    """``malformed`` (``source_file, malformed_line``) with ``faults``: only these lines are parsed again.

    The names of the columns whose cells do not parse, in the order of the sales relation, or
    ``number of cells``.
    """
    lines = malformed.select(SOURCE_FILE, F.col(RAW_LINE).alias("line"))
    return parse_lines(lines, file_layouts(accepted)).select(SOURCE_FILE, RAW_LINE, FAULTS)
