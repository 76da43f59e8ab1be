"""Landing areas made from the supplied sales, for queries about files."""

from __future__ import annotations

import gzip
import math
from collections.abc import Callable, Collection, Sequence
from copy import copy
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.registry import supplied
from tillmark.schema import MANDATORY
from tillmark.storage import (
    CODEC,
    child_files,
    child_folders,
    count_files,
    few_listers,
    fresh_folder,
    literal_path,
    move_folder,
    remove_folder,
    shuffles_removed,
    stored,
    together,
    write_bytes,
)

# The shapes files come in. The three good ones hold the line items by return flag.
PLAIN, EXTRA, REORDERED = "plain", "extra", "reordered"
RETURN_FLAG = {PLAIN: "A", EXTRA: "N", REORDERED: "R"}
NO_STORE, NOTES = "no_store", "notes"
# Sales of a file, and how many files have the few notes.
ROWS_A_FILE = 10_000
NOTES_FILES = 3
# Files that a task writes one after the other, and neighbours that go to the same task.
FILES_A_WRITER = 16
NEIGHBOURS = 4
# One of so many of the files that the sales are stored in has those that are dealt out to landing files.
STORED_A_DEALT = 16
# The task that writes a sale.
_WRITER = "writer"

# A folder of odd files, one or more for each nation.
ODD = "odd"
ODD_KINDS = ("good", "_hidden", "tab_first", "empty", "damaged", "packed")


class Shop:
    """All supplied sales, and a landing folder that gets them as CSV files, shape by shape."""

    def __init__(self, spark: SparkSession, sf_dir: str, bad_cells: bool = False):
        self.spark, self.sf_dir = spark, sf_dir
        self.landing = fresh_folder(spark, "landing")
        self.stored = fresh_folder(spark, "sales")
        with shuffles_removed(spark):
            self._store(bad_cells)

    def _store(self, bad_cells: bool) -> None:
        small = supplied.small_dimensions(self.spark, self.sf_dir)
        derived = supplied.sales(self.spark, self.sf_dir, small, products=True,
                                 keep=("l_returnflag", "l_linestatus"))
        if bad_cells:
            text = F.when(F.col("quantity") > 45, F.lit("n/a")).otherwise(
                F.col("quantity").cast("string"))
            derived = derived.withColumn("quantity", text)
        self.rows = stored(derived, self.stored, compression=CODEC)
        names = sorted(n for n in child_files(self.spark, self.stored) if n.startswith("part-"))
        cut = -(-len(names) // STORED_A_DEALT)
        self.rest, self.most = self._of_files(names[:cut]), self._of_files(names[cut:])
        self.of_rest, self.of_most = together(self.spark, *[partial(self._by_flag, d) for d in (self.rest, self.most)])

    def _of_files(self, names: list[str]) -> DataFrame:
        with few_listers(self.spark, len(names)):
            return self.spark.read.schema(self.rows.schema).parquet(
                *[literal_path(f"{self.stored}/{n}") for n in names]) if names else self.rows.limit(0)

    @staticmethod
    def _by_flag(rows: DataFrame) -> dict[str, int]:
        return {r["l_returnflag"]: r["count"] for r in rows.groupBy("l_returnflag").count().collect()}  # three flags

    def _land(self, make: Callable[[DataFrame], DataFrame], shape: str, flags: Collection[str]) -> None:
        """What ``make`` makes of the sales with these flags, in a file for each full ``ROWS_A_FILE`` and one more.

        Most are written by the tasks that scan them, without a shuffle, each task's last file being less
        than full. The rest is dealt out to as many files as are lacking then, so that the number is right
        whatever tasks Spark made; a file takes so many sales that these are of much the same size. Where
        the tasks' last files would be too many for that, or there are no sales of a part, all are dealt out.
        """
        most, rest = (sum(part.get(f, 0) for f in flags) for part in (self.of_most, self.of_rest))
        files, tasks = (most + rest) // ROWS_A_FILE + 1, self.most.rdd.getNumPartitions()
        cut = math.ceil((most + rest) / (files - tasks / 2)) if files > tasks else 0
        if most and cut and rest >= cut * tasks:
            self._csv(make(self.most), shape, cut)
            lacking = files - count_files(self.spark, f"{self.landing}/{shape}", "part-*")
            if lacking > 0:
                return self._write(make(self.rest), shape, lacking, rest)
            remove_folder(self.spark, f"{self.landing}/{shape}")
        return self._write(make(self.rows), shape, files, most + rest)

    def _csv(self, df: DataFrame, shape: str, cut: int) -> None:
        """Tasks write files one after the other, of ``cut`` rows if that is not 0, and move them into place
        themselves; a repeated one writes the same names."""
        df.write.mode("append").option("header", True).option("maxRecordsPerFile", cut).option(
            "mapreduce.fileoutputcommitter.algorithm.version", "2").csv(f"{self.landing}/{shape}")

    def _write(self, df: DataFrame, shape: str, files: int, rows: int | None = None) -> None:
        """As many files, of much the same size; ``rows`` is how many there are, if it is known.

        Rows say by their place which task they go to, some neighbours to the same: so Spark need not
        sort them first, as it does to deal rows out alike when a task is repeated.

        Files are numbered, every ``writers``-th belongs to the same task, and neighbours go to the files in
        turn: so a scan's task gives each writer its share but for twice ``NEIGHBOURS`` rows. A file takes a
        little more than its share, so that a writer's last one is about half full: what all scan tasks
        give too much or too little then makes no file more or less. Where it could, each file has a task.
        """
        count = df.count() if rows is None else rows
        spare = count / files / 2 - 2 * NEIGHBOURS * df.rdd.getNumPartitions()
        writers = -(-files // FILES_A_WRITER) if spare > 1 else files
        most = -(-files // writers)
        turn = F.shiftright(F.monotonically_increasing_id(), NEIGHBOURS.bit_length() - 1) + F.hash(
            F.spark_partition_id()).cast("bigint")
        writer = F.pmod(F.pmod(turn, F.lit(files)), F.lit(writers)).cast("int")
        dealt = df.withColumn(_WRITER, writer).repartitionById(writers, F.col(_WRITER)).drop(_WRITER)
        cut = round(count / files * (1 + 1 / (2 * most))) if most > 1 else 0
        self._csv(dealt, shape, cut)

    def add_all(self, shapes: Sequence[str]) -> None:
        with shuffles_removed(self.spark):
            together(self.spark, *[partial(self.add, shape) for shape in shapes])

    def close(self) -> None:
        """All that was to land has landed: the stored sales go."""
        remove_folder(self.spark, self.stored)

    def make_ready(self, shapes: Sequence[str]) -> Callable[[], None]:
        """Writes files of these shapes aside; what is returned lets them land."""
        aside = copy(self)
        aside.landing = fresh_folder(self.spark, "aside")
        aside.add_all(shapes)

        def land_them() -> None:
            for shape in child_folders(self.spark, aside.landing):
                move_folder(self.spark, f"{aside.landing}/{shape}", f"{self.landing}/{shape}")

        return land_them

    def add(self, shape: str) -> None:
        """The sales of a shape, or files that are none; more files the more sales there are."""
        if shape == NOTES:
            notes = supplied.table(self.spark, self.sf_dir, "region").select("r_name")
            notes.repartition(NOTES_FILES).write.text(f"{self.landing}/{NOTES}")
            return
        if shape == NO_STORE:
            wanted = [c for c in MANDATORY if c != "store_id"]
            self._land(lambda rows: rows.select(*wanted), shape, self.of_most.keys() | self.of_rest.keys())
            return
        flag = RETURN_FLAG[shape]
        if flag not in self.of_most and flag not in self.of_rest:
            return
        payment = F.when(F.col("l_linestatus") == "O", F.lit("cash")).alias("payment_mode")
        coupon = F.concat(F.lit("c"), F.col("customer_id").cast("string")).alias("coupon")
        columns = {PLAIN: [*MANDATORY], EXTRA: [*MANDATORY, payment, coupon], REORDERED: [*reversed(MANDATORY)]}
        self._land(lambda rows: rows.filter(F.col("l_returnflag") == flag).select(*columns[shape]), shape, [flag])


def land(spark: SparkSession, sf_dir: str, bad_files: bool = True, bad_cells: bool = False) -> str:
    """Writes all supplied sales as CSV files of three shapes and returns the folder.

    ``bad_files`` adds all sales once more without ``store_id``, and a folder of files that are not
    CSV. ``bad_cells`` writes ``n/a`` for the quantity of sales of more than 45 pieces.
    """
    shop = Shop(spark, sf_dir, bad_cells)
    shop.add_all((PLAIN, EXTRA, REORDERED, *((NO_STORE, NOTES) if bad_files else ())))
    shop.close()
    return shop.landing


def _land_lines(lines: DataFrame, landing: str, folders: list[str]) -> None:
    """Writes lines of text as CSV files, as they are, by folders; the order within a task stays."""
    lines.write.partitionBy(*folders).option("sep", "\u0001").option("quote", "").option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(landing)


def _texts(columns: tuple[str, ...]) -> Column:
    return F.array(*[F.col(c).cast("string") for c in columns])


def _with_header_lines(rows: DataFrame) -> DataFrame:
    """A file for every ``month`` and ``part``: its ``header``, then its lines."""
    heads = rows.select("month", "part", F.lit(0).alias("rank"), F.col("header").alias("line")).distinct()
    own = rows.select("month", "part", F.lit(1).alias("rank"), "line")
    return heads.unionByName(own).repartition("month", "part").sortWithinPartitions("month", "part", "rank").drop("rank")


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplied sales with their ``month`` and a ``part``, so many that files stay small."""
    small = supplied.small_dimensions(spark, sf_dir)
    sales = supplied.sales(spark, sf_dir, small, products=True, keep=("l_returnflag", "l_linestatus"))
    dated = sales.withColumn("month", F.date_format("sales_date", "yyyy_MM"))
    # A bound for the parts of the largest month, of which there are some 80.
    parts = supplied.table(spark, sf_dir, "lineitem").count() // (40 * ROWS_A_FILE) + 1
    return dated.withColumn("part", F.pmod(F.xxhash64("customer_id", "product_name"), F.lit(parts)))


def land_by_month(spark: SparkSession, sf_dir: str) -> str:
    """All supplied sales, in files whose header is that of their month, and returns the folder.

    The columns begin with another one from month to month; a column ``note_<month>`` has the return
    flag, and in odd months ``ref_<month>`` the line status.
    """
    turn = F.month("sales_date") % F.lit(len(MANDATORY))
    odd = F.month("sales_date") % 2 == 1

    def line(mandatory: Column, note: Column, ref: Column) -> Column:
        turned = F.concat(F.slice(mandatory, turn + 1, F.lit(len(MANDATORY))), F.slice(mandatory, F.lit(1), turn))
        return F.array_join(F.concat(turned, F.array(note), F.when(odd, F.array(ref)).otherwise(F.array())), ",")

    names = F.array(*[F.lit(c) for c in MANDATORY])
    month = F.col("month")
    rows = _monthly(spark, sf_dir).withColumns({
        "header": line(names, F.concat(F.lit("note_"), month), F.concat(F.lit("ref_"), month)),
        "line": line(_texts(MANDATORY), F.col("l_returnflag"), F.col("l_linestatus"))})
    landing = fresh_folder(spark, "landing")
    _land_lines(_with_header_lines(rows), landing, ["month", "part"])
    return landing


def land_faulty(spark: SparkSession, sf_dir: str) -> str:
    """All supplied sales in files by month, many with faults, and returns the folder.

    The quantity is ``n/a`` above 45 and the price ``free`` below 5; the date of open lines is
    ``soon`` below 10; a quantity of 20 is followed by a surplus cell, and one of 30 is the last cell.
    """
    quantity = F.col("quantity")
    faulty = _monthly(spark, sf_dir).withColumns({
        "sales_date": F.when((F.col("l_linestatus") == "O") & (quantity < 10), F.lit("soon")).otherwise(
            F.col("sales_date").cast("string")),
        "price": F.when(quantity < 5, F.lit("free")).otherwise(F.col("price").cast("string")),
        "pieces": F.when(quantity > 45, F.lit("n/a")).otherwise(quantity.cast("string"))})
    columns = tuple("pieces" if c == "quantity" else c for c in MANDATORY)
    cells = _texts(columns)
    shown = F.when(quantity == 30, F.slice(cells, 1, len(columns) - 1)).when(
        quantity == 20, F.concat(cells, F.array(F.lit("more")))).otherwise(cells)
    rows = faulty.withColumns({"header": F.lit(",".join(MANDATORY)), "line": F.array_join(shown, ",")})
    landing = fresh_folder(spark, "landing")
    _land_lines(_with_header_lines(rows), landing, ["month", "part"])
    return landing


def land_odd_files(spark: SparkSession, sf_dir: str, landing: str) -> None:
    """Adds a file for each nation, of the kinds in turn: usable, with a hidden name, with a first
    line of a tab, without a byte, named as compressed without being it, and compressed."""
    header = ",".join(MANDATORY)
    names = supplied.table(spark, sf_dir, "nation").select("n_nationkey").orderBy("n_nationkey")
    for row in names.collect():  # 25 nations
        kind = ODD_KINDS[row["n_nationkey"] % len(ODD_KINDS)]
        text = {"tab_first": f"\t\n{header}\n", "empty": ""}.get(kind, f"{header}\n").encode()
        if kind == "packed":
            text = gzip.compress(text, mtime=0)
        end = ".csv.gz" if kind in ("damaged", "packed") else ".csv"
        write_bytes(spark, f"{landing}/{ODD}/{kind}_{row['n_nationkey']}{end}", text)
