"""Measures the choices behind the plans. Prints one line per measurement.

    python tools/measure.py [rows of the large trial, default 20000000]

- grouped: seller table by group-by, as built; windowed: the registered SQL (window, distinct, rank)
- headers: one CSV scan per distinct header; files: one inferring CSV scan per file
- nightly: the whole run on a day's file of 400,000 rows
- hot: monthly tables of a large trial in which one customer and one seller hold a third of the rows
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tillmark.plans import marts  # noqa: E402
from tillmark.plans.batch import BatchConfig, run_batch  # noqa: E402
from tillmark.registry import supplied  # noqa: E402
from tillmark.registry.oracles import ORACLES  # noqa: E402
from tillmark.registry.queries import QUERIES  # noqa: E402
from tillmark.schema import MANDATORY  # noqa: E402
from tillmark.storage import fresh_folder  # noqa: E402
from tillmark.sources.catalog import build_manifest, file_catalog, split_manifest  # noqa: E402
from tillmark.sources.dimensions import FileTable  # noqa: E402
from tillmark.sources.sales_csv import read_sales_csv  # noqa: E402
from tillmark.sources.synth import (  # noqa: E402
    FIRST_STORE,
    synth_customers,
    synth_sales,
    trial_ids,
)


def best(fn, repeats: int = 3) -> float:
    times = []
    for _ in range(repeats):
        start = time.perf_counter()
        fn()
        times.append(time.perf_counter() - start)
    return min(times)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def report(what: str, seconds: float) -> None:
    print(f"{what}: {seconds:.2f} s", flush=True)


def seller_table(spark: SparkSession, sf_dir: str) -> None:
    for name in ("supplier", "customer", "nation", "region", "orders", "lineitem", "part"):
        supplied.table(spark, sf_dir, name).createOrReplaceTempView(name)
    sql = ORACLES["seller_monthly_incentive"].replace("VARCHAR", "STRING")
    report("grouped, sf0.1", best(
        lambda: run(QUERIES["seller_monthly_incentive"](spark, sf_dir)), 4))
    report("windowed, sf0.1", best(lambda: run(spark.sql(sql)), 4))


def many_files(spark: SparkSession, files: int = 200, rows: int = 2000) -> None:
    landing = fresh_folder(spark, "landing")
    plain = synth_sales(trial_ids(spark, files // 2 * rows))
    extra = synth_sales(trial_ids(spark, files // 2 * rows), variant="extra_column")
    for name, df in (("plain", plain), ("extra", extra)):
        df.repartition(files // 2).write.option("header", True).csv(f"{landing}/{name}")

    def by_header() -> None:
        accepted, _ = split_manifest(build_manifest(file_catalog(spark, landing), landing))
        run(read_sales_csv(spark, accepted))

    paths = [r["path"] for r in file_catalog(spark, landing).collect()]

    def by_file() -> None:
        frames = [
            spark.read.option("header", True).option("inferSchema", True).csv(p)
            .select(*MANDATORY) for p in paths]
        run(reduce(DataFrame.unionAll, frames))

    report(f"headers, {files} files of {rows} rows", best(by_header, 2))
    report(f"files, {files} files of {rows} rows", best(by_file, 1))


def trial_dimensions(spark: SparkSession, folder: str, customers: int, sellers: int
                     ) -> dict[str, FileTable]:
    people = synth_customers(trial_ids(spark, customers + 1))
    frames = {
        "customer": people,
        "store": spark.range(FIRST_STORE, FIRST_STORE + 4).selectExpr(
            "id", "'Quay' address", "'1' store_pincode", "'m' store_manager_name",
            "cast(null as date) store_opening_date", "'' reviews"),
        "sales_team": synth_customers(trial_ids(spark, sellers + 1)).selectExpr(
            "customer_id id", "first_name", "last_name", "1L manager_id", "'N' is_manager",
            "address", "pincode", "customer_joining_date joining_date"),
    }
    for name, df in frames.items():
        df.write.parquet(f"{folder}/{name}")
    return {name: FileTable(f"{folder}/{name}") for name in frames}


def nightly(spark: SparkSession, rows: int = 400_000) -> None:
    folder = fresh_folder(spark, "nightly")
    synth_sales(trial_ids(spark, rows), variant="daily").coalesce(1).write.option(
        "header", True).csv(f"{folder}/in")
    conf = BatchConfig(f"{folder}/in", f"{folder}/out", trial_dimensions(spark, folder, 20, 9))
    start = time.perf_counter()
    run_batch(spark, conf, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    report(f"nightly, {rows} rows in one file", time.perf_counter() - start)


def hot_keys(spark: SparkSession, rows: int) -> None:
    """A million customers and 200,000 sellers; a third of all sales is customer 1's, by seller 1."""
    folder = fresh_folder(spark, "hot")
    people, sellers = 1_000_000, 200_000
    i = F.col("id")
    hot = F.xxhash64(i) % 3 == 0
    sales = spark.range(0, rows, 1, 32).select(
        F.when(hot, 1).otherwise(F.pmod(F.xxhash64(i, F.lit(1)), F.lit(people))).alias("customer_id"),
        F.when(hot, FIRST_STORE).otherwise(
            FIRST_STORE + F.pmod(F.xxhash64(i, F.lit(2)), F.lit(3))).alias("store_id"),
        F.date_add(F.lit(dt.date(2023, 1, 1)),
                   F.pmod(F.xxhash64(i, F.lit(3)), F.lit(720)).cast("int")).alias("sales_date"),
        F.when(hot, 1).otherwise(F.pmod(F.xxhash64(i, F.lit(4)), F.lit(sellers))
                                 ).alias("sales_person_id"),
        (F.pmod(F.xxhash64(i, F.lit(5)), F.lit(100_000)) / 100).cast("decimal(18,2)")
        .alias("total_cost"))
    sales.write.parquet(f"{folder}/sales")
    sales = spark.read.parquet(f"{folder}/sales")
    dims = trial_dimensions(spark, folder, people, sellers)
    tables = [spark.read.parquet(dims[n].path) for n in ("customer", "store", "sales_team")]
    for label, small in (("broadcast", {"customer", "store", "sales_team"}), ("shuffled", set())):
        for name in ("customer_monthly_sales", "seller_monthly_incentive", "customer_mart"):
            df = getattr(marts, name)(sales, *tables, small)
            report(f"hot, {rows} rows, {name}, {label}", best(lambda: run(df), 1))


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 20_000_000
    spark = (
        SparkSession.builder.master("local[8]").appName("measure")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seller_table(spark, "/root/testdata/sf0.1")
    many_files(spark)
    nightly(spark)
    hot_keys(spark, rows)


if __name__ == "__main__":
    main()
