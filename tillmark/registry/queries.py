"""The registered queries: name -> function of a session and a folder of supplied tables.

Dates leave the queries as ISO text and arrays as comma-separated text, so that rows compare the
same way in any engine. Every query reads its tables whole.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.functions.columns import (
    full_name,
    incentive,
    pack_extras,
    pack_extras_json,
    sales_month,
)
from tillmark.operators import enrich, monthly, ranking
from tillmark.plans import ledger, marts
from tillmark.plans.batch import (
    CUSTOMER_MART,
    CUSTOMER_MONTHLY,
    SALES_TEAM_MART_PARTITIONED,
    SELLER_MONTHLY,
    BatchConfig,
    monthly_of,
    run_arrivals,
    run_batch,
)
from tillmark.registry import supplied
from tillmark.registry.landing import (
    EXTRA,
    NO_STORE,
    NOTES,
    ODD,
    PLAIN,
    REORDERED,
    Shop,
    land,
    land_by_month,
    land_faulty,
    land_odd_files,
)
from tillmark.registry.supplied import star
from tillmark.schema import ACTIVE, CANONICAL, INACTIVE, SALES_SCHEMA
from tillmark.sinks import bucketed, committed, parquet, quarantine, tables
from tillmark.storage import fresh_folder, stored, together
from tillmark.sources import any_header, sales_csv
from tillmark.sources.catalog import (
    build_manifest,
    discover_headers,
    file_catalog,
    split_manifest,
    triage_extension,
)
from tillmark.sources.dimensions import FileTable, read_dimension

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _as_text(df: DataFrame) -> DataFrame:
    def plain(f: T.StructField):
        if isinstance(f.dataType, T.DateType):
            return F.col(f.name).cast("string").alias(f.name)
        if isinstance(f.dataType, T.ArrayType):
            return F.array_join(f.name, ",").alias(f.name)
        return F.col(f.name)

    return df.select(*[plain(f) for f in df.schema.fields])


# ---- marts and monthly tables ----------------------------------------------------------------


@query
def seller_monthly_incentive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.seller_monthly_incentive(*star(spark, sf_dir).parts)


@query
def seller_monthly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.seller_monthly_sales(*star(spark, sf_dir).parts)


@query
def customer_monthly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_monthly_sales(*star(spark, sf_dir).parts)


@query
def customer_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(marts.customer_mart(*star(spark, sf_dir).parts))


@query
def sales_team_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(marts.sales_team_mart(*star(spark, sf_dir).parts))


@query
def sales_team_mart_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written whole, then by month and store, as the nightly run does, and read back."""
    path = fresh_folder(spark, "mart")
    mart = stored(marts.sales_team_mart(*star(spark, sf_dir).parts), fresh_folder(spark, "whole-mart"))
    parquet.write_partitioned_mart(mart, path)
    return _as_text(parquet.read_partitioned_mart(spark, path))


@query
def seller_monthly_incentive_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for dimensions too large to broadcast."""
    s = star(spark, sf_dir)
    return marts.seller_monthly_incentive(s.sales, s.customer, s.store, s.sales_team, enrich.ALL_LARGE)


@query
def customer_monthly_sales_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for dimensions too large to broadcast."""
    s = star(spark, sf_dir)
    return marts.customer_monthly_sales(s.sales, s.customer, s.store, s.sales_team, enrich.ALL_LARGE)


# ---- joins -----------------------------------------------------------------------------------


@query
def enrich_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = star(spark, sf_dir)
    return _as_text(enrich.enrich_customer(s.sales, s.customer, s.small))


@query
def enrich_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = star(spark, sf_dir, products=True)
    return _as_text(enrich.enrich_store(s.sales, s.store, s.small))


@query
def enrich_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = star(spark, sf_dir, products=True)
    return _as_text(enrich.enrich_seller(s.sales, s.sales_team, s.small))


@query
def enrich_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(enrich.enrich_sales(*star(spark, sf_dir).parts))


@query
def enrich_sales_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star for dimensions too large to broadcast."""
    s = star(spark, sf_dir)
    return _as_text(enrich.enrich_sales(s.sales, s.customer, s.store, s.sales_team, enrich.ALL_LARGE))


@query
def unmatched_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = star(spark, sf_dir, narrowed=True, products=True)
    return _as_text(enrich.unmatched_sales(*s.parts))


# ---- windows and ranking ---------------------------------------------------------------------


@query
def customer_month_window_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = supplied.sales(spark, sf_dir).select("customer_id", "sales_date", "total_cost")
    return _as_text(monthly.customer_month_window_total(s))


@query
def seller_month_window_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = supplied.sales(spark, sf_dir).select(
        "store_id", "sales_person_id", "sales_date", "total_cost")
    return _as_text(monthly.seller_month_window_total(s))


@query
def rank_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank_sellers(marts.seller_monthly_sales(*star(spark, sf_dir).parts))


@query
def rank_many_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of whole stores, where the window of ``rank_sellers`` would be too large."""
    return ranking.rank_many_sellers(marts.seller_monthly_sales(*star(spark, sf_dir).parts))


# ---- columns ---------------------------------------------------------------------------------


@query
def sales_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month of every order, by function and by SQL expression."""
    orders = supplied.table(spark, sf_dir, "orders").withColumn(
        "order_date", F.col("o_orderdate").cast("date"))
    return orders.select(
        "o_orderkey", sales_month("order_date").alias("sales_month"),
        F.expr("SUBSTRING(order_date, 1, 7) AS sales_month_sql"),
    )


@query
def full_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of all customers; those in debt have a null last name and so a null full name."""
    c = supplied.table(spark, sf_dir, "customer").withColumns({
        "first": F.substring_index("c_name", "#", 1),
        "last": F.when(F.col("c_acctbal") >= 0, F.substring_index("c_name", "#", -1)),
    })
    return c.select("c_custkey", full_name("first", "last").alias("full_name"))


@query
def packed_extras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two extra columns of every line item packed into one; nulls skipped."""
    lines = supplied.table(spark, sf_dir, "lineitem").withColumns({
        "flag": F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")),
        "line": F.when(F.col("l_linestatus") == "O", F.col("l_linestatus")),
    })
    return lines.select(
        "l_orderkey", "l_linenumber", pack_extras(["flag", "line"]).alias("additional_column"),
        pack_extras_json(["flag", "line"]).alias("additional_json"),
        pack_extras([]).alias("no_extras"),
    )


@query
def incentive_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incentive rule on every line item, paid to returned ones; half cents go up."""
    lines = supplied.table(spark, sf_dir, "lineitem").withColumn(
        "amount", F.col("l_extendedprice").cast("decimal(18,2)"))
    paid = incentive("amount", F.col("l_returnflag") == "R")
    return lines.select("l_orderkey", "l_linenumber", "amount", paid.alias("incentive"))


@query
def distinct_customer_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = monthly.with_month_start(supplied.sales(spark, sf_dir))
    return monthly.month_as_text(dated.select(*monthly.CUSTOMER_MONTH).distinct())


@query
def union_all_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The empty relation, all sales, and all sales with the columns the other way round."""
    s = supplied.sales(spark, sf_dir, products=True)
    frames = [sales_csv.empty_sales(spark), s, s.select(*reversed(CANONICAL))]
    return _as_text(sales_csv.union_files(frames))


# ---- files -----------------------------------------------------------------------------------


def _folder(path: str = "path") -> Column:
    return F.element_at(F.split(path, "/"), -2)


@query
def extension_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per landed file."""
    catalog = triage_extension(file_catalog(spark, land(spark, sf_dir)))
    return catalog.select(_folder().alias("shape"), "is_csv")


@query
def file_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers as read by the tasks themselves and by a scan of the text; a row per file and way."""
    landing = land(spark, sf_dir)
    csvs = triage_extension(file_catalog(spark, landing)).filter("is_csv")
    found = [
        discover_headers(csvs, landing, method).select(
            F.lit(method).alias("method"), _folder().alias("shape"), "header")
        for method in ("peek", "scan")
    ]
    return _as_text(found[0].unionByName(found[1]))


@query
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per landed file."""
    landing = land(spark, sf_dir)
    files = build_manifest(file_catalog(spark, landing), landing)
    return _as_text(files.select(
        _folder().alias("shape"), "accepted", "missing", "extras", "reason"))


@query
def file_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed file with its verdict, the odd ones too, by both ways of reading headers."""
    landing = land(spark, sf_dir)
    land_odd_files(spark, sf_dir, landing)
    catalog = file_catalog(spark, landing)
    found = [
        build_manifest(catalog, landing, method).select(
            F.lit(method).alias("method"), _folder().alias("folder"),
            F.when(_folder() == ODD, F.col("file_name")).alias("odd_file"), "accepted", "reason")
        for method in ("peek", "scan")
    ]
    return found[0].unionByName(found[1])


def _staged(spark: SparkSession, landing: str) -> DataFrame:
    accepted, _ = split_manifest(build_manifest(file_catalog(spark, landing), landing))
    return sales_csv.stage_sales(spark, accepted, fresh_folder(spark, "staged"))


@query
def conformed_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of three shapes read as one relation: the sales they were made from."""
    return _as_text(sales_csv.well_formed(_staged(spark, land(spark, sf_dir))))


@query
def well_formed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = land(spark, sf_dir, bad_files=False, bad_cells=True)
    return _as_text(sales_csv.well_formed(_staged(spark, landing)))


@query
def malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a cell that does not parse, as quarantined."""
    root = fresh_folder(spark, "quarantine")
    landing = land(spark, sf_dir, bad_files=False, bad_cells=True)
    quarantine.quarantine_rows(sales_csv.malformed(_staged(spark, landing)), root, "1")
    rows = quarantine.quarantined_rows(spark, root)
    return rows.select(_folder().alias("shape"), "line")


def _accepted(spark: SparkSession, landing: str) -> DataFrame:
    """Accepted files, looked into once."""
    found = build_manifest(file_catalog(spark, landing), landing)
    return split_manifest(stored(found, fresh_folder(spark, "manifest")))[0]


@query
def row_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed rows, as quarantined, with the columns whose cells do not parse."""
    root = fresh_folder(spark, "quarantine")
    accepted = _accepted(spark, land_faulty(spark, sf_dir))
    bad = sales_csv.malformed(any_header.stage_files(spark, accepted, fresh_folder(spark, "staged")))
    quarantine.quarantine_rows(any_header.with_faults(bad, accepted), root, "1")
    return _as_text(quarantine.quarantined_rows(spark, root).select("line", "faults"))


@query
def many_headers_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a header of their own for each month, read by one scan."""
    accepted = _accepted(spark, land_by_month(spark, sf_dir))
    staged = any_header.stage_any_header(spark, accepted, fresh_folder(spark, "staged"))
    return _as_text(sales_csv.well_formed(staged))


@query
def quarantined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of rejected files but their header lines, as quarantined."""
    root = fresh_folder(spark, "quarantine")
    landing = land(spark, sf_dir)
    _, rejected = split_manifest(build_manifest(file_catalog(spark, landing), landing))
    quarantine.quarantine_files(rejected, root, "1")
    files = quarantine.quarantined_files(spark, root)
    lines = quarantine.quarantined_lines(spark, root).join(files, "file_id")
    header = ",".join(c for c in SALES_SCHEMA.names[:-1] if c != "store_id")
    return lines.filter(F.col("value") != header).select(
        _folder().alias("shape"), F.col("value").alias("line"), "reason")


@query
def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of one mart, the older one holding every sale twice; the newer one is read."""
    root = fresh_folder(spark, "marts")
    mart = marts.customer_mart(*star(spark, sf_dir).parts)
    # The mart is made once; the epoch, not when it was written, says which is the newer one.
    once = spark.read.parquet(parquet.publish_snapshot(mart, root, "customers", 1_700_000_001_000))
    parquet.publish_snapshot(once.unionAll(once), root, "customers", 1_700_000_000_000)
    return _as_text(parquet.latest_snapshot(spark, root, "customers"))


def _batch(spark: SparkSession, sf_dir: str) -> BatchConfig:
    """The nightly run over landed files, two of them odd, twice."""
    folder = fresh_folder(spark, "batch")
    dims, landing = together(spark, lambda: _dimension_files(spark, sf_dir, folder), lambda: land(spark, sf_dir))
    land_odd_files(spark, sf_dir, landing)
    conf = BatchConfig(
        landing=landing, root=f"{folder}/out", dimensions=dims,
        monthly_tables={SELLER_MONTHLY: FileTable(f"{folder}/seller_table")},
    )
    run_batch(spark, conf, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    run_batch(spark, conf, dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc))
    return conf


@query
def run_whole_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the nightly run appended for the sellers."""
    conf = _batch(spark, sf_dir)
    return read_dimension(spark, conf.monthly_tables[SELLER_MONTHLY]).drop(tables.RUN_ID)


@query
def batch_customer_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the nightly run published as the customer mart."""
    return _as_text(parquet.latest_snapshot(spark, _batch(spark, sf_dir).root, CUSTOMER_MART))


@query
def batch_sales_team_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the nightly run published as the sales-team mart by month and store."""
    root = _batch(spark, sf_dir).root
    return _as_text(parquet.latest_snapshot(spark, root, SALES_TEAM_MART_PARTITIONED, partitioned=True))


@query
def batch_customer_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the nightly run published as the customers' months."""
    return parquet.latest_snapshot(spark, _batch(spark, sf_dir).root, CUSTOMER_MONTHLY)


@query
def batch_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after two nightly runs: a row per file that was taken up."""
    state = ledger.ledger_state(ledger.ledger_events(spark, _batch(spark, sf_dir).ledger))
    return state.select(_folder("file_location").alias("folder"), "status", "run_id")


# ---- files as they arrive --------------------------------------------------------------------

#: What lands before the first and before the second call.
WAVES = ((PLAIN, EXTRA, NOTES), (REORDERED, NO_STORE))


def _dimension_files(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, FileTable]:
    dims = {}
    for name, make in ((enrich.CUSTOMER, supplied.customers), (enrich.STORE, supplied.stores),
                       (enrich.SALES_TEAM, supplied.sellers)):
        make(spark, sf_dir).write.parquet(f"{folder}/{name}")
        dims[name] = FileTable(f"{folder}/{name}")
    return dims


def _arrivals(spark: SparkSession, sf_dir: str, monthly: str = "runs") -> tuple[BatchConfig, str]:
    """Sales that land in two waves, each taken in by a call, and a third call that finds nothing.

    While a call takes in a wave, the next one is written aside.
    """
    folder = fresh_folder(spark, "arrivals")
    shop, dims = together(spark, lambda: Shop(spark, sf_dir), lambda: _dimension_files(spark, sf_dir, folder))
    conf = BatchConfig(landing=shop.landing, root=f"{folder}/out", monthly=monthly, by_month_and_store=False,
                       dimensions=dims)
    call = partial(run_arrivals, spark, conf, f"{folder}/archive")
    shop.add_all(WAVES[0])
    for wave in WAVES[1:]:
        _, land_them = together(spark, call, partial(shop.make_ready, wave))
        land_them()
    shop.close()
    call()
    call()
    return conf, f"{folder}/archive"


@query
def arrived_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each landed file with the call that took it in, its verdict, and where it lies afterwards."""
    conf, archive = _arrivals(spark, sf_dir)
    taken = ledger.ledger_state(ledger.ledger_events(spark, conf.ledger)).select(
        F.col("file_location").alias("path"), "run_id", F.lit(None).cast("string").alias("reason"))
    rejected = quarantine.quarantined_files(spark, conf.quarantine).select("path", "run_id", "reason")
    lying = [file_catalog(spark, place).select("path", "file_name", F.lit(name).alias("place"))
             for name, place in (("landing", conf.landing), ("archive", archive))]
    seen = taken.unionByName(rejected).withColumns({"shape": _folder(), "file_name": F.element_at(F.split("path", "/"), -1)})
    there = lying[0].unionByName(lying[1]).withColumn("shape", _folder()).drop("path")
    return there.join(seen, ["shape", "file_name"], "full").select("shape", "run_id", "reason", "place")


@query
def arrived_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the customer marts that the two calls published, with the call."""
    conf, _ = _arrivals(spark, sf_dir)
    found = [spark.read.parquet(parquet.snapshot_path(conf.root, CUSTOMER_MART, run)).withColumn("run", F.lit(run))
             for run in range(len(WAVES))]
    return _as_text(found[0].unionByName(found[1]))


@query
def arrived_seller_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sellers' months merged over both calls: a row for each, the best found over all sales."""
    return monthly_of(spark, _arrivals(spark, sf_dir, "months")[0], SELLER_MONTHLY)


@query
def arrived_customer_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' months merged over both calls."""
    return monthly_of(spark, _arrivals(spark, sf_dir, "months")[0], CUSTOMER_MONTHLY)


# ---- tables ----------------------------------------------------------------------------------


@query
def read_dimension_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers read as Parquet, and once more as CSV with a stated schema."""
    path = fresh_folder(spark, "dimension")
    supplied.table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    as_csv = FileTable(path, "csv", supplied.SCHEMAS["customer"], {"header": "true"})
    found = [("parquet", FileTable(f"{sf_dir}/customer.parquet")), ("csv", as_csv)]
    both = [read_dimension(spark, source).withColumn("read_as", F.lit(kind)) for kind, source in found]
    return both[0].unionByName(both[1])


@query
def append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run appended twice (it counts once), then another run."""
    target = FileTable(fresh_folder(spark, "table"))
    source = fresh_folder(spark, "monthly")
    parquet.write_mart(marts.customer_monthly_sales(*star(spark, sf_dir).parts), source)
    result = spark.read.parquet(source)
    for run in ("1", "1", "2"):
        tables.append_run(result, target, run, ("customer_id", "sales_date_month"))
    return read_dimension(spark, target)


@query
def append_committed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run appended twice to a table of committed runs (it counts once), then another run."""
    path = fresh_folder(spark, "committed")
    result = marts.customer_monthly_sales(*star(spark, sf_dir).parts)
    for run in ("1", "1", "2"):
        committed.append_committed(result, path, run)
    return committed.read_committed(spark, path, result.schema)


#: Buckets of the supplied shop's tables; at scale some thousands.
BUCKETS = 16


@query
def customer_monthly_sales_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two nights' sums, finished lines and open ones, and the customers, in tables bucketed alike."""
    small = supplied.small_dimensions(spark, sf_dir)
    lines = supplied.sales(spark, sf_dir, small, keep=("l_linestatus",))
    s, folder, name = star(spark, sf_dir), fresh_folder(spark, "bucketed"), f"t{uuid.uuid4().hex}"
    for status, mode in (("F", "overwrite"), ("O", "append")):
        night = lines.where(F.col("l_linestatus") == status)
        sums = bucketed.write_bucketed(
            bucketed.customer_sums(night, s.store, s.sales_team, s.small), f"{name}_sums",
            f"{folder}/sums", [bucketed.BUCKET_KEY], BUCKETS, mode)
    who = bucketed.write_bucketed(s.customer, f"{name}_customer", f"{folder}/customer",
                                  [bucketed.BUCKET_KEY], BUCKETS)
    return bucketed.customer_monthly_of_sums(sums, who)


# ---- ledger ----------------------------------------------------------------------------------


def _order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order taken for a waiting file."""
    name = F.concat(F.lit("order_"), F.col("o_orderkey").cast("string"), F.lit(".csv"))
    return supplied.table(spark, sf_dir, "orders").select(
        name.alias("file_name"), F.concat(F.lit("in/"), name).alias("path"), "o_orderstatus", "o_orderpriority")


def _order_steps(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, str, str, dt.datetime]]:
    """Files, run, status and time, as if all orders of the priorities below 5 had been taken up, and
    those of status F finished a day later; of these, the ones of priority 1 are taken up again by a
    second run."""
    files = _order_files(spark, sf_dir)
    day = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)
    taken = files.filter("o_orderpriority NOT LIKE '5%'")
    done = taken.filter("o_orderstatus = 'F'")
    return [(taken, "1", ACTIVE, day), (done, "1", INACTIVE, day + dt.timedelta(days=1)),
            (done.filter("o_orderpriority LIKE '1%'"), "2", ACTIVE, day + dt.timedelta(days=2))]


def _order_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = [ledger.make_events(*step) for step in _order_steps(spark, sf_dir)]
    return events[0].unionByName(events[1]).unionByName(events[2])


@query
def ledger_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(ledger.ledger_state(_order_ledger(spark, sf_dir)))


@query
def ledger_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same states from a written ledger, with a snapshot after each of the first two steps."""
    path = fresh_folder(spark, "ledger")
    for files, run, status, at in _order_steps(spark, sf_dir):
        if status == ACTIVE:
            ledger.ledger_open(files, path, run, at)
        else:
            ledger.ledger_close(files, path, run, at)
        if run == "1":
            ledger.compact_ledger(spark, path)
    return _states(ledger.current_state(spark, path))


def _states(state: DataFrame) -> DataFrame:
    return state.select(
        "file_name", "file_location", "status", "run_id",
        F.date_format("created_date", "yyyy-MM-dd").alias("created_date"),
        F.date_format("updated_date", "yyyy-MM-dd").alias("updated_date"),
    )


@query
def active_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unfinished ones: of all files, and of five names, one of which no file has."""
    state = ledger.ledger_state(_order_ledger(spark, sf_dir))
    asked = [f"order_{i}.csv" for i in (0, 1, 2, 3)] + ["order_none.csv"]
    found = [("all", ledger.active_file_names(state)), ("asked", ledger.active_file_names(state, asked))]
    both = [df.withColumn("among", F.lit(among)) for among, df in found]
    return both[0].unionByName(both[1])


@query
def unfinished_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = ledger.ledger_state(_order_ledger(spark, sf_dir))
    return ledger.unfinished_files(_order_files(spark, sf_dir), state).select("path")


@query
def files_to_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = ledger.ledger_state(_order_ledger(spark, sf_dir))
    return ledger.without_finished(_order_files(spark, sf_dir), state).select("path")
