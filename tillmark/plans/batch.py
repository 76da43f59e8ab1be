"""The nightly run: from waiting CSV files to published marts, tables and ledger.

Each stage ends in files in a shared folder, and the next one starts from those. So the CSV files
are parsed once, an executor that is lost costs only its tasks, and no result depends on a stage
being computed the same way twice. Each step can be repeated under the same run id without
doubling anything.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.operators.enrich import CUSTOMER, DIMENSIONS, SALES_TEAM, STORE, unmatched_sales
from tillmark.operators.sizing import small_tables
from tillmark.operators.monthly import CUSTOMER_MONTH, SELLER_MONTH
from tillmark.plans import marts
from tillmark.plans.months import Finish, note_run, read_months, rewrite_months, totals_of_run
from tillmark.plans.ledger import (
    current_state,
    keep_small,
    ledger_close,
    ledger_open,
    unfinished_files,
    without_finished,
)
from tillmark.schema import INACTIVE
from tillmark.sinks.parquet import publish_snapshot, read_partitioned_mart, write_mart
from tillmark.sinks.quarantine import quarantine_files, quarantine_rows, quarantined_files
from tillmark.storage import fresh_folder, remove_folder, shuffles_removed, stored, together
from tillmark.sinks.tables import append_run, append_table
from tillmark.sources.catalog import build_manifest, file_catalog, split_manifest
from tillmark.sources.dimensions import (
    FileTable,
    JdbcTable,
    assert_unique_key,
    read_dimension,
)
from tillmark.streaming.intake import take_in
from tillmark.sources.any_header import stage_files, with_faults
from tillmark.sources.sales_csv import malformed, well_formed

#: Sales, customer, store, sales team, and which of these are small.
Star = tuple[DataFrame, DataFrame, DataFrame, DataFrame, Collection[str]]

DIMENSION_KEYS = {CUSTOMER: "customer_id", STORE: "id", SALES_TEAM: "id"}

CUSTOMER_MART = "customer_data_mart"
SALES_TEAM_MART = "sales_team_data_mart"
SALES_TEAM_MART_PARTITIONED = "sales_partitioned_data_mart"
CUSTOMER_MONTHLY = "customer_monthly"
SELLER_MONTHLY = "seller_monthly"

#: Column with the month, and the ids and month that the sums are by.
MONTHS = {
    CUSTOMER_MONTHLY: ("sales_date_month", CUSTOMER_MONTH),
    SELLER_MONTHLY: ("sales_month", SELLER_MONTH),
}

MONTHLY_KEYS = {
    CUSTOMER_MONTHLY: ("customer_id", "sales_date_month"),
    SELLER_MONTHLY: ("store_id", "sales_person_id", "sales_month"),
}


class NoUsableFiles(ValueError):
    """Files are waiting, but none can be processed."""


class UnfinishedRun(RuntimeError):
    """An earlier run took up files and did not finish them."""


@dataclass(frozen=True)
class BatchConfig:
    """Where a run reads and writes. Nothing is fixed in the code.

    ``dimensions`` names a source for customer, store and sales_team. ``monthly_tables`` may name
    tables that the two monthly results are appended to; with ``run_column`` (the default) these
    have a ``run_id`` column, by which a repeated run adds nothing twice. ``on_unfinished`` is what
    to do about files an earlier run left unfinished: ``"fail"``, or ``"resume"`` that run first
    under its own id. What is staged in the shared folder is removed after a run has succeeded.

    ``monthly`` is how the monthly results of several runs go together: with ``"runs"`` each run
    publishes and appends its own; with ``"months"`` they are also merged into tables with one row per
    key and month (``monthly_of``), of which a run rewrites only the months it has sales of.
    ``by_month_and_store`` says whether the sales-team mart is published in that layout as well.
    """

    landing: str
    root: str
    dimensions: Mapping[str, JdbcTable | FileTable]
    monthly_tables: Mapping[str, JdbcTable | FileTable] = field(default_factory=dict)
    run_column: bool = True
    on_unfinished: str = "fail"
    header_method: str = "auto"
    audit_unmatched: bool = False
    monthly: str = "runs"
    by_month_and_store: bool = True

    def __post_init__(self):
        if self.monthly not in ("runs", "months"):
            raise ValueError(f"monthly must be 'runs' or 'months', not {self.monthly!r}")

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"


@dataclass(frozen=True)
class BatchReport:
    """What a call of ``run_batch`` did; run ids in order, empty when there was nothing new."""

    runs: tuple[str, ...]
    accepted_files: int
    rejected_files: int


def run_batch(spark: SparkSession, conf: BatchConfig, run_ts: dt.datetime) -> BatchReport:
    """Processes every waiting file that no earlier run has finished or rejected.

    Raises ``NoInputFiles`` for an empty landing area, ``NoUsableFiles`` when all new files were
    rejected, ``UnfinishedRun`` as configured. Any failure of a later stage is raised too and
    leaves the run open in the ledger.
    """
    work = fresh_folder(spark, "run")
    with shuffles_removed(spark):
        report = _run(spark, conf, run_ts.astimezone(dt.timezone.utc), work)
    remove_folder(spark, work)
    return report


def _run(spark: SparkSession, conf: BatchConfig, run_ts: dt.datetime, work: str) -> BatchReport:
    run_id = str(int(run_ts.timestamp()) * 1000)

    catalog = file_catalog(spark, conf.landing)
    state = current_state(spark, conf.ledger)
    if not state.filter((F.col("run_id") == run_id) & (F.col("status") == INACTIVE)).isEmpty():
        raise ValueError(f"run {run_id} is finished already")
    waiting = stored(_not_rejected(without_finished(catalog, state), spark, conf),
                     f"{work}/waiting")
    left_over = unfinished_files(waiting, state).select("path")
    earlier = [] if left_over.isEmpty() else _open_runs(left_over, state)
    if earlier and conf.on_unfinished != "resume":
        raise UnfinishedRun(f"unfinished runs: {', '.join(earlier)}")

    if waiting.isEmpty():
        return BatchReport((), 0, 0)
    manifest = stored(build_manifest(waiting, conf.landing, conf.header_method),
                      f"{work}/manifest")
    accepted, rejected = split_manifest(manifest)
    n_accepted, n_rejected = _counts(manifest)
    keep = [lambda: quarantine_files(rejected, conf.quarantine, run_id)] if n_rejected else []
    if not n_accepted:
        together(spark, *keep)
        raise NoUsableFiles(f"all {n_rejected} new files were rejected")

    runs = []
    for old in earlier:
        own = state.filter(F.col("run_id") == old).select(F.col("file_location").alias("path"))
        files = accepted.join(own, "path", "left_semi")
        _process(spark, conf, files, old, run_ts, f"{work}/{old}", keep)
        keep = []
        runs.append(old)
    new = accepted.join(left_over, "path", "left_anti") if earlier else accepted
    if not new.isEmpty():
        ledger_open(new, conf.ledger, run_id, run_ts)
        _process(spark, conf, new, run_id, run_ts, f"{work}/{run_id}", keep)
        runs.append(run_id)
    return BatchReport(tuple(runs), n_accepted, n_rejected)


def run_arrivals(spark: SparkSession, conf: BatchConfig, archive: str, files_a_run: int | None = None
                 ) -> BatchReport:
    """Processes what has landed since the last call, and has finished files moved to ``archive``.

    The stream of ``streaming.intake`` decides which files are new, in place of the ledger and of a
    listing of everything that ever landed; each of its batches is a run, whose id is the batch's number
    (so ``root`` must not be shared with ``run_batch``). A batch without a usable file only fills the
    quarantine. After a failure the next call repeats the batch under the same id.
    """
    counts = {"accepted": 0, "rejected": 0}
    runs = []

    def one(waiting: DataFrame, number: int) -> None:
        run_id, now = str(number), dt.datetime.now(dt.timezone.utc)
        state = current_state(spark, conf.ledger)
        if not state.filter((F.col("run_id") == run_id) & (F.col("status") == INACTIVE)).isEmpty():
            return  # it was finished, and stopped before the stream took note
        work = fresh_folder(spark, "run")
        manifest = stored(build_manifest(waiting, conf.landing, conf.header_method), f"{work}/manifest")
        accepted, rejected = split_manifest(manifest)
        n_accepted, n_rejected = _counts(manifest)
        keep = [lambda: quarantine_files(rejected, conf.quarantine, run_id)] if n_rejected else []
        if n_accepted:
            ledger_open(accepted, conf.ledger, run_id, now)
            _process(spark, conf, accepted, run_id, now, f"{work}/{run_id}", keep)
            runs.append(run_id)
        elif n_rejected:
            together(spark, *keep)
        counts["accepted"] += n_accepted
        counts["rejected"] += n_rejected
        remove_folder(spark, work)

    with shuffles_removed(spark):
        take_in(spark, conf.landing, archive, f"{conf.root}/intake", one, files_a_run)
    return BatchReport(tuple(runs), counts["accepted"], counts["rejected"])


def monthly_of(spark: SparkSession, conf: BatchConfig, name: str) -> DataFrame:
    """A monthly table merged over all runs (``monthly="months"``)."""
    return read_months(spark, f"{conf.root}/months/{name}", MONTHS[name][0])


def _not_rejected(catalog: DataFrame, spark: SparkSession, conf: BatchConfig) -> DataFrame:
    """Without files that were rejected before and have not changed since."""
    known = quarantined_files(spark, conf.quarantine)
    return catalog.join(known, ["path", "modificationTime", "length"], "left_anti")


def _open_runs(left_over: DataFrame, state: DataFrame) -> list[str]:
    runs = state.join(left_over, F.col("file_location") == F.col("path"), "left_semi")
    return [r["run_id"] for r in runs.select("run_id").distinct().orderBy("run_id").collect()]


def _counts(manifest: DataFrame) -> tuple[int, int]:
    row = manifest.agg(
        F.count_if("accepted").alias("yes"), F.count_if(~F.col("accepted")).alias("no")
    ).first()
    return row["yes"], row["no"]


def _process(spark: SparkSession, conf: BatchConfig, files: DataFrame, run_id: str,
             run_ts: dt.datetime, work: str, beside: Sequence[Callable[[], None]] = ()) -> None:
    """One run over its accepted files, from reading to closing the ledger.

    What does not wait for one another runs at the same time, also the jobs ``beside``: the ledger is
    closed only when these have succeeded as well.
    """
    epoch = int(run_id)

    def dimension(name: str) -> DataFrame:
        # Read once per run: all results see the same rows, and a database is asked only once.
        dim = stored(read_dimension(spark, conf.dimensions[name]), f"{work}/{name}")
        assert_unique_key(dim, [DIMENSION_KEYS[name]], name)
        return dim

    def dimensions() -> tuple[dict[str, DataFrame], Collection[str]]:
        dims = dict(zip(DIMENSIONS, together(spark, *[partial(dimension, n) for n in DIMENSIONS]), strict=True))
        return dims, small_tables(dims)

    def process() -> None:
        staged, (dims, small) = together(
            spark, lambda: stage_files(spark, files, f"{work}/sales"), dimensions)
        star = (well_formed(staged), dims[CUSTOMER], dims[STORE], dims[SALES_TEAM], small)
        together(
            spark, lambda: quarantine_rows(with_faults(malformed(staged), files), conf.quarantine, run_id),
            lambda: _publish(spark, conf, star, run_id, epoch))
        if conf.audit_unmatched:
            write_mart(unmatched_sales(*star), f"{conf.root}/unmatched_sales/{epoch}")

    together(spark, process, *beside)
    ledger_close(files, conf.ledger, run_id, max(run_ts, dt.datetime.now(dt.timezone.utc)))
    keep_small(spark, conf.ledger)


def _publish(spark: SparkSession, conf: BatchConfig, star: Star, run_id: str, epoch: int) -> None:
    """The marts, and what is summed from each as soon as it is there."""
    _, customer, store, sales_team, small = star

    def monthly(name: str, mart: DataFrame, of_mart: Finish, finish: Finish) -> None:
        month, keys = MONTHS[name]
        root = f"{conf.root}/months/{name}"

        def own(result: DataFrame) -> None:
            published = publish_snapshot(result, conf.root, name, epoch)
            if name in conf.monthly_tables:
                rows, target = spark.read.parquet(published), conf.monthly_tables[name]
                if conf.run_column:
                    append_run(rows, target, run_id, MONTHLY_KEYS[name])
                else:
                    append_table(rows, target)

        if conf.monthly == "months":
            # Sales are summed once: the run's own table starts from what it has noted.
            touched = note_run(mart, keys, f"{root}/state", run_id)
            together(spark, lambda: own(finish(totals_of_run(spark, f"{root}/state", keys, run_id))),
                     lambda: rewrite_months(spark, keys, root, touched, finish, month))
        else:
            own(of_mart(mart))

    # The marts hold the sales whose keys are known: sums start from them, with no join of sales.
    def of_customers() -> None:
        path = publish_snapshot(marts.customer_mart(*star), conf.root, CUSTOMER_MART, epoch)
        monthly(CUSTOMER_MONTHLY, spark.read.parquet(path),
                lambda mart: marts.customer_monthly_of_mart(mart, customer, small),
                lambda totals: marts.with_customer(totals, customer, small))

    def of_team() -> None:
        path = publish_snapshot(marts.sales_team_mart(*star), conf.root, SALES_TEAM_MART, epoch)
        mart = spark.read.parquet(path)
        if conf.by_month_and_store:
            # Sellers and stores that fit in every task need not be shuffled with each of their sales.
            narrow = (marts.TEAM_SALE, lambda rows: marts.with_team(rows, store, sales_team, small)) if (
                {STORE, SALES_TEAM} <= set(small)) else None
            laid_out = publish_snapshot(mart, conf.root, SALES_TEAM_MART_PARTITIONED, epoch, partitioned=True, narrow=narrow)
            # A seller's sales of a month lie together there: a task's sums of them are few.
            mart = read_partitioned_mart(spark, laid_out)
        monthly(SELLER_MONTHLY, mart,
                lambda mart: marts.seller_monthly_of_mart(mart, sales_team, small),
                lambda totals: marts.seller_months(totals, sales_team, small))

    together(spark, of_customers, of_team)
