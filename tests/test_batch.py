"""The nightly run over small landing areas."""

import datetime as dt
import threading
from decimal import Decimal as D

import pytest

from tillmark.plans import batch, marts
from tillmark.plans.batch import (
    CUSTOMER_MART,
    CUSTOMER_MONTHLY,
    SALES_TEAM_MART,
    SALES_TEAM_MART_PARTITIONED,
    SELLER_MONTHLY,
    BatchConfig,
    NoUsableFiles,
    UnfinishedRun,
    run_batch,
)
from tillmark.plans.ledger import ledger_events, ledger_state
from tillmark.sinks.parquet import latest_snapshot
from tillmark.sinks.quarantine import quarantined_files, quarantined_rows
from tillmark.sources.catalog import NoInputFiles
from tillmark.sources.dimensions import DuplicateKey, FileTable
from tillmark.storage import fresh_folder, path_exists

HEADER = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"
T1 = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
T2 = T1 + dt.timedelta(days=1)
T3 = T1 + dt.timedelta(days=2)


@pytest.fixture
def shop(spark, world, tmp_path):
    """A landing area with files of all kinds, and dimensions as Parquet."""
    for name in ("customer", "store", "sales_team"):
        getattr(world, name).write.parquet(str(tmp_path / name))
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "a.csv").write_text(
        f"{HEADER}\n1,10,tea,2024-01-05,100,2.50,2,60.00\n1,10,tea,2024-01-06,100,2.50,x,9.00\n"
        "77,10,tea,2024-01-06,100,2.50,2,1.00\n")
    (landing / "b.csv").write_text(
        f"payment_mode,{HEADER}\ncash,2,10,tea,2024-01-07,101,2.50,2,60.00\n"
        "UPI,1,20,tea,2024-02-07,102,2.50,2,40.00\n")
    (landing / "bad.csv").write_text(HEADER.replace("store_id,", "") + "\n1,tea\n")
    (landing / "notes.txt").write_text("hello\n")

    def conf(**changes):
        return BatchConfig(**{
            "landing": str(landing), "root": str(tmp_path / "out"),
            "dimensions": {n: FileTable(str(tmp_path / n))
                           for n in ("customer", "store", "sales_team")},
            "monthly_tables": {n: FileTable(str(tmp_path / f"table_{n}"))
                               for n in (CUSTOMER_MONTHLY, SELLER_MONTHLY)},
            **changes})
    conf.landing = landing
    conf.table = lambda n: spark.read.parquet(str(tmp_path / f"table_{n}"))
    return conf


def statuses(spark, conf):
    state = ledger_state(ledger_events(spark, conf.ledger))
    return {r["file_name"]: r["status"] for r in state.collect()}


def test_whole_run(spark, shop, rows_of):
    conf = shop(audit_unmatched=True)
    report = run_batch(spark, conf, T1)
    assert (report.accepted_files, report.rejected_files, len(report.runs)) == (2, 2, 1)

    customers = latest_snapshot(spark, conf.root, CUSTOMER_MART)
    assert rows_of(customers, "customer_id", "first_name", "total_cost") == [
        (1, "Ann", D("40.00")), (1, "Ann", D("60.00")), (2, "Bob", D("60.00"))]
    team = latest_snapshot(spark, conf.root, SALES_TEAM_MART)
    split = latest_snapshot(spark, conf.root, SALES_TEAM_MART_PARTITIONED, partitioned=True)
    assert rows_of(team) == rows_of(split.select(*team.columns))
    assert rows_of(shop.table(SELLER_MONTHLY), "store_id", "sales_person_id", "sales_month",
                   "total_sales", "incentive") == [
        (10, 100, "2024-01", D("60.00"), D("0.60")), (10, 101, "2024-01", D("60.00"), D("0.60")),
        (20, 102, "2024-02", D("40.00"), D("0.40"))]
    assert rows_of(shop.table(CUSTOMER_MONTHLY), "full_name", "sales_date_month", "total_sales") == [
        ("Ann Lee", "2024-01", D("60.00")), ("Ann Lee", "2024-02", D("40.00")),
        ("Bob Ray", "2024-01", D("60.00"))]

    assert statuses(spark, conf) == {"a.csv": "I", "b.csv": "I"}
    assert rows_of(quarantined_files(spark, conf.quarantine), "file_name", "reason") == [
        ("bad.csv", "missing columns: store_id"), ("notes.txt", "not a .csv file")]
    assert rows_of(quarantined_rows(spark, conf.quarantine), "file_name", "line") == [
        ("a.csv", "1,10,tea,2024-01-06,100,2.50,x,9.00")]
    missed = spark.read.parquet(f"{conf.root}/unmatched_sales/{report.runs[0]}")
    assert rows_of(missed, "customer_id", "unmatched") == [(77, "customer")]


def test_a_second_run_adds_only_what_is_new(spark, shop, rows_of):
    conf = shop()
    run_batch(spark, conf, T1)
    before = rows_of(shop.table(SELLER_MONTHLY))
    again = run_batch(spark, conf, T2)
    assert again.runs == () and rows_of(shop.table(SELLER_MONTHLY)) == before
    with pytest.raises(ValueError, match="finished already"):
        run_batch(spark, conf, T1)

    (shop.landing / "c.csv").write_text(f"{HEADER}\n1,10,tea,2024-01-09,100,1,1,5.00\n")
    fixed = HEADER + "\n1,10,tea,2024-01-09,100,1,1,7.00\n"
    (shop.landing / "bad.csv").write_text(fixed)  # a rejected file is delivered again, corrected
    third = run_batch(spark, conf, T3)
    assert (third.accepted_files, third.rejected_files) == (2, 0)
    assert rows_of(shop.table(SELLER_MONTHLY).filter(f"run_id = '{third.runs[0]}'"),
                   "sales_person_id", "total_sales", "incentive") == [
        (100, D("12.00"), D("0.12"))]
    assert shop.table(SELLER_MONTHLY).count() == 4
    assert statuses(spark, conf) == dict.fromkeys(("a.csv", "b.csv", "c.csv", "bad.csv"), "I")


def test_a_failed_run_stays_open_and_can_be_resumed(spark, shop, rows_of, monkeypatch):
    conf = shop()
    with monkeypatch.context() as m:
        m.setattr(marts, "seller_monthly_of_mart", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_batch(spark, conf, T1)
    assert statuses(spark, conf) == {"a.csv": "A", "b.csv": "A"}

    (shop.landing / "c.csv").write_text(f"{HEADER}\n1,10,tea,2024-01-09,100,1,1,5.00\n")
    with pytest.raises(UnfinishedRun):
        run_batch(spark, conf, T2)
    first = str(int(T1.timestamp()) * 1000)
    with monkeypatch.context() as m:
        # The last step of the resumed run fails as well: everything before it is repeated.
        m.setattr(batch, "ledger_close", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_batch(spark, shop(on_unfinished="resume"), T2)
    report = run_batch(spark, shop(on_unfinished="resume"), T2)
    assert report.runs == (first, str(int(T2.timestamp()) * 1000))
    assert rows_of(shop.table(SELLER_MONTHLY), "run_id", "sales_person_id", "total_sales") == [
        (report.runs[0], 100, D("60.00")), (report.runs[0], 101, D("60.00")),
        (report.runs[0], 102, D("40.00")), (report.runs[1], 100, D("5.00"))]
    assert set(statuses(spark, conf).values()) == {"I"}


def test_tables_without_a_run_column(spark, shop):
    run_batch(spark, shop(run_column=False), T1)
    assert shop.table(SELLER_MONTHLY).columns == [
        "store_id", "sales_person_id", "full_name", "sales_month", "total_sales", "incentive"]
    assert shop.table(CUSTOMER_MONTHLY).count() == 3


def test_staging_is_removed_after_success_only(spark, shop, monkeypatch):
    made = []

    def fresh(s, purpose):
        made.append(fresh_folder(s, purpose))
        return made[-1]

    monkeypatch.setattr(batch, "fresh_folder", fresh)
    with monkeypatch.context() as m:
        m.setattr(batch, "ledger_close", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_batch(spark, shop(), T1)
    run_batch(spark, shop(on_unfinished="resume"), T2)
    assert [path_exists(spark, p) for p in made] == [True, False]


def test_nothing_usable(spark, shop, tmp_path):
    only_bad = tmp_path / "only_bad"
    only_bad.mkdir()
    conf = shop(landing=str(only_bad), root=str(tmp_path / "out2"))
    with pytest.raises(NoInputFiles):
        run_batch(spark, conf, T1)
    (only_bad / "notes.txt").write_text("hello\n")
    with pytest.raises(NoUsableFiles):
        run_batch(spark, conf, T1)
    assert quarantined_files(spark, conf.quarantine).count() == 1


def test_doubled_dimension_rows_stop_the_run(spark, world, shop, tmp_path):
    world.store.write.mode("append").parquet(str(tmp_path / "store"))
    conf = shop()
    with pytest.raises(DuplicateKey):
        run_batch(spark, conf, T1)
    assert set(statuses(spark, conf).values()) == {"A"}


def test_files_are_quarantined_beside_the_run_which_stays_open_if_that_fails(spark, shop, monkeypatch):
    conf, meet = shop(), threading.Barrier(2, timeout=60)
    stage = batch.stage_files

    def staged(*args):
        meet.wait()
        return stage(*args)

    def fails(*_):
        meet.wait()
        raise OSError("no room")

    with monkeypatch.context() as m:
        m.setattr(batch, "stage_files", staged)
        m.setattr(batch, "quarantine_files", fails)
        with pytest.raises(OSError, match="no room"):
            run_batch(spark, conf, T1)
    assert statuses(spark, conf) == {"a.csv": "A", "b.csv": "A"}
    assert quarantined_files(spark, conf.quarantine).count() == 0
    run_batch(spark, shop(on_unfinished="resume"), T2)
    assert set(statuses(spark, conf).values()) == {"I"}
    assert quarantined_files(spark, conf.quarantine).count() == 2
