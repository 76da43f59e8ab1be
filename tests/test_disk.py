"""What a run writes on the way does not stay on disk until it ends."""

import datetime as dt
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from tillmark.operators.enrich import CUSTOMER, DIMENSIONS, STORE
from tillmark.plans import batch, marts
from tillmark.plans.batch import (
    SALES_TEAM_MART,
    SALES_TEAM_MART_PARTITIONED,
    SELLER_MONTHLY,
    BatchConfig,
    run_arrivals,
    run_batch,
)
from tillmark.registry import landing, supplied
from tillmark.sinks import parquet
from tillmark.sources.dimensions import FileTable
from tillmark.storage import FILES_GO, child_folders, path_exists, shared_folder, shuffles_removed

SF = "/root/testdata/sf0.001"
HEADER = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {p.name for d in folders for p in Path(d).rglob("shuffle_*.data")}


def left_behind(spark, before):
    """New shuffle files; they are removed beside what runs, so some seconds are allowed."""
    for _ in range(40):
        if not (new := shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    return new


@pytest.fixture
def conf(world, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(
        f"{HEADER}\n1,10,tea,2024-01-05,100,2.50,2,60.00\n2,10,tea,2024-01-06,101,2.50,x,9.00\n")
    (tmp_path / "in" / "bad.csv").write_text("nothing\n")
    for name in ("customer", "store", "sales_team"):
        getattr(world, name).write.parquet(str(tmp_path / name))
    return BatchConfig(landing=f"{tmp_path}/in", root=f"{tmp_path}/out",
                       dimensions={n: FileTable(f"{tmp_path}/{n}") for n in ("customer", "store", "sales_team")})


NIGHT = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)


@pytest.mark.parametrize("call", [
    lambda spark, conf: run_batch(spark, conf, NIGHT),
    lambda spark, conf: run_arrivals(spark, conf, f"{conf.root}-archive")])
def test_a_run_leaves_no_shuffle_files(spark, conf, call):
    before, setting = shuffle_files(spark), spark.conf.get(FILES_GO)
    assert call(spark, conf).accepted_files == 1
    assert not left_behind(spark, before)
    assert spark.conf.get(FILES_GO) == setting


def test_the_setting_holds_until_the_last_of_nested_uses_ends(spark):
    setting = spark.conf.get(FILES_GO)
    with shuffles_removed(spark):
        with pytest.raises(ValueError, match="broken"), shuffles_removed(spark):
            raise ValueError("broken")
        assert spark.conf.get(FILES_GO) == "true"
        frame = spark.range(1000).repartition(3, "id").groupBy("id").count()
        assert sorted(frame.collect()) == sorted(frame.collect())
    assert spark.conf.get(FILES_GO) == setting


def test_landing_leaves_neither_shuffle_files_nor_the_stored_sales(spark):
    sales = {n for n in child_folders(spark, shared_folder(spark)) if n.startswith("sales-")}
    before = shuffle_files(spark)
    assert path_exists(spark, f"{landing.land(spark, SF)}/plain")
    assert not left_behind(spark, before)
    assert {n for n in child_folders(spark, shared_folder(spark)) if n.startswith("sales-")} == sales


def codecs(folder):
    names = [p for p in Path(folder.removeprefix("file:")).rglob("*.parquet")]
    return {pq.ParquetFile(p).metadata.row_group(0).column(0).compression for p in names if pq.ParquetFile(p).num_row_groups}


def test_quarantined_bytes_and_staged_sales_take_less_room(spark, conf, monkeypatch):
    staged, stage = [], batch.stage_files
    monkeypatch.setattr(batch, "stage_files", lambda *a: (stage(*a), staged.append(codecs(a[2])))[0])
    run_batch(spark, conf, NIGHT)
    assert codecs(f"{conf.quarantine}/contents") == codecs(f"{conf.quarantine}/rows") == {"ZSTD"} and staged == [{"ZSTD"}]
    assert codecs(f"{conf.root}/{SALES_TEAM_MART}") == {spark.conf.get("spark.sql.parquet.compression.codec").upper()}


def test_stores_are_found_after_sales_are_shuffled(spark):
    """Dates are cut from times before the joins, and the seller's store is added after them."""
    plan = supplied.sales(spark, SF, frozenset(DIMENSIONS), products=True)._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    assert text.index("s_suppkey") < text.index("p_partkey") and "cast(o_orderdate" in text[text.index("o_orderkey"):]


@pytest.mark.parametrize("small, narrow", [(DIMENSIONS, True), ((CUSTOMER, STORE), False), ((), False)])
def test_names_of_a_small_team_are_not_shuffled_to_month_and_store(spark, conf, rows_of, monkeypatch, small, narrow):
    shuffled, summed = [], []
    together, sums = parquet.brought_together, marts.seller_monthly_of_mart
    monkeypatch.setattr(batch, "small_tables", lambda _: frozenset(small))
    monkeypatch.setattr(parquet, "brought_together", lambda *a: shuffled.append(together(*a)) or shuffled[-1])
    monkeypatch.setattr(marts, "seller_monthly_of_mart", lambda mart, *a: summed.extend(mart.inputFiles()) or sums(mart, *a))
    run_batch(spark, conf, NIGHT)
    mart = parquet.latest_snapshot(spark, conf.root, SALES_TEAM_MART)
    laid_out = parquet.latest_snapshot(spark, conf.root, SALES_TEAM_MART_PARTITIONED, partitioned=True)
    assert rows_of(laid_out, *mart.columns) == rows_of(mart) and mart.count() == 1
    assert dict(laid_out.dtypes) == dict(mart.dtypes)
    assert [sorted(f.columns) for f in shuffled] == [sorted(marts.TEAM_SALE if narrow else mart.columns)]
    assert summed and all(SALES_TEAM_MART_PARTITIONED in name for name in summed)
    assert parquet.latest_snapshot(spark, conf.root, SELLER_MONTHLY).count() == 1
