"""Landing files are written, and files given to a reader are listed, by far fewer tasks than files."""

import pytest
from pyspark.sql import functions as F

from tillmark.registry import landing
from tillmark.schema import MANDATORY
from tillmark.sources.any_header import raw_lines
from tillmark.sources.catalog import file_catalog
from tillmark.sources.sales_csv import read_layout
from tillmark.storage import child_files, few_listers, fresh_folder
from tillmark.streaming.intake import take_in


def written(spark, df, files, rows=None):
    shop = object.__new__(landing.Shop)
    shop.landing = fresh_folder(spark, "landing")
    shop._write(df, "plain", files, rows)
    names = [n for n in child_files(spark, f"{shop.landing}/plain") if n.startswith("part")]
    back = spark.read.option("header", True).schema("id long").csv(f"{shop.landing}/plain")
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    return names, sizes, sorted(r["id"] for r in back.collect())


@pytest.mark.parametrize("rows, files, scan_tasks", [
    (64_000, 64, 8), (64_001, 65, 7), (99_999, 17, 32), (100_000, 33, 1), (5_003, 16, 3)])
def test_a_task_writes_many_landing_files_of_much_the_same_size(spark, rows, files, scan_tasks):
    names, sizes, ids = written(spark, spark.range(0, rows, 1, scan_tasks), files, rows)
    assert len(names) == len(sizes) == files and ids == list(range(rows))
    assert max(sizes) <= 1.3 * rows / files
    assert len({n.split("-")[1] for n in names}) == -(-files // landing.FILES_A_WRITER)


def test_uneven_scan_tasks_change_no_number_of_files(spark):
    uneven = spark.range(0, 30_000, 1, 1).union(spark.range(30_000, 30_007, 1, 5)).union(spark.range(30_007, 48_111, 1, 3))
    names, sizes, ids = written(spark, uneven, 48)
    assert len(names) == len(sizes) == 48 and ids == list(range(48_111))


def test_a_file_a_task_where_shares_could_not_be_kept(spark):
    names, _, ids = written(spark, spark.range(0, 400, 1, 40), 20)
    assert len({n.split("-")[1] for n in names}) == len(names) == 20 and ids == list(range(400))


def most_tasks(spark, group, read):
    spark.sparkContext.setJobGroup(group, group)
    try:
        read()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return max((tracker.getStageInfo(s).numTasks for s in stages), default=0)


@pytest.mark.parametrize("read", [
    lambda spark, paths: read_layout(spark, MANDATORY, paths), raw_lines])
def test_many_files_are_listed_by_few_tasks(spark, tmp_path, read):
    for i in range(130):
        (tmp_path / f"f{i}.csv").write_text(",".join(MANDATORY) + "\n")
    paths = [str(tmp_path / f"f{i}.csv") for i in range(130)]
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    assert 0 < most_tasks(spark, f"{tmp_path}", lambda: read(spark, paths)) <= 3
    assert spark.conf.get(setting) == before


def test_a_stream_lists_arriving_files_by_no_more_tasks_than_cores(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(40):
        (tmp_path / "in" / f"f{i}.csv").write_text("x\n")
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, seen, tasks = spark.conf.get(setting), [], []

    def handle(files, number):
        seen.extend(r["file_name"] for r in files.select("file_name").collect())
        # The stream's jobs so far have its run as their group, as this one's thread has.
        tracker, group = spark.sparkContext.statusTracker(), spark.sparkContext.getLocalProperty("spark.jobGroup.id")
        tasks.extend(tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup(group)
                     for s in tracker.getJobInfo(j).stageIds)

    take_in(spark, f"{tmp_path}/in", f"{tmp_path}/archive", f"{tmp_path}/checkpoint", handle)
    assert 0 < max(tasks) <= spark.sparkContext.defaultParallelism and spark.conf.get(setting) == before
    assert sorted(seen) == sorted(f"f{i}.csv" for i in range(40))


def test_files_are_listed_by_one_scan_beside_empty_ones(spark, tmp_path):
    for name, text in {"a.csv": "x\n", "odd name+%41.csv": "yy\n", "empty.csv": "", "_hidden.csv": "z\n"}.items():
        (tmp_path / name).write_text(text)
    catalog = file_catalog(spark, str(tmp_path))
    assert catalog._jdf.queryExecution().optimizedPlan().toString().count("binaryFile") == 1
    found = {r["file_name"]: r for r in catalog.collect()}
    assert len(found) == catalog.count() == 4
    assert {n: (r["length"], r["hidden"], r["modificationTime"].year > 1970) for n, r in found.items()} == {
        "a.csv": (2, False, True), "odd name+%41.csv": (3, False, True), "empty.csv": (0, False, False),
        "_hidden.csv": (2, True, True)}


def test_the_setting_comes_back_after_an_error(spark):
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    with pytest.raises(ValueError, match="broken"), few_listers(spark, 10):
        raise ValueError("broken")
    assert spark.conf.get(setting) == before
