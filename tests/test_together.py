"""Independent jobs run side by side; landing files are written without a sort."""

import threading

import pytest
from pyspark.sql import functions as F

from tillmark.registry import landing
from tillmark.storage import child_files, child_folders, fresh_folder, together


def test_jobs_run_at_the_same_time_and_errors_are_raised_at_the_end(spark):
    meet, ended = threading.Barrier(2, timeout=30), []

    def one(name):
        meet.wait()
        ended.append(name)
        return name

    assert together(spark, lambda: one("a"), lambda: one("b")) == ["a", "b"]

    def fails():
        raise ValueError("broken")

    with pytest.raises(ValueError, match="broken"):
        together(spark, fails, lambda: ended.append("c"))
    assert sorted(ended) == ["a", "b", "c"]


@pytest.mark.parametrize("rows, files", [(40_960, 64), (20_001, 3), (70, 1), (0, 1)])
def test_as_many_landing_files_as_asked_for(spark, rows, files):
    shop = object.__new__(landing.Shop)
    shop.landing = fresh_folder(spark, "landing")
    df = spark.range(0, rows, 1, 8).select("id", F.lit("x").alias("text"))
    shop._write(df, "plain", files)
    names = [n for n in child_files(spark, f"{shop.landing}/plain") if n.startswith("part")]
    back = spark.read.option("header", True).schema("id long, text string").csv(f"{shop.landing}/plain")
    assert len(names) == files and sorted(r["id"] for r in back.collect()) == list(range(rows))
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert not sizes or max(sizes) <= 2 * rows / files


def test_files_made_ready_land_when_told(spark):
    shop = object.__new__(landing.Shop)
    shop.spark, shop.sf_dir, shop.landing = spark, "/root/testdata/sf0.001", fresh_folder(spark, "landing")
    land_them = shop.make_ready([landing.NOTES])
    assert child_folders(spark, shop.landing) == []
    land_them()
    assert child_folders(spark, shop.landing) == [landing.NOTES]
    names = child_files(spark, f"{shop.landing}/{landing.NOTES}")
    assert sum(n.startswith("part") for n in names) == landing.NOTES_FILES
    with pytest.raises(FileExistsError):
        shop.make_ready([landing.NOTES])()
