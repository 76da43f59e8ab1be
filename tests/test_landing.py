"""Most landing files are written by the tasks that scan the sales."""

import pytest
from pyspark.sql import functions as F

from tillmark.registry import landing
from tillmark.storage import child_files, stored

SF = "/root/testdata/sf0.01"


def landed(spark, shape, path):
    columns = [c for c in landing.MANDATORY if c != "store_id"]
    names = [n for n in child_files(spark, f"{path}/{shape}") if n.startswith("part")]
    back = spark.read.option("header", True).csv(f"{path}/{shape}")
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    return len(names), sizes, sorted(tuple(r) for r in back.select(*columns).collect())


@pytest.mark.parametrize("rows_a_file, parts, dealt", [(100, 20, 0.2), (100, 8, 0.3), (333, 8, 0.3), (10_000, 8, 1), (100, 1, 1)])
def test_few_sales_are_dealt_out_to_files_of_the_right_number(spark, monkeypatch, rows_a_file, parts, dealt):
    """Also where all are, as files are fewer than the tasks' last ones or sales lie in one file."""
    seen, write = [], landing.Shop._write
    monkeypatch.setattr(landing, "ROWS_A_FILE", rows_a_file)
    monkeypatch.setattr(landing, "stored", lambda df, path, **options: stored(df.repartition(parts), path, **options))
    monkeypatch.setattr(landing.Shop, "_write", lambda self, df, *a: (seen.append(df.count()), write(self, df, *a)))
    shop = landing.Shop(spark, SF)
    rows, flags = shop.rows.count(), {r[0]: r[1] for r in shop.rows.groupBy("l_returnflag").count().collect()}
    shop.add_all([landing.NO_STORE, landing.PLAIN, landing.EXTRA])
    for shape, count in ((landing.NO_STORE, rows), *[(s, flags[landing.RETURN_FLAG[s]]) for s in (landing.PLAIN, landing.EXTRA)]):
        files, sizes, back = landed(spark, shape, shop.landing)
        assert files == len(sizes) == count // rows_a_file + 1 and sum(sizes) == count
        assert max(sizes) <= 1.3 * rows_a_file
    assert sum(seen) <= dealt * (rows + flags["A"] + flags["N"])


def test_all_sales_land_as_they_are(spark, monkeypatch):
    monkeypatch.setattr(landing, "ROWS_A_FILE", 100)
    monkeypatch.setattr(landing, "stored", lambda df, path, **options: stored(df.repartition(8), path, **options))
    shop = landing.Shop(spark, SF)
    shop.add(landing.NO_STORE)
    columns = [c for c in landing.MANDATORY if c != "store_id"]
    wanted = shop.rows.select(*[F.col(c).cast("string") for c in columns])
    assert landed(spark, landing.NO_STORE, shop.landing)[2] == sorted(tuple(r) for r in wanted.collect())


def test_all_are_dealt_out_where_tasks_made_too_many_files(spark, monkeypatch):
    monkeypatch.setattr(landing, "ROWS_A_FILE", 100)
    monkeypatch.setattr(landing, "stored", lambda df, path, **options: stored(df.repartition(8), path, **options))
    monkeypatch.setattr(landing, "count_files", lambda *_: 10_000)
    shop = landing.Shop(spark, SF)
    shop.add(landing.NO_STORE)
    files, sizes, _ = landed(spark, landing.NO_STORE, shop.landing)
    assert files == len(sizes) == shop.rows.count() // 100 + 1 and sum(sizes) == shop.rows.count()
