"""Appended runs that show once or not at all, and a ledger that stays small."""

import datetime as dt

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from tillmark.plans import ledger
from tillmark.sinks.committed import FORMAT, CommittedWriter, append_committed, committed_runs, read_committed

SCHEMA = "id long, price decimal(18,2), day date, name string"


def rows_of_run(spark, n):
    return spark.range(n).selectExpr("id", "cast(id / 4 as decimal(18,2)) price", "date'2024-01-05' day",
                                     "if(id % 3 = 0, null, concat('n', id)) name").repartition(4)


def test_runs_show_once(spark, tmp_path, rows_of):
    path = str(tmp_path / "t")
    assert read_committed(spark, path, SCHEMA).count() == 0
    for run, n in (("1", 50), ("1", 50), ("2", 7), ("3", 0)):
        append_committed(rows_of_run(spark, n), path, run)
    got = read_committed(spark, path, SCHEMA)
    assert rows_of(got.groupBy("run_id").count()) == [("1", 50), ("2", 7)]
    assert rows_of(got.where("run_id = 1").drop("run_id")) == rows_of(rows_of_run(spark, 50))
    assert rows_of(committed_runs(spark, path), "run_id", "rows") == [("1", 50), ("2", 7), ("3", 0)]


def test_a_run_of_which_a_task_fails_after_its_write_never_shows(spark, tmp_path):
    path = str(tmp_path / "t")

    @F.udf("long")
    def fails_at_the_end(i):  # rows before it are written by then
        if TaskContext.get().partitionId() == 1 and i == 1999:
            raise RuntimeError("lost")
        return i

    bad = spark.range(0, 4000, 1, 2).repartitionByRange(2, "id").select(
        F.when(F.col("id") > 0, fails_at_the_end(F.col("id") % 2000)).alias("id"))
    with pytest.raises(Exception, match="lost"):
        append_committed(bad, path, "1")
    assert read_committed(spark, path, "id long").count() == 0
    append_committed(spark.range(5), path, "1")
    assert read_committed(spark, path, "id long").count() == 5


def test_two_attempts_of_a_task_show_once(tmp_path, spark):
    """A task whose first attempt was lost after it had written: only the second is told of."""
    import pyarrow as pa

    path = str(tmp_path / "t")
    writer = CommittedWriter(path, "1")
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1, 2], pa.int64()), "run_id": ["1", "1"]})
    lost, told, empty = writer.write(iter([batch])), writer.write(iter([batch])), writer.write(iter([]))
    assert lost.file != told.file and empty.file is None
    writer.commit([told, empty, None])
    assert read_committed(spark, path, "id long").count() == 2
    again = writer.write(iter([batch]))
    writer.commit([again])  # the driver was lost after listing: the list stays as it is
    assert read_committed(spark, path, "id long").count() == 2


@pytest.mark.parametrize("run", ["", "a/b", "_x", ".x"])
def test_not_a_run_id(spark, tmp_path, run):
    with pytest.raises(Exception, match="not a run id"):
        append_committed(spark.range(1), str(tmp_path / "t"), run)


def test_overwriting_is_refused(spark, tmp_path):
    append_committed(spark.range(1), str(tmp_path / "t"), "1")
    with pytest.raises(Exception, match="only appended"):
        spark.range(1).write.format(FORMAT).option("path", str(tmp_path / "t")).option("run_id", "9").mode("overwrite").save()


T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def taken(spark, *paths):
    return spark.createDataFrame([(p, f"in/{p}") for p in paths], "file_name string, path string").coalesce(1)


def test_snapshots_give_the_same_states_from_few_files(spark, tmp_path, rows_of):
    plain, small = str(tmp_path / "plain"), str(tmp_path / "small")
    for run in range(12):
        at = T0 + dt.timedelta(hours=run)
        for path in (plain, small):
            ledger.ledger_open(taken(spark, f"{run}.csv", "again.csv"), path, str(run), at)
            if run % 4 != 3:
                ledger.ledger_close(taken(spark, f"{run}.csv", "again.csv"), path, str(run), at + dt.timedelta(minutes=1))
        ledger.keep_small(spark, small, 5)
    want = ledger.ledger_state(ledger.ledger_events(spark, plain))
    got = ledger.current_state(spark, small)
    assert got.columns == want.columns and rows_of(got) == rows_of(want) and got.count() == 13
    assert len(ledger._batches(spark, small)) < 15 < len(ledger._batches(spark, plain))
    read = got.inputFiles()
    assert any("_states/" in f for f in read) and sum("/batch=" in f for f in read) < 5
    assert len(ledger._newest_snapshots(spark, small)) == 2


def test_an_unfinished_snapshot_counts_as_not_there(spark, tmp_path, rows_of):
    path = str(tmp_path / "ledger")
    assert ledger.compact_ledger(spark, path) is None and ledger.current_state(spark, path).isEmpty()
    ledger.ledger_open(taken(spark, "a.csv"), path, "1", T0)
    first = ledger.compact_ledger(spark, path)
    assert first is not None and ledger.compact_ledger(spark, path) is None
    ledger.ledger_close(taken(spark, "a.csv"), path, "1", T0 + dt.timedelta(hours=1))
    last = ledger.compact_ledger(spark, path)
    (tmp_path / "ledger_states" / str(last) / "_SUCCESS").unlink()
    assert ledger._newest_snapshots(spark, path) == [first]
    assert rows_of(ledger.current_state(spark, path), "file_name", "status") == [("a.csv", "I")]
