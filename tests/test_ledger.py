"""Ledger events and the states that follow from them."""

import datetime as dt

from tillmark.plans.ledger import (
    active_file_names,
    ledger_close,
    ledger_events,
    ledger_open,
    ledger_state,
    unfinished_files,
    without_finished,
)

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
T1 = T0 + dt.timedelta(hours=1)


def files(spark, *paths):
    return spark.createDataFrame([(p.rsplit("/", 1)[-1], p) for p in paths],
                                 "file_name string, path string")


def test_ledger(spark, tmp_path, rows_of):
    ledger = str(tmp_path / "ledger")
    assert ledger_state(ledger_events(spark, ledger)).isEmpty()
    ledger_open(files(spark, "in/a.csv", "x/a.csv", "in/b.csv"), ledger, "1", T0)
    ledger_close(files(spark, "in/a.csv"), ledger, "1", T0)  # same instant: closing still wins
    ledger_open(files(spark, "in/c.csv"), ledger, "2", T1)
    state = ledger_state(ledger_events(spark, ledger))
    assert rows_of(state, "file_location", "file_name", "status", "run_id") == [
        ("in/a.csv", "a.csv", "I", "1"), ("in/b.csv", "b.csv", "A", "1"),
        ("in/c.csv", "c.csv", "A", "2"), ("x/a.csv", "a.csv", "A", "1")]
    closed = state.filter("status = 'I'").first()
    assert closed["created_date"] == closed["updated_date"] == T0.replace(tzinfo=None)
    assert state.filter("updated_date is null").count() == 3
    assert state.select("id").distinct().count() == 4

    assert rows_of(active_file_names(state)) == [("a.csv",), ("b.csv",), ("c.csv",)]
    assert rows_of(active_file_names(state, ["b.csv", "z.csv"])) == [("b.csv",)]
    waiting = files(spark, "in/a.csv", "x/a.csv", "in/new.csv")
    assert rows_of(unfinished_files(waiting, state), "path") == [("x/a.csv",)]
    assert rows_of(without_finished(waiting, state), "path") == [("in/new.csv",), ("x/a.csv",)]
