"""The run ledger: which files were taken up, and which were finished.

Only events are appended, each write in a folder of its own under its number; nothing is updated. A
file's state is that of its latest event. Now and then all events so far are folded into a snapshot of
the states (``compact_ledger``); a reader takes the newest whole snapshot and the events after it, so
that the ledger stays as small as the states, however many runs there were.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.schema import ACTIVE, INACTIVE
from tillmark.storage import child_folders, literal_path, path_exists, remove_folder

EVENT_SCHEMA = (
    "run_id string, file_name string, file_location string, status string, "
    "event_time timestamp, event_seq bigint"
)


def ledger_events(spark: SparkSession, ledger: str) -> DataFrame:
    """The events that are kept: all of them, or those after the last snapshot but one."""
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], EVENT_SCHEMA)
    return spark.read.schema(EVENT_SCHEMA).parquet(ledger).drop("batch", "run")


def _note(events: DataFrame, ledger: str, run_id: str, status: str, at: dt.datetime) -> None:
    # Overwritten if the same step is repeated at the same time.
    events.write.mode("overwrite").parquet(f"{ledger}/batch={_sequence(status, at)}/run={run_id}")


def _sequence(status: str, at: dt.datetime) -> int:
    return int(at.timestamp() * 1_000_000) * 2 + (status == INACTIVE)


def make_events(files: DataFrame, run_id: str, status: str, at: dt.datetime) -> DataFrame:
    """One event per file (``file_name``, ``path``). Later events have a larger ``event_seq``."""
    seq = _sequence(status, at)
    return files.select(
        F.lit(run_id).alias("run_id"), "file_name", F.col("path").alias("file_location"),
        F.lit(status).alias("status"), F.lit(at).alias("event_time"),
        F.lit(seq).cast("bigint").alias("event_seq"),
    )


def ledger_open(files: DataFrame, ledger: str, run_id: str, at: dt.datetime) -> None:
    """Notes that a run has taken up these files; done before anything is processed."""
    _note(make_events(files, run_id, ACTIVE, at), ledger, run_id, ACTIVE, at)


def ledger_close(files: DataFrame, ledger: str, run_id: str, at: dt.datetime) -> None:
    """Notes that these files are finished; done after every sink has succeeded."""
    _note(make_events(files, run_id, INACTIVE, at), ledger, run_id, INACTIVE, at)


def ledger_state(events: DataFrame) -> DataFrame:
    """One row per file: when it was taken up and finished, and its status now.

    Files are told apart by location; a name may occur in several folders.
    """
    return _with_id(_folded(_facts(events)))


def _facts(events: DataFrame) -> DataFrame:
    """Events as states of one event each, which ``_folded`` puts together in any order and grouping."""
    return events.select(
        "file_location", "file_name",
        F.when(F.col("status") == ACTIVE, F.col("event_time")).alias("created_date"),
        F.when(F.col("status") == INACTIVE, F.col("event_time")).alias("updated_date"),
        "status", "run_id", "event_seq")


def _folded(facts: DataFrame) -> DataFrame:
    return facts.groupBy("file_location").agg(
        F.max_by("file_name", "event_seq").alias("file_name"),
        F.min("created_date").alias("created_date"), F.max("updated_date").alias("updated_date"),
        F.max_by("status", "event_seq").alias("status"), F.max_by("run_id", "event_seq").alias("run_id"),
        F.max("event_seq").alias("event_seq"),
    )


def _with_id(states: DataFrame) -> DataFrame:
    return states.drop("event_seq").withColumn("id", F.xxhash64("file_location"))


# ---- snapshots -------------------------------------------------------------------------------

_STATE_SCHEMA = (
    "file_location string, file_name string, created_date timestamp, updated_date timestamp, "
    "status string, run_id string, event_seq bigint"
)
#: Writes of events after which ``keep_small`` makes a snapshot.
BATCHES = 200


def _snapshots(ledger: str) -> str:
    return f"{ledger}_states"


def _batches(spark: SparkSession, ledger: str) -> list[int]:
    """Numbers of the event folders: two for each run since the last snapshots."""
    names = child_folders(spark, ledger)
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def _newest_snapshots(spark: SparkSession, ledger: str) -> list[int]:
    """Numbers of the last events in whole snapshots, the newest first."""
    root = _snapshots(ledger)
    known = sorted((int(n) for n in child_folders(spark, root) if n.isdigit()), reverse=True)
    return [n for n in known if path_exists(spark, f"{root}/{n}/_SUCCESS")]


def _current(spark: SparkSession, ledger: str) -> DataFrame:
    newest = _newest_snapshots(spark, ledger)[:1]
    later = [n for n in _batches(spark, ledger) if not newest or n > newest[0]]
    facts = spark.createDataFrame([], _STATE_SCHEMA)
    if newest:
        facts = spark.read.schema(_STATE_SCHEMA).parquet(f"{_snapshots(ledger)}/{newest[0]}")
    if later:
        paths = [f"{literal_path(ledger)}/batch={n}" for n in later]
        facts = facts.unionByName(_facts(spark.read.schema(EVENT_SCHEMA).option("basePath", ledger).parquet(*paths)))
    return _folded(facts)


def current_state(spark: SparkSession, ledger: str) -> DataFrame:
    """``ledger_state`` of all events there ever were: the newest snapshot and what came after it."""
    return _with_id(_current(spark, ledger))


def compact_ledger(spark: SparkSession, ledger: str) -> int | None:
    """Writes a snapshot of all states and returns the number of its last event, none without new ones.

    Events that the snapshot before it covers are removed, and snapshots before that one: a reader that
    began on the previous snapshot still finds everything. Runs must not write events meanwhile. A
    snapshot that was not finished counts as not there.
    """
    batches, newest = _batches(spark, ledger), _newest_snapshots(spark, ledger)
    if not batches or (newest and batches[-1] <= newest[0]):
        return None
    _current(spark, ledger).write.mode("overwrite").parquet(f"{_snapshots(ledger)}/{batches[-1]}")
    for old in newest[1:]:
        remove_folder(spark, f"{_snapshots(ledger)}/{old}")
    for n in batches:
        if newest and n <= newest[0]:
            remove_folder(spark, f"{ledger}/batch={n}")
    return batches[-1]


def keep_small(spark: SparkSession, ledger: str, batches: int = BATCHES) -> None:
    """Makes a snapshot when ``batches`` writes of events have come since the last one."""
    newest = _newest_snapshots(spark, ledger)[:1]
    if sum(not newest or n > newest[0] for n in _batches(spark, ledger)) >= batches:
        compact_ledger(spark, ledger)


# ---- which files -----------------------------------------------------------------------------


def active_file_names(state: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Distinct names of files that are not finished, among ``names`` if given."""
    wanted = state.filter(F.col("status") == ACTIVE)
    if names is not None:
        wanted = wanted.filter(F.col("file_name").isin(names))
    return wanted.select("file_name").distinct()


def unfinished_files(catalog: DataFrame, state: DataFrame) -> DataFrame:
    """Waiting files that an earlier run took up and did not finish."""
    return _with_status(catalog, state, ACTIVE, "left_semi")


def without_finished(catalog: DataFrame, state: DataFrame) -> DataFrame:
    """Waiting files that no run has finished."""
    return _with_status(catalog, state, INACTIVE, "left_anti")


def _with_status(catalog: DataFrame, state: DataFrame, status: str, how: str) -> DataFrame:
    known = state.filter(F.col("status") == status).select("file_location")
    return catalog.join(known, F.col("path") == F.col("file_location"), how)
