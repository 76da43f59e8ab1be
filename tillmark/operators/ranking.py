"""Ranking the sellers of a store and month, and paying the best.

Ties share a rank, and null totals come last, as in SQL's ``rank() over (... desc)``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmark.functions.columns import incentive
from tillmark.storage import fresh_folder, stored

# Tasks get this module's functions with their code, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STORE_MONTH = ("store_id", "sales_month")


def rank_sellers(totals: DataFrame, total: str = "total_sales") -> DataFrame:
    """Adds ``rnk`` within store and month.

    A window takes all sellers of one store and month into one task: use this form when the
    number of sellers is known to be small, ``rank_many_sellers`` otherwise.
    """
    order = Window.partitionBy(*STORE_MONTH).orderBy(F.col(total).desc())
    return totals.withColumn("rnk", F.rank().over(order))


def rank_many_sellers(totals: DataFrame, total: str = "total_sales") -> DataFrame:
    """Same result as ``rank_sellers`` without bringing a store's sellers into one task.

    The rows are dealt out once, by ranges of store, month and falling total, and put in order within
    each task; ties are told apart by a hash, so that however many there are, they spread as well. A task
    notes for each row how many rows of its group, and of its run of ties, began before it there. Only
    the first group of a task can have begun in an earlier one: what it lacks follows from one row for
    each task, the counts at its ends added up in order.
    """
    ordered = [F.col(k).asc_nulls_first() for k in STORE_MONTH] + [F.col(total).desc_nulls_last()]
    apart = F.xxhash64(*[F.col(c) for c in totals.columns])
    dealt = totals.repartitionByRange(*ordered, apart.asc()).sortWithinPartitions(*ordered, apart.asc())
    placed = stored(_placed(dealt, [*STORE_MONTH, total]), fresh_folder(totals.sparkSession, "ranks"))
    begun = _begun_before(placed, total)
    # A row for each task that ranked: no growth with the rows, nor with the groups.
    joined = placed.join(F.broadcast(begun), "task")
    ahead = (
        F.when((F.col("run_at") == 0) & F.col("tied_from").isNotNull(), F.col("tied_from"))
        .when(F.col("group_at") == 0, F.col("before") + F.col("run_at"))
        .otherwise(F.col("run_at") - F.col("group_at"))
    )
    return joined.select(*[F.col(f"row.`{c}`").alias(c) for c in totals.columns],
                         (ahead + 1).cast("int").alias("rnk"))


def _differs(column: pa.Array) -> np.ndarray:
    """For each value but the first, whether it is another than the one before; nulls are alike."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    one, other = column.slice(1), column.slice(0, len(column) - 1)
    null = pc.xor(pc.is_null(one), pc.is_null(other))
    return pc.or_(null, pc.fill_null(pc.not_equal(one, other), False)).to_numpy(zero_copy_only=False)


def _placed(dealt: DataFrame, keys: list[str]) -> DataFrame:
    """``row``, ``task``, the row's place ``at`` in the task, and where its group and its run of ties
    begin there. The last of ``keys`` is what ties are by, the others make the group."""
    schema = f"task int, at long, group_at long, run_at long, row {dealt.schema.simpleString()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen, group_at, run_at, last = 0, 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            known = pa.table({str(i): batch.column(k) for i, k in enumerate(keys)})
            with_last = known if last is None else pa.concat_tables([last, known])
            new = [_differs(with_last.column(i)) for i in range(len(keys))]
            if last is None:
                new = [np.concatenate([[True], x]) for x in new]
            last = known.slice(batch.num_rows - 1)
            at = seen + np.arange(batch.num_rows)
            group = np.logical_or.reduce(new[:-1])
            groups = np.maximum.accumulate(np.where(group, at, group_at))
            runs = np.maximum.accumulate(np.where(group | new[-1], at, run_at))
            seen, group_at, run_at = seen + batch.num_rows, int(groups[-1]), int(runs[-1])
            yield pa.RecordBatch.from_pydict({
                "task": pa.array(np.full(batch.num_rows, task), pa.int32()), "at": pa.array(at, pa.int64()),
                "group_at": pa.array(groups, pa.int64()), "run_at": pa.array(runs, pa.int64()),
                "row": pa.StructArray.from_arrays(batch.columns, names=batch.schema.names)})

    return dealt.mapInArrow(run, schema)


def _begun_before(placed: DataFrame, total: str) -> DataFrame:
    """For each ``task``: how many rows of its first group came ``before`` it, and how many of them
    stand ahead of the ties that go on in it (``tied_from``; null if none do)."""
    group = F.struct(*[F.col(f"row.`{k}`").alias(k) for k in STORE_MONTH])
    facts = F.struct(group.alias("of"), F.col(f"row.`{total}`").alias("total"), "at", "group_at", "run_at")
    ends = placed.groupBy("task").agg(F.min_by(facts, "at").alias("first"), F.max_by(facts, "at").alias("last"))
    # What the first row of a task asks, and what the last one tells later tasks.
    asks = ends.select("task", F.col("first.of").alias("of"), F.col("first.total").alias("total"),
                       F.lit(0).cast("bigint").alias("here"), F.lit(None).cast("bigint").alias("run"))
    tells = ends.select("task", F.col("last.of").alias("of"), F.col("last.total").alias("total"),
                        F.expr("last.at + 1 - last.group_at").alias("here"),
                        F.expr("last.run_at - last.group_at").alias("run"))
    both = asks.withColumn("asks", F.lit(True)).unionByName(tells.withColumn("asks", F.lit(False)))
    group_before = Window.partitionBy("of").orderBy("task").rangeBetween(Window.unboundedPreceding, -1)
    ties_before = Window.partitionBy("of", "total").orderBy("task").rangeBetween(Window.unboundedPreceding, -1)
    counted = both.withColumn("before", F.coalesce(F.sum("here").over(group_before), F.lit(0)))
    told = counted.withColumn("tied_from", F.min(F.col("before") + F.col("run")).over(ties_before))
    return told.where("asks").select("task", "before", "tied_from")


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys of the same names, nulls equal; the keys come from the left side."""
    other = right.select(*[F.col(c).alias(f"of_{c}") if c in keys else F.col(c) for c in right.columns])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys])
    return left.join(other, same).drop(*[f"of_{k}" for k in keys])


def pay_best_seller(totals: DataFrame, total: str = "total_sales",
                    group: Sequence[str] = STORE_MONTH) -> DataFrame:
    """Adds ``incentive``: 1 % of the total for every seller with rank 1, 0 for the others.

    Rank 1 is all that matters here, and it means: as much as the store's best total of the month.
    That comes from a group-by, and no task ever holds all sellers of a store.
    """
    best = totals.groupBy(*group).agg(F.max(total).alias("best"))
    return _joined(totals, best, group).select(
        *totals.columns, incentive(total, F.col(total).eqNullSafe(F.col("best"))).alias("incentive")
    )
