"""Monthly sums of sales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.functions.columns import sales_month

# The month is grouped by as a date, its first day: text keys cost about twice the time. It becomes
# text (``sales_month``) when the sums are made.
MONTH = "month_start"
CUSTOMER_MONTH = ("customer_id", MONTH)
SELLER_MONTH = ("store_id", "sales_person_id", MONTH)
ALL_KEYS = ("customer_id", "store_id", "sales_person_id", MONTH)


def with_month_start(sales: DataFrame) -> DataFrame:
    return sales.withColumn(MONTH, F.trunc("sales_date", "month"))


def month_as_text(totals: DataFrame) -> DataFrame:
    """``sales_month`` in place of the month's first day."""
    others = [c for c in totals.columns if c != MONTH]
    return totals.select(*others, sales_month(MONTH).alias("sales_month"))


def monthly_totals(sales: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with the sum of ``total_cost``.

    A group-by, so each task first sums what it holds: what is shuffled is at most one row per
    task and key, however many sales a key has.
    """
    return sales.groupBy(*keys).agg(F.sum("total_cost").alias("total_cost"))


def with_group_total(rows: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Every row with the sum of ``value`` over its group (null keys form groups as well).

    Sums are made by a group-by and joined back, not by a window: a window would bring each whole
    group into one task, while the join lets Spark split a hot group.
    """
    totals = rows.groupBy(*keys).agg(F.sum(value).alias(name)).select(
        *[F.col(k).alias(f"group_{k}") for k in keys], name
    )
    same = [F.col(k).eqNullSafe(F.col(f"group_{k}")) for k in keys]
    return rows.join(totals, same).select(*rows.columns, name)


def customer_month_window_total(sales: DataFrame) -> DataFrame:
    """Sales rows with their customer's total for the month."""
    dated = with_month_start(sales)
    return month_as_text(with_group_total(dated, CUSTOMER_MONTH, "total_cost", "month_total"))


def seller_month_window_total(sales: DataFrame) -> DataFrame:
    """Sales rows with their seller's total for the month in that store."""
    dated = with_month_start(sales)
    return month_as_text(with_group_total(dated, SELLER_MONTH, "total_cost", "month_total"))
