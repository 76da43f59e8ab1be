"""Tables laid out by a key, so that what is joined or summed by it every night needs no shuffle.

A bucketed table pays its shuffle once, when it is written. Bucket sums and dimensions, not sales: all
rows of a key lie in one bucket, which one task reads, and a customer with a third of all sales is
only a row a month, store and seller in the sums.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.operators.enrich import ALL_LARGE, known_seller, known_store
from tillmark.operators.monthly import ALL_KEYS, CUSTOMER_MONTH, monthly_totals, with_month_start
from tillmark.plans.marts import with_customer

BUCKET_KEY = "customer_id"


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int,
                   mode: str = "overwrite") -> DataFrame:
    """The table, kept at ``path`` in a file for each bucket and write, sorted by the keys.

    Tables that are to be joined need the same number of buckets. ``append`` adds to a table of the
    same layout; its buckets then have several files, and a join sorts them again, without shuffling.
    """
    (
        df.repartition(buckets, *keys).write.mode(mode).format("parquet")
        .bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    )
    return df.sparkSession.table(table)


def drop_bucketed(spark: SparkSession, table: str) -> None:
    """Forgets the table; the files at its path stay."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def customer_sums(sales: DataFrame, store: DataFrame, sales_team: DataFrame,
                  small: Collection[str] = ()) -> DataFrame:
    """What is kept of a night's sales for the customers' months: a row a customer, store, seller and
    month, of known stores and sellers.

    Sums are made before the checks, as these may shuffle.
    """
    sums = monthly_totals(with_month_start(sales).select(*ALL_KEYS, "total_cost"), ALL_KEYS)
    kept = known_seller(known_store(sums, store, small), sales_team, small)
    return kept.where(F.col(BUCKET_KEY).isNotNull()).select(*ALL_KEYS, "total_cost")


def customer_monthly_of_sums(sums: DataFrame, customer: DataFrame) -> DataFrame:
    """``customer_monthly_sales`` from tables bucketed alike by the customer: nothing is shuffled,
    however many nights ``sums`` holds."""
    return with_customer(monthly_totals(sums, CUSTOMER_MONTH), customer, ALL_LARGE)
