"""Joining sales to their customer, store and seller.

All joins are inner and on equal keys, so a sale with a null or unknown key is left out;
``unmatched_sales`` shows which. Dimensions are cut down to the wanted columns and get their final
names before the join, so that no name occurs twice afterwards.

``small`` names the dimensions that were measured and found fit to broadcast (see ``sizing``). Any
other is joined by shuffling; a hot key is then split by Spark's skew-join handling, which these
plans leave room for: nothing after a row-level join relies on its partitioning.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.schema import CANONICAL

CUSTOMER, STORE, SALES_TEAM = "customer", "store", "sales_team"
DIMENSIONS = (CUSTOMER, STORE, SALES_TEAM)
# In place of names of small dimensions: join all by shuffling, whatever Spark takes their size for.
ALL_LARGE = frozenset({"all by shuffling"})
# Among names of small dimensions: of this one only the keys fit, as words of bits (``key_words``).
CUSTOMER_KEYS = "keys of customer"
# Keys a word stands for.
KEYS_A_WORD = 64

# Fixed value: the columns of a sale that go on when its customer is joined.
KEPT_COLUMNS = ("customer_id", "store_id", "sales_date", "sales_person_id", "total_cost")


def customer_columns(customer: DataFrame) -> DataFrame:
    return customer.select(
        "customer_id",
        F.col("first_name").alias("customer_first_name"),
        F.col("last_name").alias("customer_last_name"),
        F.col("address").alias("customer_address"),
        F.col("pincode").alias("customer_pincode"),
        "phone_number",
    )


def store_columns(store: DataFrame) -> DataFrame:
    return store.select(
        F.col("id").alias("store_id"), F.col("address").alias("store_address"),
        "store_manager_name",
    )


def seller_columns(sales_team: DataFrame) -> DataFrame:
    return sales_team.select(
        F.col("id").alias("sales_person_id"),
        F.col("first_name").alias("seller_first_name"),
        F.col("last_name").alias("seller_last_name"),
        "manager_id",
        "is_manager",
        F.col("address").alias("seller_address"),
        F.col("pincode").alias("seller_pincode"),
        F.col("joining_date").alias("seller_joining_date"),
    )


def sized(dim: DataFrame, name: str, small: Collection[str]) -> DataFrame:
    """The dimension with a hint for how to join it."""
    if small == ALL_LARGE:
        return dim.hint("merge")
    return F.broadcast(dim) if name in small else dim


def enrich_customer(sales: DataFrame, customer: DataFrame, small: Collection[str] = ()
                    ) -> DataFrame:
    """Sales with the customer's columns; of their own, ``KEPT_COLUMNS`` and any that are not a
    sale's."""
    slim = sales.select(*[c for c in sales.columns if c in KEPT_COLUMNS or c not in CANONICAL])
    return slim.join(sized(customer_columns(customer), CUSTOMER, small), "customer_id")


def enrich_store(sales: DataFrame, store: DataFrame, small: Collection[str] = ()) -> DataFrame:
    """Sales with the store's address and manager."""
    return sales.join(sized(store_columns(store), STORE, small), "store_id")


def enrich_seller(sales: DataFrame, sales_team: DataFrame, small: Collection[str] = ()
                  ) -> DataFrame:
    """Sales with the seller's columns."""
    return sales.join(sized(seller_columns(sales_team), SALES_TEAM, small), "sales_person_id")


def enrich_sales(sales: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame,
                 small: Collection[str] = ()) -> DataFrame:
    """The whole star: every sale whose three keys are known, with all three sets of columns."""
    return enrich_seller(
        enrich_store(enrich_customer(sales, customer, small), store, small), sales_team, small
    )


def _keys(dim: DataFrame, column: str, key: str) -> DataFrame:
    return dim.select(F.col(column).alias(key))


def key_words(dim: DataFrame, column: str) -> DataFrame:
    """``block, bits``: a row for up to ``KEYS_A_WORD`` neighbouring integer keys, a bit for each."""
    bit = F.expr(f"shiftleft(1L, cast(`{column}` & 63 AS int))")
    return dim.select(F.shiftright(column, 6).alias("block"), bit.alias("bit")).groupBy("block").agg(
        F.bit_or("bit").alias("bits"))


def known_customer(sales: DataFrame, customer: DataFrame, small: Collection[str] = ()
                   ) -> DataFrame:
    """Sales of known customers; for results that need none of the customer's columns.

    Customers too many to broadcast may be checked by the bits of their keys, without a shuffle.
    """
    if CUSTOMER_KEYS in small:
        words = F.broadcast(key_words(customer, "customer_id"))
        known = (F.shiftright("customer_id", 6) == F.col("block")) & (
            F.expr("getbit(bits, cast(customer_id & 63 AS int))") == 1)
        return sales.join(words, known, "left_semi")
    keys = _keys(customer, "customer_id", "customer_id")
    return sales.join(sized(keys, CUSTOMER, small), "customer_id", "left_semi")


def known_store(sales: DataFrame, store: DataFrame, small: Collection[str] = ()) -> DataFrame:
    """Sales in known stores."""
    return sales.join(sized(_keys(store, "id", "store_id"), STORE, small), "store_id",
                      "left_semi")


def known_seller(sales: DataFrame, sales_team: DataFrame, small: Collection[str] = ()
                 ) -> DataFrame:
    """Sales by known sellers."""
    keys = _keys(sales_team, "id", "sales_person_id")
    return sales.join(sized(keys, SALES_TEAM, small), "sales_person_id", "left_semi")


def unmatched_sales(sales: DataFrame, customer: DataFrame, store: DataFrame,
                    sales_team: DataFrame, small: Collection[str] = ()) -> DataFrame:
    """Sales the star join leaves out, with ``unmatched``: which keys are null or unknown.

    One pass: each dimension's keys are joined from the left and the misses written down. An
    audit of the inner joins, not a mart.
    """
    marked = sales
    for name, dim, column, key in (
        (CUSTOMER, customer, "customer_id", "customer_id"),
        (STORE, store, "id", "store_id"),
        (SALES_TEAM, sales_team, "id", "sales_person_id"),
    ):
        keys = _keys(dim, column, key).withColumn(f"found_{name}", F.lit(True))
        marked = marked.join(sized(keys, name, small), key, "left")
    misses = F.concat_ws(
        ",", *[F.when(F.col(f"found_{n}").isNull(), F.lit(n)) for n in DIMENSIONS]
    )
    return (
        marked.withColumn("unmatched", misses)
        .filter(F.col("unmatched") != "")
        .select(*sales.columns, "unmatched")
    )
