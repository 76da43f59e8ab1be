"""Made-up sales and customers for trials: one row per id of a given frame.

Each value is drawn from a hash of the row's id, so the same ids give the same rows on any number
of executors, on a retry, and in any engine that has md5.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.schema import MONEY

# Invented: what trial sales are drawn from.
PRODUCTS = {
    "green tea": "3.75", "ginger biscuit": "1.20", "lamp oil": "18.50", "paper lantern": "6.40",
    "copper kettle": "74.90", "wool blanket": "52.00", "pocket atlas": "0.95",
}
CUSTOMERS = 25
FIRST_STORE = 501
STORES = 4
SELLERS_PER_STORE = 3
PAYMENT_MODES = ("card", "voucher", "coins")
FIRST_DAY = dt.date(2021, 2, 1)
LAST_DAY = dt.date(2021, 11, 30)

VARIANTS = ("dated", "daily", "extra_column", "missing_column")

CUSTOMER_ADDRESS = "Harbour Lane"
CUSTOMER_PINCODE = "004711"
PHONE_PREFIX = "91"
FIRST_JOINING_DAY = dt.date(2019, 5, 1)

GIVEN_NAMES = ("Ada", "Bo", "Cleo", "Dag", "Eira", "Finn", "Gro", "Hal")
FAMILY_NAMES = ("Aske", "Bell", "Crane", "Dale", "Elm", "Frost", "Gale", "Hart")


def draw(id_: Column, what: str, n: int, seed: int = 0) -> Column:
    """A whole number from 0 to n-1 that depends only on the id, the seed and what is drawn."""
    digest = F.md5(F.concat_ws(":", F.lit(what), F.lit(str(seed)), id_.cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(n))


def _pick(values: Sequence[str], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))


def synth_sales(ids: DataFrame, id_col: str = "id", variant: str = "dated", seed: int = 0,
                day: dt.date | None = None) -> DataFrame:
    """One sale per id.

    ``dated`` spreads the sales over the whole period, the other variants put them on one ``day``.
    ``extra_column`` adds ``payment_mode``; ``missing_column`` adds it too but has no ``store_id``,
    and its ``sales_person_id`` holds the text of a whole list of sellers.
    """
    if variant not in VARIANTS:
        raise ValueError(f"unknown variant {variant!r}")
    i = F.col(id_col)
    days = (LAST_DAY - FIRST_DAY).days + 1
    date = (
        F.date_add(F.lit(FIRST_DAY), draw(i, "day", days, seed).cast("int"))
        if variant == "dated" else F.lit(day or LAST_DAY)
    )
    store = draw(i, "store", STORES, seed)
    seller = store * SELLERS_PER_STORE + draw(i, "seller", SELLERS_PER_STORE, seed) + 1
    product = draw(i, "product", len(PRODUCTS), seed)
    quantity = (draw(i, "quantity", 10, seed) + 1).cast("int")
    price = _pick(list(PRODUCTS.values()), product).cast(MONEY)
    if variant == "missing_column":
        first = store * SELLERS_PER_STORE + 1
        seller = F.concat(F.lit("["), F.concat_ws(", ", *[
            (first + k).cast("string") for k in range(SELLERS_PER_STORE)]), F.lit("]"))
    columns = [
        (draw(i, "customer", CUSTOMERS, seed) + 1).alias("customer_id"),
        (store + FIRST_STORE).alias("store_id"),
        _pick(list(PRODUCTS), product).alias("product_name"),
        date.alias("sales_date"),
        seller.alias("sales_person_id"),
        price.alias("price"),
        quantity.alias("quantity"),
        (price * quantity).cast(MONEY).alias("total_cost"),
    ]
    if variant == "missing_column":
        del columns[1]
    if variant in ("extra_column", "missing_column"):
        columns.append(_pick(PAYMENT_MODES, draw(i, "payment", len(PAYMENT_MODES), seed))
                       .alias("payment_mode"))
    return ids.select(*columns)


def synth_customers(ids: DataFrame, id_col: str = "id", seed: int = 0) -> DataFrame:
    """One customer per id, at one address and pincode, with a number of ``91`` and 8 digits."""
    i = F.col(id_col)
    span = (LAST_DAY - FIRST_JOINING_DAY).days + 1
    return ids.select(
        i.cast("bigint").alias("customer_id"),
        _pick(GIVEN_NAMES, draw(i, "given", len(GIVEN_NAMES), seed)).alias("first_name"),
        _pick(FAMILY_NAMES, draw(i, "family", len(FAMILY_NAMES), seed)).alias("last_name"),
        F.lit(CUSTOMER_ADDRESS).alias("address"),
        F.lit(CUSTOMER_PINCODE).alias("pincode"),
        F.concat(F.lit(PHONE_PREFIX), F.lpad(draw(i, "phone", 10**8, seed).cast("string"), 8, "0"))
        .alias("phone_number"),
        F.date_add(F.lit(FIRST_JOINING_DAY), draw(i, "joined", span, seed).cast("int"))
        .alias("customer_joining_date"),
    )


def trial_ids(spark: SparkSession, n: int) -> DataFrame:
    """Ids 0 to n-1, for trials that have no table to take ids from."""
    return spark.range(n)
