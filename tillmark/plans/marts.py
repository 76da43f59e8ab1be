"""The marts and monthly tables.

Each is a function from the sales relation and the three dimensions to a DataFrame. Dimension keys
must be unique (``assert_unique_key``). ``small`` names the dimensions that were measured and may
be broadcast; without it Spark decides.

Only sales whose customer, store and seller are all known take part, in every result.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.functions.columns import full_name, sales_month
from tillmark.operators.enrich import (
    CUSTOMER,
    CUSTOMER_KEYS,
    SALES_TEAM,
    STORE,
    customer_columns,
    enrich_customer,
    enrich_seller,
    enrich_store,
    known_customer,
    known_seller,
    known_store,
    seller_columns,
    sized,
)
from tillmark.operators.monthly import (
    ALL_KEYS,
    CUSTOMER_MONTH,
    MONTH,
    SELLER_MONTH,
    month_as_text,
    monthly_totals,
    with_month_start,
)
from tillmark.operators.ranking import pay_best_seller
from tillmark.schema import MONEY


def customer_mart(sales: DataFrame, customer: DataFrame, store: DataFrame, sales_team: DataFrame,
                  small: Collection[str] = ()) -> DataFrame:
    """One row per sale with its customer."""
    kept = known_seller(known_store(sales, store, small), sales_team, small)
    return enrich_customer(kept, customer, small).select(
        "customer_id",
        F.col("customer_first_name").alias("first_name"),
        F.col("customer_last_name").alias("last_name"),
        F.col("customer_address").alias("address"),
        F.col("customer_pincode").alias("pincode"),
        "phone_number", "sales_date", "total_cost",
    )


def sales_team_mart(sales: DataFrame, customer: DataFrame, store: DataFrame,
                    sales_team: DataFrame, small: Collection[str] = ()) -> DataFrame:
    """One row per sale with its store and seller.

    Name, address and pincode are the seller's; ``phone_number`` is the customer's, as only
    customers have one.
    """
    return with_team(enrich_customer(sales, customer, small), store, sales_team, small)


#: What a row of the sales-team mart has that is not the store's or the seller's, and its month.
TEAM_SALE = ("store_id", "sales_person_id", "phone_number", "sales_date", "total_cost", "sales_month")


def with_team(sales: DataFrame, store: DataFrame, sales_team: DataFrame, small: Collection[str] = ()
              ) -> DataFrame:
    """The sales-team mart from sales with their customer's ``phone_number``, or from its ``TEAM_SALE``."""
    rows = enrich_seller(enrich_store(sales, store, small), sales_team, small)
    return rows.select(
        "store_id", "sales_person_id",
        F.col("seller_first_name").alias("first_name"),
        F.col("seller_last_name").alias("last_name"),
        "store_manager_name", "manager_id", "is_manager",
        F.col("seller_address").alias("address"),
        F.col("seller_pincode").alias("pincode"),
        "phone_number", "sales_date", "total_cost",
        sales_month("sales_date").alias("sales_month"),
    )


def _monthly_base(sales: DataFrame, checks: Collection[str], small: Collection[str]) -> DataFrame:
    """What the monthly tables are summed from.

    If every dimension a sale still has to be checked against can be broadcast, that is the sales
    themselves: the checks cost no shuffle. Otherwise sales are first summed by all keys, so that
    what is shuffled to the check is one row per customer, store, seller and month, and no key is
    hot any more.
    """
    dated = with_month_start(sales).select(*ALL_KEYS, "total_cost")
    cheap = {*small, CUSTOMER} if CUSTOMER_KEYS in small else set(small)
    return dated if set(checks) <= cheap else monthly_totals(dated, ALL_KEYS)


def customer_monthly_sales(sales: DataFrame, customer: DataFrame, store: DataFrame,
                           sales_team: DataFrame, small: Collection[str] = ()) -> DataFrame:
    """What each customer spent in each month.

    Sums are made on the ids alone; names are joined to the sums.
    """
    base = _monthly_base(sales, (STORE, SALES_TEAM), small)
    kept = known_seller(known_store(base, store, small), sales_team, small)
    return with_customer(monthly_totals(kept, CUSTOMER_MONTH), customer, small)


def with_customer(totals: DataFrame, customer: DataFrame, small: Collection[str] = ()) -> DataFrame:
    """Totals by customer and month with names, as published."""
    who = sized(customer_columns(customer), CUSTOMER, small)
    return month_as_text(totals).join(who, "customer_id").select(
        "customer_id",
        full_name("customer_first_name", "customer_last_name").alias("full_name"),
        F.col("customer_address").alias("address"),
        "phone_number",
        F.col("sales_month").alias("sales_date_month"),
        F.col("total_cost").cast(MONEY).alias("total_sales"),
    )


def customer_monthly_of_mart(mart: DataFrame, customer: DataFrame, small: Collection[str] = ()
                             ) -> DataFrame:
    """``customer_monthly_sales`` from the customer mart, which holds only sales with known keys."""
    dated = with_month_start(mart.select("customer_id", "sales_date", "total_cost"))
    return with_customer(monthly_totals(dated, CUSTOMER_MONTH), customer, small)


def _seller_totals(sales: DataFrame, customer: DataFrame, store: DataFrame, small: Collection[str]
                   ) -> DataFrame:
    """Totals by store, seller and month, of known customers and stores.

    Only the customer has to be checked on the sales. The store is checked on the sums: a check by
    shuffling would leave the rows arranged by store, and Spark would then sum up a hot store in the
    one task that holds it.
    """
    kept = known_customer(_monthly_base(sales, (CUSTOMER,), small), customer, small)
    return known_store(monthly_totals(kept, SELLER_MONTH), store, small)


def seller_monthly_sales(sales: DataFrame, customer: DataFrame, store: DataFrame,
                         sales_team: DataFrame, small: Collection[str] = ()) -> DataFrame:
    """What each seller sold in each month and store."""
    return _with_seller(_seller_totals(sales, customer, store, small), sales_team, small)


def _with_seller(totals: DataFrame, sales_team: DataFrame, small: Collection[str]) -> DataFrame:
    who = sized(seller_columns(sales_team), SALES_TEAM, small)
    paid = ["incentive"] if "incentive" in totals.columns else []
    return month_as_text(totals).join(who, "sales_person_id").select(
        "store_id", "sales_person_id",
        full_name("seller_first_name", "seller_last_name").alias("full_name"),
        "sales_month",
        F.col("total_cost").cast(MONEY).alias("total_sales"), *paid,
    )


def seller_months(totals: DataFrame, sales_team: DataFrame, small: Collection[str] = ()) -> DataFrame:
    """Totals by store, seller and month with names and incentive, as published.

    The best are found on ids alone, among sellers that are known; names are joined last.
    """
    known = known_seller(totals, sales_team, small)
    paid = pay_best_seller(known.withColumn("total_cost", F.col("total_cost").cast(MONEY)),
                           "total_cost", ("store_id", MONTH))
    return _with_seller(paid, sales_team, small)


def seller_monthly_incentive(sales: DataFrame, customer: DataFrame, store: DataFrame,
                             sales_team: DataFrame, small: Collection[str] = ()) -> DataFrame:
    """``seller_monthly_sales`` with the incentive: 1 % for the best of a store and month.

    All sellers tied for the best total are paid.
    """
    return seller_months(_seller_totals(sales, customer, store, small), sales_team, small)


def seller_monthly_of_mart(mart: DataFrame, sales_team: DataFrame, small: Collection[str] = ()
                           ) -> DataFrame:
    """``seller_monthly_incentive`` from the sales-team mart, which holds only sales with known keys."""
    dated = with_month_start(mart.select("store_id", "sales_person_id", "sales_date", "total_cost"))
    return seller_months(monthly_totals(dated, SELLER_MONTH), sales_team, small)
