"""The supplied order tables seen as sales and dimensions.

A sale is a line item: its customer is the order's, its store the supplier's nation, its seller
the supplier.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.operators.enrich import (
    CUSTOMER,
    CUSTOMER_KEYS,
    KEYS_A_WORD,
    SALES_TEAM,
    STORE,
    key_words,
)
from tillmark.operators.sizing import small_tables
from tillmark.schema import MONEY


# Stated, so that opening a table needs no job to look at its files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


@dataclass(frozen=True)
class Star:
    """Sales, dimensions and which dimensions may be broadcast."""

    sales: DataFrame
    customer: DataFrame
    store: DataFrame
    sales_team: DataFrame
    small: frozenset[str]

    @property
    def parts(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, frozenset[str]]:
        return self.sales, self.customer, self.store, self.sales_team, self.small


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.substring_index("c_name", "#", 1).alias("first_name"),
        F.substring_index("c_name", "#", -1).alias("last_name"),
        F.col("n_name").alias("address"),
        F.lpad(F.col("c_nationkey").cast("string"), 6, "0").alias("pincode"),
        F.concat(F.lit("91"), F.lpad(F.col("c_custkey").cast("string"), 8, "0"))
        .alias("phone_number"),
        F.lit(None).cast("date").alias("customer_joining_date"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("address"),
        F.lpad(F.col("n_nationkey").cast("string"), 6, "0").alias("store_pincode"),
        F.col("r_name").alias("store_manager_name"),
        F.lit(None).cast("date").alias("store_opening_date"),
        F.lit(None).cast("string").alias("reviews"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").alias("id"),
        F.substring_index("s_name", "#", 1).alias("first_name"),
        F.substring_index("s_name", "#", -1).alias("last_name"),
        F.col("s_nationkey").cast("bigint").alias("manager_id"),
        F.when(F.col("s_acctbal") > 0, "N").otherwise("Y").alias("is_manager"),
        F.col("n_name").alias("address"),
        F.lpad(F.col("s_nationkey").cast("string"), 6, "0").alias("pincode"),
        F.lit(None).cast("date").alias("joining_date"),
    )


def sales(spark: SparkSession, sf_dir: str, small: frozenset[str] = frozenset(),
          products: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """The sales relation and any supplied columns to keep.

    Product name and price are filled only if asked for (they cost a join).
    """
    lines = table(spark, sf_dir, "lineitem")
    # A date takes fewer bytes of a shuffle than its time of day.
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("sales_date"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    if SALES_TEAM in small:
        supplier = F.broadcast(supplier)
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    product, price = F.lit(None).cast("string"), F.lit(None).cast(MONEY)
    if products:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
        rows = rows.join(part, lines.l_partkey == part.p_partkey)
        product, price = F.col("p_name"), F.col("p_retailprice").cast(MONEY)
    # The seller's store comes last: where sellers are broadcast, it is in no shuffle.
    return rows.join(supplier, lines.l_suppkey == supplier.s_suppkey).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("s_nationkey").cast("bigint").alias("store_id"),
        product.alias("product_name"),
        "sales_date",
        F.col("l_suppkey").alias("sales_person_id"),
        price.alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("total_cost"),
        F.lit(None).cast("string").alias("additional_column"),
        *keep,
    )


#: What was measured: by session and folder, whose tables do not change.
_MEASURED: dict[tuple[str, str], frozenset[str]] = {}


def small_dimensions(spark: SparkSession, sf_dir: str) -> frozenset[str]:
    """Which dimensions may be broadcast; measured once for a session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MEASURED:
        _MEASURED[key] = _measured(spark, sf_dir)
    return _MEASURED[key]


def _measured(spark: SparkSession, sf_dir: str) -> frozenset[str]:
    """Which dimensions are small.

    A row of a dimension is a row of its table and at most two short names from ``nation`` and
    ``region``, whose few rows are measured along with it; so the tables are measured, without the
    joins that add the names.
    """
    names = {n: table(spark, sf_dir, n) for n in ("nation", "region")}
    tables = {
        CUSTOMER: table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"),
        SALES_TEAM: table(spark, sf_dir, "supplier").select(
            "s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
    }
    small = small_tables({**names, **tables})
    if not names.keys() <= small:
        return frozenset()
    found = {STORE, *(small & tables.keys())}
    if CUSTOMER not in found:
        words = {CUSTOMER_KEYS: key_words(tables[CUSTOMER], "c_custkey")}
        found |= small_tables(words, narrowed=KEYS_A_WORD)
    return frozenset(found)


def star(spark: SparkSession, sf_dir: str, narrowed: bool = False, products: bool = False) -> Star:
    """Everything at once.

    All supplied keys match. ``narrowed`` leaves customers and sellers in debt out of the
    dimensions and keeps one region's stores out too, so that some sales stay unmatched.
    """
    c, st, se = (f(spark, sf_dir) for f in (customers, stores, sellers))
    if narrowed:
        debtors = table(spark, sf_dir, "customer").filter("c_acctbal <= 0")
        c = c.join(debtors, c.customer_id == debtors.c_custkey, "left_anti")
        st = st.filter("store_manager_name <> 'ASIA'")
        se = se.filter("is_manager = 'N'")
    small = small_dimensions(spark, sf_dir)
    return Star(sales(spark, sf_dir, small, products), c, st, se, small)
