"""What Spark makes of the queries: shuffles, broadcasts, columns read, skew."""

import re

import pytest

from tillmark.operators.enrich import enrich_customer
from tillmark.plans import marts
from tillmark.registry.queries import QUERIES
from tillmark.registry.supplied import star
from tillmark.sinks.bucketed import customer_monthly_of_sums, customer_sums, drop_bucketed, write_bucketed

SF = "/root/testdata/sf0.01"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()




@pytest.fixture
def sales(spark, world, tmp_path):
    path = str(tmp_path / "sales")
    world.sales(*[(1 + i % 2, 10, 100 + i % 2, "2024-01-05", "1.00") for i in range(20)]
                ).write.parquet(path)
    return spark.read.parquet(path)


def test_small_dimensions_cost_no_shuffle(world, sales, ALL_SMALL):
    for mart in (marts.customer_mart, marts.sales_team_mart):
        plan = plan_of(mart(sales, *world.dims, ALL_SMALL))
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_monthly_tables_shuffle_partial_sums_only(world, sales, ALL_SMALL):
    customer = plan_of(marts.customer_monthly_sales(sales, *world.dims, ALL_SMALL))
    assert customer.count("Exchange hashpartitioning") == 1 and "partial_sum" in customer
    seller = plan_of(marts.seller_monthly_incentive(sales, *world.dims, ALL_SMALL))
    # The sums, once for the totals and once for the best of them, the best, and their join.
    assert seller.count("Exchange hashpartitioning") <= 5 and "partial_sum" in seller
    assert "partial_max" in seller and "Window" not in seller
    assert "full_name" not in re.search(r"partial_sum.*", seller).group(0)


def test_only_needed_columns_are_read(world, sales, ALL_SMALL):
    plan = plan_of(marts.customer_monthly_sales(sales, *world.dims, ALL_SMALL))
    schema = re.search(r"ReadSchema: struct<([^>]*)", plan).group(1)
    assert "product_name" not in schema and "price" not in schema and "total_cost" in schema


@pytest.mark.parametrize("table", ["seller_monthly_incentive", "customer_monthly_sales"])
def test_large_dimensions_are_never_broadcast_by_us(spark, world, sales, table):
    """Every sum has a partial sum right before its shuffle, also when all joins shuffle.

    A sum without a shuffle of its own would run on rows arranged for a join, where all rows of a
    hot key lie in one task.
    """
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(getattr(marts, table)(sales, *world.dims))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" not in plan and "Window" not in plan
    lines = plan.splitlines()
    sums = [i for i, line in enumerate(lines) if re.search(r"functions=\[(sum|max)\(", line)]
    assert sums
    for i in sums:
        assert "Exchange hashpartitioning" in lines[i + 1] and "partial_" in lines[i + 2]


def test_skewed_row_level_join_is_split(spark, world):
    """A customer with most of the rows is handled by several tasks when joined by shuffling."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    hot = spark.range(0, 100_000, 1, 8).selectExpr(
        "if(id % 10 < 8, 1L, id) customer_id", "sha2(string(id), 256) filler")
    people = spark.range(100_000).selectExpr(
        "id customer_id", "'a' first_name", "'b' last_name", "'c' address", "'d' pincode",
        "'e' phone_number", "cast(null as date) customer_joining_date")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = enrich_customer(hot, people)
        assert joined.count() == 100_000
        execution = joined._jdf.queryExecution()
        execution.executedPlan().execute().count()
        assert "skew=true" in execution.executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_supplied_star_is_measured(spark):
    s = star(spark, SF)
    assert s.small == {"customer", "store", "sales_team"}
    plan = plan_of(marts.seller_monthly_incentive(*s.parts))
    assert "l_comment" not in plan and "l_discount" not in plan


@pytest.mark.parametrize("name", [
    "seller_monthly_incentive_shuffled", "customer_monthly_sales_shuffled", "enrich_sales_shuffled"])
def test_shuffled_queries_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    # Only the supplied tables may be broadcast on the way to the star, never a dimension's columns.
    assert plan.count("SortMergeJoin") >= 3


def test_bucketed_tables_are_not_shuffled(spark):
    plan = plan_of(QUERIES["customer_monthly_sales_bucketed"](spark, SF))
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert plan.count("Bucketed: true") == 2 and "SelectedBucketsCount: 16 out of 16" in plan


def test_bucketed_sums_of_two_nights_make_up_the_months(spark, world, tmp_path, rows_of):
    nights = [world.sales((1, 10, 100, "2024-01-05", "1"), (2, 20, 101, "2024-01-06", None),
                          (None, 10, 100, "2024-01-05", "4"), (9, 10, 100, "2024-01-05", "8")),
              world.sales((1, 20, 101, "2024-01-31", "16"), (1, 77, 101, "2024-01-31", "32"),
                          (3, 10, 100, None, "64"))]
    try:
        for night, mode in zip(nights, ("overwrite", "append"), strict=True):
            sums = write_bucketed(customer_sums(night, world.store, world.sales_team), "sums_of_nights",
                                  str(tmp_path / "sums"), ["customer_id"], 4, mode)
        who = write_bucketed(world.customer, "customers_of_nights", str(tmp_path / "who"), ["customer_id"], 4)
        got = customer_monthly_of_sums(sums, who)
        assert "Exchange" not in plan_of(got)
        both = nights[0].unionAll(nights[1])
        assert rows_of(got) == rows_of(marts.customer_monthly_sales(both, *world.dims))
        assert got.count() == 3
    finally:
        drop_bucketed(spark, "sums_of_nights")
        drop_bucketed(spark, "customers_of_nights")
