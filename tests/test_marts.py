"""Marts and monthly tables on hand-worked sales."""

from decimal import Decimal as D

import pytest

from tillmark.operators import ranking
from tillmark.operators.enrich import unmatched_sales
from tillmark.operators.monthly import customer_month_window_total
from tillmark.operators.ranking import pay_best_seller, rank_many_sellers, rank_sellers
from tillmark.plans import marts
from tillmark.storage import stored


@pytest.fixture(params=["broadcast", "shuffled"])
def small(request, ALL_SMALL):
    return ALL_SMALL if request.param == "broadcast" else frozenset()


def test_ties_are_all_paid(world, small, rows_of):
    sales = world.sales((1, 10, 100, "2024-01-05", "60.00"), (1, 10, 100, "2024-01-31", "40.00"),
                        (2, 10, 101, "2024-01-07", "100.00"), (2, 10, 102, "2024-01-07", "99.99"))
    got = marts.seller_monthly_incentive(sales, *world.dims, small)
    assert rows_of(got, "sales_person_id", "full_name", "sales_month", "total_sales",
                   "incentive") == [
        (100, "Sam One", "2024-01", D("100.00"), D("1.00")),
        (101, "Sue Two", "2024-01", D("100.00"), D("1.00")),
        (102, "Sid Three", "2024-01", D("99.99"), D("0.00")),
    ]


def test_half_cents_go_up(world, small):
    sales = world.sales((1, 10, 100, "2024-01-05", "12.50"))
    assert marts.seller_monthly_incentive(sales, *world.dims, small).first()["incentive"] == D("0.13")


def test_stores_and_months_are_ranked_apart(world, small, rows_of):
    sales = world.sales((1, 10, 100, "2024-01-05", "5"), (1, 20, 101, "2024-01-05", "4"),
                        (1, 10, 101, "2024-02-05", "3"))
    got = marts.seller_monthly_incentive(sales, *world.dims, small)
    assert [r[0] for r in rows_of(got, "incentive")] == [D("0.03"), D("0.04"), D("0.05")]


def test_null_totals_come_last_and_a_null_best_stays_null(world, small, rows_of):
    sales = world.sales((1, 10, 100, "2024-01-05", None), (1, 10, 101, "2024-01-05", "1.00"),
                        (1, 20, 102, "2024-01-05", None))
    got = marts.seller_monthly_incentive(sales, *world.dims, small)
    assert rows_of(got, "sales_person_id", "total_sales", "incentive") == [
        (100, None, D("0.00")), (101, D("1.00"), D("0.01")), (102, None, None)]


def test_sales_without_a_date_form_a_month_of_their_own(world, small, rows_of):
    sales = world.sales((1, 10, 100, None, "2.00"), (1, 10, 101, None, "1.00"))
    got = marts.seller_monthly_incentive(sales, *world.dims, small)
    assert rows_of(got, "sales_person_id", "sales_month", "incentive") == [
        (100, None, D("0.02")), (101, None, D("0.00"))]
    assert marts.customer_monthly_sales(sales, *world.dims, small).first()["total_sales"] == D("3")


def test_unknown_and_null_keys_are_left_out_everywhere(world, small, rows_of):
    sales = world.sales(
        (1, 10, 100, "2024-01-05", "1.00"), (99, 10, 100, "2024-01-05", "2.00"),
        (1, 99, 100, "2024-01-05", "4.00"), (1, 10, 99, "2024-01-05", "8.00"),
        (1, 10, None, "2024-01-05", "16.00"), (99, None, 100, "2024-01-05", "32.00"))
    for mart in (marts.customer_mart, marts.sales_team_mart):
        assert rows_of(mart(sales, *world.dims, small), "total_cost") == [(D("1.00"),)]
    for table in (marts.customer_monthly_sales, marts.seller_monthly_incentive):
        assert rows_of(table(sales, *world.dims, small), "total_sales") == [(D("1.00"),)]
    missed = unmatched_sales(sales, *world.dims, small)
    assert rows_of(missed, "total_cost", "unmatched") == [
        (D("16.00"), "sales_team"), (D("2.00"), "customer"), (D("32.00"), "customer,store"),
        (D("4.00"), "store"), (D("8.00"), "sales_team")]


def test_null_first_name_gives_null_full_name(world, small):
    sales = world.sales((3, 10, 100, "2024-01-05", "1.00"))
    row = marts.customer_monthly_sales(sales, *world.dims, small).first()
    assert row["full_name"] is None and row["total_sales"] == D("1.00")


def test_team_mart_has_the_sellers_address_and_the_customers_phone(world, small):
    sales = world.sales((2, 20, 101, "2024-03-09", "7.00"))
    row = marts.sales_team_mart(sales, *world.dims, small).first().asDict()
    assert (row["first_name"], row["address"], row["pincode"]) == ("Sue", "West", "444")
    assert (row["phone_number"], row["store_manager_name"]) == ("9100000002", "Mia")
    assert (row["manager_id"], row["is_manager"], row["sales_month"]) == (900, "N", "2024-03")


def test_monthly_sums_equal_the_mart_and_do_not_depend_on_partitioning(world, small, rows_of):
    sales = world.sales(*[
        (1 + i % 3, 10 + 10 * (i % 2), 100 + i % 3, f"2024-0{1 + i % 4}-1{i % 10}", f"{i}.{i:02d}")
        for i in range(60)])
    mart = marts.customer_mart(sales, *world.dims, small)
    whole = sum(r["total_cost"] for r in mart.collect())
    for table in (marts.customer_monthly_sales, marts.seller_monthly_sales):
        one, many = (table(sales.repartition(n), *world.dims, small) for n in (1, 7))
        assert rows_of(one) == rows_of(many)
        assert sum(r["total_sales"] for r in one.collect()) == whole
    paid = marts.seller_monthly_incentive(sales, *world.dims, small)
    groups = {(r["store_id"], r["sales_month"]) for r in paid.collect()}
    best = {(r["store_id"], r["sales_month"]) for r in paid.filter("incentive > 0").collect()}
    assert groups == best


def test_window_total_keeps_every_row_and_null_months(world, rows_of):
    sales = world.sales((1, 10, 100, "2024-01-05", "1"), (1, 10, 100, "2024-01-05", "1"),
                        (1, 20, 101, "2024-01-30", "3"), (1, 10, 100, None, "5"),
                        (None, 10, 100, None, "6"))
    got = customer_month_window_total(sales)
    assert rows_of(got, "customer_id", "total_cost", "month_total") == [
        (1, D("1.00"), D("5.00")), (1, D("1.00"), D("5.00")), (1, D("3.00"), D("5.00")),
        (1, D("5.00"), D("5.00")), (None, D("6.00"), D("6.00"))]


def ranked_in_tasks(spark, totals, tasks):
    """``rank_many_sellers`` over so many ranges, however small they are."""
    settings = {"spark.sql.shuffle.partitions": str(tasks), "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return rank_many_sellers(totals)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("tasks", [1, 3, 40])
@pytest.mark.parametrize("totals", ["pow(id % 97, 2)", "if(id % 10 > 0, 500, id)", "7", "id"])
def test_ranks_by_ranges_equal_window_ranks(spark, rows_of, tasks, totals):
    """Ties, nulls, a null month, a null store, and one store with most of the sellers."""
    totals = spark.range(4000).selectExpr(
        "if(id % 3 > 0, 1, if(id % 19 = 0, null, 3)) store_id", "id sales_person_id",
        "if(id % 11 = 0, null, concat('2024-0', 1 + id % 2)) sales_month",
        f"cast(if(id % 17 = 0, null, {totals}) as decimal(18,2)) total_sales", "id % 5 AS `row`")
    assert rows_of(ranked_in_tasks(spark, totals, tasks)) == rows_of(rank_sellers(totals))


def test_no_sellers_no_ranks(spark):
    none = spark.createDataFrame([], "store_id long, sales_month string, total_sales decimal(18,2)")
    assert rank_many_sellers(none).count() == 0 and "rnk" in rank_many_sellers(none).columns


def test_both_ways_of_paying_agree(spark, rows_of):
    totals = spark.range(500).selectExpr(
        "id % 4 store_id", "id sales_person_id", "concat('2024-0', 1 + id % 3) sales_month",
        "cast(if(id % 4 = 3 or id % 5 = 0, null, id % 31) as decimal(18,2)) total_sales")
    best = {(r["store_id"], r["sales_month"], r["sales_person_id"])
            for r in rank_sellers(totals).filter("rnk = 1 AND total_sales > 0").collect()}
    paid = pay_best_seller(totals).filter("incentive > 0").collect()
    assert {(r["store_id"], r["sales_month"], r["sales_person_id"]) for r in paid} == best


def test_ties_spread_over_tasks_and_rows_are_shuffled_once(spark, rows_of, monkeypatch):
    """Nine sellers in ten are tied: no task of the ranking gets more than a few times the mean."""
    totals = spark.range(20_000).selectExpr(
        "1 store_id", "id sales_person_id", "'2024-01' sales_month",
        "cast(if(id % 10 > 0, 500, id) as decimal(18,2)) total_sales")
    seen = []
    monkeypatch.setattr(ranking, "stored", lambda df, path: seen.append((df, path)) or stored(df, path))
    ranks = ranked_in_tasks(spark, totals, 16)
    assert rows_of(ranks) == rows_of(rank_sellers(totals))
    assert len(seen) == 1
    plan = seen[0][0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan
    sizes = [r["count"] for r in spark.read.parquet(seen[0][1]).groupBy("task").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 4 * 20_000 / 16
    after = ranks._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in after and "SortMergeJoin" not in after


@pytest.mark.parametrize("table", ["customer_monthly", "seller_monthly"])
def test_sums_of_the_marts_equal_sums_of_the_sales(spark, world, rows_of, table):
    sales = world.sales((1, 10, 100, "2024-01-05", "5.00"), (1, 10, 101, "2024-01-09", "5.00"),
                        (2, 20, 101, "2024-02-01", "7.50"), (9, 10, 100, "2024-01-05", "1.00"),
                        (3, 20, 102, "2024-02-02", None))
    if table == "customer_monthly":
        got = marts.customer_monthly_of_mart(marts.customer_mart(sales, *world.dims), world.customer)
        want = marts.customer_monthly_sales(sales, *world.dims)
    else:
        got = marts.seller_monthly_of_mart(marts.sales_team_mart(sales, *world.dims), world.sales_team)
        want = marts.seller_monthly_incentive(sales, *world.dims)
    assert got.columns == want.columns and rows_of(got) == rows_of(want)
