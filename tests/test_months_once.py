"""With months over runs, a run sums its sales once."""

from tillmark.plans import batch
from tillmark.registry.queries import QUERIES


def test_sales_are_summed_once_a_run(spark, monkeypatch):
    def no_second_sum(*_, **__):
        raise AssertionError("summed again")

    monkeypatch.setattr(batch.marts, "seller_monthly_of_mart", no_second_sum)
    monkeypatch.setattr(batch.marts, "customer_monthly_of_mart", no_second_sum)
    assert QUERIES["arrived_seller_months"](spark, "/root/testdata/sf0.001").count() > 0
