"""Customers too many to broadcast are checked by the bits of their keys."""

import pytest

from tillmark.operators import enrich, sizing
from tillmark.plans import marts
from tillmark.registry import supplied

SF = "/root/testdata/sf0.01"
KEYS = frozenset({enrich.STORE, enrich.SALES_TEAM, enrich.CUSTOMER_KEYS})
IDS = [0, 1, 62, 63, 64, 127, 128, -1, -64, -65, 2**63 - 1, -(2**63), 5_000_000_000]


def test_bits_of_keys_tell_known_customers(spark):
    known = spark.createDataFrame([(i,) for i in IDS + [None, 63]], "customer_id long")
    asked = spark.createDataFrame([(i,) for i in IDS + IDS + [2, 61, 65, 129, -2, -63, 6_000_000_000, None]],
                                  "customer_id long")
    got = enrich.known_customer(asked, known, KEYS)
    assert sorted(r[0] for r in got.collect()) == sorted(IDS + IDS)
    assert enrich.known_customer(asked, known.limit(0), KEYS).count() == 0


def test_many_customers_are_not_shuffled_to(spark, monkeypatch):
    monkeypatch.setattr(supplied, "_MEASURED", {})
    monkeypatch.setattr(sizing.small_tables, "__defaults__", (sizing.MAX_BROADCAST_BYTES, 1_000, 1))
    s = supplied.star(spark, SF)  # 1,500 customers
    assert s.small == KEYS
    wanted = supplied.Star(s.sales, s.customer, s.store, s.sales_team, frozenset(enrich.DIMENSIONS))
    for table in (marts.seller_monthly_sales, marts.seller_monthly_incentive):
        found, plain = table(*s.parts), table(*wanted.parts)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(customer_id" not in plan and "block" in plan
        assert sorted(found.collect()) == sorted(plain.collect())


@pytest.mark.parametrize("narrowed, names", [(1, set()), (64, {"t"})])
def test_files_larger_than_their_words_are_measured(spark, tmp_path, narrowed, names):
    path = str(tmp_path / "t")
    spark.range(100_000).write.parquet(path)
    words = enrich.key_words(spark.read.parquet(path), "id")
    assert sizing.small_tables({"t": words}, 100_000, 10_000, narrowed) == names
