"""Made-up sales: domains, repeatability, and that they fit the batch's file checks."""

import datetime as dt

import pytest

from tillmark.schema import MANDATORY
from tillmark.sources.catalog import build_manifest, file_catalog
from tillmark.sources import synth
from tillmark.sources.synth import PRODUCTS, VARIANTS, synth_customers, synth_sales, trial_ids


def test_domains(spark):
    sales = synth_sales(trial_ids(spark, 5000))
    assert sales.columns == list(MANDATORY)
    r = sales.selectExpr(
        "min(customer_id) c0", "max(customer_id) c1", "min(store_id) s0", "max(store_id) s1",
        "min(sales_person_id) p0", "max(sales_person_id) p1", "min(quantity) q0",
        "max(quantity) q1", "min(sales_date) d0", "max(sales_date) d1",
        "count(distinct product_name) products", "count(distinct store_id, sales_person_id) pairs",
        "count_if(total_cost <> price * quantity) wrong").first()
    sellers, last_store = synth.STORES * synth.SELLERS_PER_STORE, synth.FIRST_STORE + synth.STORES - 1
    assert (r.c0, r.c1, r.s0, r.s1) == (1, synth.CUSTOMERS, synth.FIRST_STORE, last_store)
    assert (r.p0, r.p1, r.q0, r.q1) == (1, sellers, 1, 10)
    assert (r.d0, r.d1) == (synth.FIRST_DAY, synth.LAST_DAY)
    assert (r.products, r.pairs, r.wrong) == (len(PRODUCTS), sellers, 0)


def test_same_ids_same_rows_on_any_partitioning(spark, rows_of):
    one, many = (synth_sales(trial_ids(spark, 300).repartition(n)) for n in (1, 9))
    assert rows_of(one) == rows_of(many)
    assert rows_of(one) != rows_of(synth_sales(trial_ids(spark, 300), seed=1))


@pytest.mark.parametrize("variant", VARIANTS)
def test_variants_as_landing_files(spark, tmp_path, variant):
    day = dt.date(2024, 2, 29)
    path = str(tmp_path / "in")
    synth_sales(trial_ids(spark, 50), variant=variant, day=day).write.option(
        "header", True).csv(path)
    verdicts = build_manifest(file_catalog(spark, path), path).select(
        "accepted", "missing", "extras").distinct().collect()
    lacking = variant == "missing_column"
    extra = ["payment_mode"] if variant in ("extra_column", "missing_column") else []
    assert [tuple(v) for v in verdicts] == [(not lacking, ["store_id"] if lacking else [], extra)]
    days = {r[0] for r in spark.read.option("header", True).csv(path).select("sales_date").collect()}
    assert (days == {"2024-02-29"}) == (variant != "dated")


def test_unknown_variant(spark):
    with pytest.raises(ValueError, match="unknown variant"):
        synth_sales(trial_ids(spark, 1), variant="other")


def test_customers(spark):
    people = synth_customers(trial_ids(spark, 500))
    r = people.selectExpr(
        "count(distinct customer_id) n", "count_if(not phone_number rlike '^91[0-9]{8}$') wrong",
        "min(customer_joining_date) d0", "max(customer_joining_date) d1",
        "count(distinct address, pincode) places").first()
    assert (r.n, r.wrong, r.places) == (500, 0, 1)
    assert synth.FIRST_JOINING_DAY <= r.d0 <= r.d1 <= synth.LAST_DAY
