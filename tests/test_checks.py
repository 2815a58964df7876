"""Every check kind must pass on clean data and fail on a seeded violation."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks
from tidemark.plans.catalog import Models

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def models(spark):
    return Models(spark, SF_SMALL)


def _suite(m, **over):
    parts = dict(raw=m.raw, stg=m.stg_orders, dim_customer=m.dim_customer,
                 dim_restaurant=m.dim_restaurant, dim_date=m.dim_date, fct=m.fct_orders,
                 daily=m.agg_daily_zone_metrics, monthly=m.agg_monthly_revenue_by_tier)
    parts.update(over)
    return {r["check_name"]: r["failures"] for r in checks.summary(checks.standard_suite(**parts)).collect()}


def test_suite_has_the_31_tests_and_only_the_late_check_fails_on_plain_fixtures(models):
    result = _suite(models)
    assert len(result) == 31
    failing = {k for k, v in result.items() if v}
    assert failing <= {"assert_late_arriving_restaurants_are_resolved"}


def test_seeded_violations_fail(models, spark):
    fct = models.fct_orders
    dup = fct.unionByName(fct.limit(1))
    bad_key = fct.withColumn("customer_key", F.when(F.col("order_id") == "1", None)
                             .otherwise(F.col("customer_key")))
    dangling = fct.withColumn("restaurant_key", F.when(F.col("order_id") == "1", F.lit("nope"))
                              .otherwise(F.col("restaurant_key")))
    negative = fct.withColumn("net_amount", F.when(F.col("order_id") == "1", F.lit(Decimal("-1.00")))
                              .otherwise(F.col("net_amount")).cast("decimal(12,2)"))
    bad_status = models.stg_orders.withColumn("status", F.lit("LOST"))
    bad_rate = models.dim_restaurant.withColumn("commission_pct", F.lit(Decimal("75.00")).cast("decimal(5,2)"))
    assert _suite(models, fct=dup)["unique_fct_orders_order_id"] == 1
    assert _suite(models, fct=dup)["assert_fact_reconciles_with_staging"] == 1
    assert _suite(models, fct=bad_key)["not_null_fct_orders_customer_key"] == 1
    assert _suite(models, fct=dangling)["relationships_fct_orders_restaurant_key"] == 1
    assert _suite(models, fct=negative)["expression_is_true_fct_orders_net_amount"] == 1
    assert _suite(models, stg=bad_status)["accepted_values_stg_orders_status"] == 1
    assert _suite(models, dim_restaurant=bad_rate)["accepted_range_dim_restaurant_commission_pct"] > 0


def test_overlap_check_flags_versions_starting_inside_another(spark):
    t = dt.datetime.fromisoformat
    versions = spark.createDataFrame([
        ("customer", "A", t("2024-01-01 00:00:00"), t("2024-01-10 00:00:00")),
        ("customer", "A", t("2024-01-05 00:00:00"), t("2024-01-20 00:00:00")),  # overlaps the first
        ("customer", "A", t("2024-01-20 00:00:00"), t("9999-12-31 23:59:59")),  # touches, no overlap
        ("customer", "B", t("2024-01-01 00:00:00"), t("2024-01-02 00:00:00")),
    ], "dim string, natural_key string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    got = [tuple(r) for r in checks.scd2_overlaps(versions).collect()]
    assert got == [("customer", "A", t("2024-01-01 00:00:00"), t("2024-01-05 00:00:00"))]


def test_gate_raises_only_for_error_level(spark):
    result = spark.createDataFrame([("a", "error", 0), ("b", "warn", 3)],
                                   "check_name string, severity string, failures bigint")
    assert len(checks.gate(result)) == 2
    bad = spark.createDataFrame([("a", "error", 1)], "check_name string, severity string, failures bigint")
    with pytest.raises(checks.DataQualityError):
        checks.gate(bad)


def test_overlap_pairs_equal_the_interval_self_join(spark):
    import random

    rng, base = random.Random(2), dt.datetime(2024, 1, 1)
    rows = []
    for _ in range(120):
        a = base + dt.timedelta(days=rng.randrange(20))
        rows.append(("customer", rng.choice("AB"), a, a + dt.timedelta(days=rng.choice([0, 1, 2, 9]))))
    versions = spark.createDataFrame(rows, "dim string, natural_key string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    want = [r + (n,) for r in rows if (n := sum(a[:2] == r[:2] and a[2] < r[2] < a[3] for a in rows))]
    assert sorted(map(tuple, checks.overlap_pairs(versions).collect())) == sorted(want)
    assert checks.overlap_pairs(versions.limit(0)).count() == 0


def test_counts_compile_to_plans_without_interpreted_lambdas(spark, models):
    """Entries of a check were filtered by a lambda function, row by row (daily runs at 60 times sf0.1)."""
    fct = spark.createDataFrame([("1", "a", Decimal("2.00")), ("1", None, Decimal("3.00")), (None, "b", None)],
                                "order_id string, customer_key string, gross_amount decimal(10,2)")
    dim = spark.createDataFrame([("a",), ("a",)], "customer_key string")
    suite = [checks.unique_check("twice", fct, "order_id"), checks.row_check("no_key", fct, "not_null", "customer_key"),
             checks.relation_check("lost", fct, "customer_key", dim, "customer_key"),
             checks.Check("balance", checks.BALANCE, lambda: None, table=fct, parent=fct.limit(2), field="gross_amount"),
             checks.Check("even", checks.BALANCE, lambda: None, table=fct, parent=fct, field="gross_amount")]
    counts = checks.failure_counts(suite)
    assert "lambda" not in counts._jdf.queryExecution().optimizedPlan().toString()
    assert {r["check_name"]: r["failures"] for r in counts.collect()} == {"twice": 1, "no_key": 1, "lost": 1, "balance": 1}
