import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dims, history
from tidemark.sources import fixtures
from tidemark.sources.schemas import raw_schema

from conftest import SF_SMALL


def _customers(spark, rows):
    """rows: (id, tier, updated_at, extract_date)."""
    data = [(cid, "Z0", tier, None, dt.datetime.fromisoformat(u), dt.date.fromisoformat(d), None)
            for cid, tier, u, d in rows]
    return spark.createDataFrame(data, raw_schema("customers"))


ROWS = [
    ("A", "BRONZE", "2024-01-01 08:00:00", "2024-01-01"),
    ("B", "SILVER", "2024-01-01 09:00:00", "2024-01-01"),
    ("A", "GOLD", "2024-01-02 10:00:00", "2024-01-02"),
    # stale: extracted late but older than A's open version -> no change
    ("A", "SILVER", "2024-01-02 09:00:00", "2024-01-03"),
    ("A", "PLATINUM", "2024-01-04 07:00:00", "2024-01-04"),
    # B missing from later slices stays open
]


def _norm(df):
    return sorted((r["customer_id"], r["loyalty_tier"], r["dbt_valid_from"], r["dbt_valid_to"])
                  for r in df.collect())


def test_bulk_history_drops_stale_rows_and_chains_versions(spark):
    hist = _norm(history.bulk_history(_customers(spark, ROWS), "customers"))
    t = dt.datetime.fromisoformat
    assert hist == [
        ("A", "BRONZE", t("2024-01-01 08:00:00"), t("2024-01-02 10:00:00")),
        ("A", "GOLD", t("2024-01-02 10:00:00"), t("2024-01-04 07:00:00")),
        ("A", "PLATINUM", t("2024-01-04 07:00:00"), None),
        ("B", "SILVER", t("2024-01-01 09:00:00"), None),
    ]


def test_daily_fold_equals_bulk_build(spark, cfg):
    raw = _customers(spark, ROWS)
    for i in range(4):
        history.snapshot_day(spark, cfg, "customers", dt.date(2024, 1, 1) + dt.timedelta(days=i), raw)
    folded = history.read_history(spark, cfg, "customers", dt.date(2024, 1, 4))
    assert _norm(folded) == _norm(history.bulk_history(raw, "customers"))


def test_fold_equals_bulk_on_derived_extracts(spark, cfg):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    raw = fixtures.with_fixed_loaded_at(fixtures.restaurant_extracts(events)).cache()
    days = sorted(r[0] for r in raw.select("_extract_date").distinct().collect())
    d = days[0]
    while d <= days[-1]:
        history.snapshot_day(spark, cfg, "restaurants", d, raw)
        d += dt.timedelta(days=1)
    folded = history.read_history(spark, cfg, "restaurants", days[-1])
    bulk = history.bulk_history(raw, "restaurants")
    cols = ["restaurant_id", "commission_pct", "dbt_valid_from", "dbt_valid_to", "dbt_scd_id"]
    assert sorted(map(tuple, folded.select(cols).collect())) == sorted(map(tuple, bulk.select(cols).collect()))


def test_history_refuses_out_of_order_days(spark, cfg):
    raw = _customers(spark, ROWS)
    history.snapshot_day(spark, cfg, "customers", dt.date(2024, 1, 1), raw)
    with pytest.raises(history.HistoryOrderError):
        history.snapshot_day(spark, cfg, "customers", dt.date(2024, 1, 3), raw)  # gap
    history.snapshot_day(spark, cfg, "customers", dt.date(2024, 1, 2), raw)
    with pytest.raises(history.HistoryOrderError):
        history.snapshot_day(spark, cfg, "customers", dt.date(2024, 1, 1), raw)  # earlier day
    history.snapshot_day(spark, cfg, "customers", dt.date(2024, 1, 2), raw)  # same day: idempotent re-run
    assert len(_norm(history.read_history(spark, cfg, "customers", dt.date(2024, 1, 2)))) == 3


def test_duplicate_key_in_slice_fails(spark, cfg):
    raw = _customers(spark, [("A", "BRONZE", "2024-01-01 08:00:00", "2024-01-01"),
                             ("A", "GOLD", "2024-01-01 09:00:00", "2024-01-01")])
    with pytest.raises(history.DuplicateKeyError):
        history.snapshot_day(spark, cfg, "customers", dt.date(2024, 1, 1), raw)


def test_dimension_backdates_first_version_and_adds_unknown_member(spark):
    dim = dims.dim_customer(history.bulk_history(_customers(spark, ROWS), "customers"))
    rows = {(r["customer_id"], r["version_number"]): r for r in dim.collect()}
    assert rows[("A", 1)]["valid_from"] == dt.datetime(1900, 1, 1)
    assert rows[("A", 3)]["valid_to"] == dt.datetime(9999, 12, 31, 23, 59, 59)
    assert rows[("A", 3)]["is_current"] and not rows[("A", 1)]["is_current"]
    assert rows[("UNKNOWN", 0)]["customer_key"] == "-1"
    assert dim.where(F.col("customer_key") != "-1").select("customer_key").distinct().count() == 4


def test_dim_date_spine_is_end_exclusive(spark):
    d = dims.dim_date(spark, "2026-01-01", "2028-01-01")
    assert d.count() == 730
    r = d.where(F.col("date_day") == F.lit(dt.date(2026, 1, 4))).first()
    assert (r["date_key"], r["iso_day_of_week"], r["is_weekend"]) == (20260104, 7, True)
