import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.functions import exprs
from tidemark.operators import staging
from tidemark.sources.schemas import raw_schema


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_golden_rows_keep_latest_version_and_compute_net(spark):
    """Three raw rows -> two staged rows (the reference's unit test)."""
    rows = [
        ("O1", "C1", "R1", ts("2026-01-01 23:50:00"), "OUT_FOR_DELIVERY", 2, Decimal("300.00"),
         Decimal("30.00"), Decimal("25.00"), "UPI", None, ts("2026-01-01 23:58:00"),
         dt.date(2026, 1, 1), ts("2026-01-02 01:00:00")),
        ("O1", "C1", "R1", ts("2026-01-01 23:50:00"), "DELIVERED", 2, Decimal("300.00"),
         Decimal("30.00"), Decimal("25.00"), "UPI", ts("2026-01-02 00:25:00"),
         ts("2026-01-02 00:25:00"), dt.date(2026, 1, 2), ts("2026-01-03 01:00:00")),
        ("O2", "C2", "R1", ts("2026-01-02 13:00:00"), "DELIVERED", 1, Decimal("150.00"),
         Decimal("0.00"), Decimal("0.00"), None, ts("2026-01-02 13:35:00"),
         ts("2026-01-02 13:35:00"), dt.date(2026, 1, 2), ts("2026-01-03 01:00:00")),
    ]
    raw = spark.createDataFrame(rows, raw_schema("orders"))
    out = {r["order_id"]: r for r in staging.stg_orders(raw).collect()}
    assert set(out) == {"O1", "O2"}
    assert (out["O1"]["status"], out["O1"]["is_final"], out["O1"]["net_amount"],
            out["O1"]["payment_method"]) == ("DELIVERED", True, Decimal("295.00"), "UPI")
    assert (out["O2"]["status"], out["O2"]["is_final"], out["O2"]["net_amount"],
            out["O2"]["payment_method"]) == ("DELIVERED", True, Decimal("150.00"), "UNKNOWN")
    assert out["O1"]["order_date"] == dt.date(2026, 1, 1)
    assert out["O1"]["last_extract_date"] == dt.date(2026, 1, 2)


def test_dedup_plan_limits_before_the_shuffle(spark):
    raw = spark.createDataFrame([], raw_schema("orders"))
    plan = staging.stg_orders(raw)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_column_helpers(spark):
    df = spark.createDataFrame(
        [(dt.date(2026, 9, 30), ts("2026-01-01 10:00:59"), ts("2026-01-01 10:02:01"))],
        "d date, a timestamp_ntz, b timestamp_ntz")
    r = df.select(
        exprs.date_key("d").alias("k"),
        exprs.iso_day_of_week("d").alias("dow"),
        exprs.minute_boundaries("a", "b").alias("m"),
        exprs.lookback("a", 3).alias("lb"),
        exprs.surrogate_key(F.lit("C1"), "a").alias("sk"),
    ).first()
    assert r["k"] == 20260930
    assert r["dow"] == 3  # Wednesday
    assert r["m"] == 2  # minute boundaries, not elapsed whole minutes
    assert r["lb"] == ts("2025-12-29 10:00:59")
    assert r["sk"] == hashlib.md5(b"C1-2026-01-01 10:00:59").hexdigest()


def test_surrogate_key_marks_nulls(spark):
    r = spark.range(1).select(exprs.surrogate_key(F.lit(None).cast("string"), F.lit("x")).alias("k")).first()
    assert r["k"] == hashlib.md5(f"{exprs.SURROGATE_NULL_MARKER}-x".encode()).hexdigest()
