"""The driver contract, and a fast oracle comparison on the smallest folder."""

import decimal
import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry

from conftest import SF_SMALL

FAST = ["stg_orders_latest", "scd2_customers", "dim_restaurant", "dim_date", "fct_orders_full",
        "agg_daily_zone_metrics", "agg_monthly_revenue_by_tier", "dq_summary", "source_freshness",
        "multi_version_customer", "top_zone_days"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "gmv" in df.columns


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 36


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return str(v)


@pytest.mark.parametrize("name", FAST)
def test_matches_duckdb_oracle(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    df = entry.queries()[name](spark, SF_SMALL)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in order) for r in df.collect())
    idx = [ocols.index(c) for c in order]
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == want
