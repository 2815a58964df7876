"""Benchmark: headline queries and one daily pipeline run.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line. Each query is executed in full into Spark's ``noop``
sink (no rows collected). ``daily_run`` is the reference's comparable number
(pipeline time per day): a bulk back-fill up to the second-to-last day
(timed as ``backfill_bulk``), then one incremental ``run_day`` for the last
day - load, reconcile, freshness, history step, dimensions, fact upsert,
31 checks, marts.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "stg_orders_latest",
    "scd2_customers",
    "scd2_restaurants",
    "dim_customer",
    "dim_restaurant",
    "fct_orders_full",
    "fct_orders_bucketed_join",
    "agg_daily_zone_metrics",
    "agg_monthly_revenue_by_tier",
    "dq_summary",
    "gmv_latest_day",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tidemark.plans import registry
    from tidemark.plans.pipeline import bootstrap, run_day
    from tidemark.session import build_session
    from tidemark.sources import landing

    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    # Warm the JVM and code generation once on the smallest folder.
    registry.QUERIES["agg_daily_zone_metrics"](spark, "/root/testdata/sf0.001") \
        .write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    cfg = registry.land_fixtures(spark, sf_dir, seeded=False, name="bench")
    days = landing.complete_days(spark, cfg)
    last = days[-1]
    sev = registry.SIMULATION_SEVERITIES
    t0 = time.perf_counter()
    bootstrap(spark, cfg, last - dt.timedelta(days=1), severities=sev)
    times["backfill_bulk"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    run_day(spark, cfg, last, severities=sev)
    times["daily_run"] = round(time.perf_counter() - t0, 3)

    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
