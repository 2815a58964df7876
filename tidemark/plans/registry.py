"""Registered queries (Spark) and their DuckDB oracle SQL, by name."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import WarehouseConfig
from tidemark.operators import checks, facts, history, pit_join, reports
from tidemark.operators.facts import FACT_COLUMNS
from tidemark.plans import oracle as O
from tidemark.plans import pipeline
from tidemark.plans.catalog import Models
from tidemark.plans.concurrency import run_all
from tidemark.session import stored_once, work_dir
from tidemark.sources import fixtures, landing, raw
from tidemark.sources.schemas import HISTORY

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _select(cte: str) -> str:
    return f"SELECT * FROM {cte}"


# ------------------------------------------------------------ core models
@register("stg_orders_latest", O.model_sql(_select("stg_orders")))
def stg_orders_latest(spark, sf_dir):
    return Models(spark, sf_dir).stg_orders


@register("scd2_customers", O.model_sql(_select("snap_customers")))
def scd2_customers(spark, sf_dir):
    return Models(spark, sf_dir).snap_customers


@register("scd2_restaurants", O.model_sql(_select("snap_restaurants")))
def scd2_restaurants(spark, sf_dir):
    return Models(spark, sf_dir).snap_restaurants


@register("dim_customer", O.model_sql(_select("dim_customer")))
def dim_customer(spark, sf_dir):
    return Models(spark, sf_dir).dim_customer


@register("dim_restaurant", O.model_sql(_select("dim_restaurant")))
def dim_restaurant(spark, sf_dir):
    return Models(spark, sf_dir).dim_restaurant


@register("dim_date", O.model_sql(_select("dim_date"), extra=[O.DIM_DATE]))
def dim_date(spark, sf_dir):
    return Models(spark, sf_dir).dim_date


@register("fct_orders_full", O.model_sql(_select("fct_orders")))
def fct_orders_full(spark, sf_dir):
    return Models(spark, sf_dir).fct_orders


@register("fct_orders_bucketed_join", O.model_sql(_select("fct_orders")))
def fct_orders_bucketed_join(spark, sf_dir):
    """The same fact through the large-dimension (dyadic spans) point-in-time join."""
    return Models(spark, sf_dir, strategy="spans").fct_orders


@register("agg_daily_zone_metrics", O.model_sql(_select("agg_daily_zone_metrics"), extra=[O.DAILY]))
def agg_daily_zone_metrics(spark, sf_dir):
    return Models(spark, sf_dir).agg_daily_zone_metrics


@register("agg_monthly_revenue_by_tier",
          O.model_sql(_select("agg_monthly_revenue_by_tier"), extra=[O.MONTHLY]))
def agg_monthly_revenue_by_tier(spark, sf_dir):
    return Models(spark, sf_dir).agg_monthly_revenue_by_tier


# ------------------------------------------------------- stored warehouses

LATE_CHECK = "assert_late_arriving_restaurants_are_resolved"
# The fixtures keep one restaurant that is never listed, so the late-arrival
# check fails from day four on; the simulation records it instead of stopping.
SIMULATION_SEVERITIES = {LATE_CHECK: "warn"}


def _day_range(days: list[_dt.date]) -> list[_dt.date]:
    if not days:
        return []
    lo, hi = min(days), max(days)
    return [lo + _dt.timedelta(days=i) for i in range((hi - lo).days + 1)]


def land_fixtures(spark, sf_dir: str, seeded: bool, name: str) -> WarehouseConfig:
    """Land every derived extract day of ``sf_dir`` (all entities land every day)."""
    cfg = WarehouseConfig(root=work_dir(spark, name))
    ex = fixtures.extracts(Models(spark, sf_dir, seeded).events, seeded)
    landed = run_all({e: (lambda e=e, df=df: landing.write_extracts(spark, cfg, e, df)) for e, df in ex.items()})
    for entity, days in landed.items():
        for d in set(_day_range(sorted({d for of in landed.values() for d in of}))) - set(days):
            landing.mark(spark, cfg, entity, d)  # landed empty
    return cfg


def loaded_raw(spark, sf_dir: str) -> WarehouseConfig:
    """Plain fixtures landed, loaded into raw, then loaded again (idempotent replace)."""
    cfg = land_fixtures(spark, sf_dir, seeded=False, name="raw-load")
    days = landing.complete_days(spark, cfg)
    raw.reconcile(raw.load_days(spark, cfg, days))
    counts = raw.reconcile(raw.load_days(spark, cfg, days))  # re-run: same partitions replaced
    counts.write.mode("overwrite").parquet(f"{cfg.root}/_reports/load_counts")
    return cfg


@register("raw_partition_replace", O.model_sql(f"SELECT {O.LANDING_ORDER_COLS} FROM raw_orders"))
def raw_partition_replace(spark, sf_dir):
    cfg = loaded_raw(spark, sf_dir)
    return raw.read(spark, cfg, "orders").drop("_loaded_at") \
        .select(*[F.col(c) if c not in ("order_ts", "delivered_ts", "updated_at")
                  else F.col(c).cast("timestamp_ntz").alias(c)
                  for c in O.LANDING_ORDER_COLS.split(", ")])


@register("raw_partition_counts", O.model_sql(O.RAW_COUNTS))
def raw_partition_counts(spark, sf_dir):
    cfg = loaded_raw(spark, sf_dir)
    return spark.read.parquet(f"{cfg.root}/_reports/load_counts")


def fold_history(spark, sf_dir: str, entity: str, dense: bool = False):
    """Day-by-day history steps over every extract day (the daily path)."""
    cfg = WarehouseConfig(root=work_dir(spark, f"fold-{entity}"))
    rows = Models(spark, sf_dir).raw[entity]
    if dense:
        rows = fixtures.dense_slices(rows, HISTORY[entity][0])
    raw.replace(spark, cfg, entity, rows)
    days = _day_range(raw.loaded_days(spark, cfg, entity))
    for d in days:
        history.snapshot_day(spark, cfg, entity, d, raw.read_days(spark, cfg, entity, [d]))
    return history.read_history(spark, cfg, entity, days[-1])


@register("scd2_fold_customers", O.model_sql(_select("snap_customers")))
def scd2_fold_customers(spark, sf_dir):
    return fold_history(spark, sf_dir, "customers")


@register("scd2_fold_restaurants", O.model_sql(_select("snap_restaurants")))
def scd2_fold_restaurants(spark, sf_dir):
    return fold_history(spark, sf_dir, "restaurants")


@register("scd2_fold_dense_restaurants", O.model_sql(_select("snap_restaurants")))
def scd2_fold_dense_restaurants(spark, sf_dir):
    """Full daily snapshots (dense slices) give the same history as the sparse log."""
    return fold_history(spark, sf_dir, "restaurants", dense=True)


@register("scd2_fold_dense_customers", O.model_sql(_select("snap_customers")))
def scd2_fold_dense_customers(spark, sf_dir):
    """Full daily customer snapshots give the same history as the sparse log."""
    return fold_history(spark, sf_dir, "customers", dense=True)


def incremental_warehouse(spark, sf_dir: str) -> WarehouseConfig:
    """Seeded fixtures run day by day through the whole pipeline."""
    cfg = land_fixtures(spark, sf_dir, seeded=True, name="daily")
    pipeline.run_range(spark, cfg, landing.complete_days(spark, cfg), severities=SIMULATION_SEVERITIES)
    return cfg


@register("fct_orders_incremental", O.model_sql(_select("fct_orders"), seeded=True))
def fct_orders_incremental(spark, sf_dir):
    cfg = incremental_warehouse(spark, sf_dir)
    return pipeline.read(spark, cfg, "fct_orders").select(*FACT_COLUMNS)


@register("pipeline_daily_zone_metrics",
          O.model_sql(_select("agg_daily_zone_metrics"), seeded=True, extra=[O.DAILY]))
def pipeline_daily_zone_metrics(spark, sf_dir):
    cfg = incremental_warehouse(spark, sf_dir)
    return pipeline.read(spark, cfg, "agg_daily_zone_metrics")


@register("pipeline_monthly_revenue_by_tier",
          O.model_sql(_select("agg_monthly_revenue_by_tier"), seeded=True, extra=[O.MONTHLY]))
def pipeline_monthly_revenue_by_tier(spark, sf_dir):
    cfg = incremental_warehouse(spark, sf_dir)
    return pipeline.read(spark, cfg, "agg_monthly_revenue_by_tier")


@register("pipeline_dim_restaurant", O.model_sql(_select("dim_restaurant"), seeded=True))
def pipeline_dim_restaurant(spark, sf_dir):
    cfg = incremental_warehouse(spark, sf_dir)
    return pipeline.read(spark, cfg, "dim_restaurant")


def stored_fact(spark, sf_dir: str) -> WarehouseConfig:
    """The whole fact, built once and stored partitioned by date."""
    cfg = WarehouseConfig(root=work_dir(spark, "fact"))
    facts.full_refresh(spark, cfg, Models(spark, sf_dir).fct_orders)
    return cfg


@register("fct_lookback_slice", O.model_sql(O.LOOKBACK_SLICE))
def fct_lookback_slice(spark, sf_dir):
    wm = facts.watermark_of(pipeline.store(spark, stored_fact(spark, sf_dir)).snapshot())
    return facts.incremental_source(Models(spark, sf_dir).raw_orders, facts.lookback_cutoff(wm, O.LOOKBACK_DAYS))


@register("fct_full_refresh", O.model_sql(_select("fct_orders")))
def fct_full_refresh(spark, sf_dir):
    """A full refresh replaces a stored fact that also held other dates."""
    cfg = WarehouseConfig(root=work_dir(spark, "refresh"))
    rows = stored_once(Models(spark, sf_dir).fct_orders, "fact-rows")  # for both refreshes
    facts.full_refresh(spark, cfg, rows.withColumn("order_date", F.date_add("order_date", 400)), at_rest=True)
    facts.full_refresh(spark, cfg, rows, at_rest=True)
    return pipeline.read(spark, cfg, "fct_orders").select(*FACT_COLUMNS)


# ----------------------------------------------------------------- checks
def _suite(spark, sf_dir):
    m = Models(spark, sf_dir, materialize=True)
    return checks.standard_suite(m.raw, m.stg_orders, m.dim_customer, m.dim_restaurant, m.dim_date,
                                 m.fct_orders, m.agg_daily_zone_metrics, m.agg_monthly_revenue_by_tier,
                                 O.LOOKBACK_DAYS)


@register("dq_summary", O.dq_summary_sql())
def dq_summary(spark, sf_dir):
    return checks.summary(_suite(spark, sf_dir))


@register("dq_reconcile_fact", O.model_sql(O.RECONCILE.format(stg="stg_orders", fct="fct_orders")))
def dq_reconcile_fact(spark, sf_dir):
    m = Models(spark, sf_dir)
    return checks.fact_reconciles_with_staging(m.stg_orders, m.fct_orders)


@register("dq_unresolved_late", O.model_sql(O.UNRESOLVED.format(fct="fct_orders")))
def dq_unresolved_late(spark, sf_dir):
    m = Models(spark, sf_dir)
    return checks.late_restaurants_unresolved(m.fct_orders, O.LOOKBACK_DAYS)


@register("dq_scd2_overlap", O.model_sql(O.SCD2_OVERLAPS.format(versions="scd2_versions"), extra=[O.SCD2_VERSIONS]))
def dq_scd2_overlap(spark, sf_dir):
    m = Models(spark, sf_dir)
    return checks.scd2_overlaps(checks.scd2_versions(m.dim_customer, m.dim_restaurant))


def _planted(spark, sf_dir) -> dict:
    return fixtures.violations(Models(spark, sf_dir, materialize=True))


@register("dq_summary_planted", O.dq_summary_sql("_bad", O.VIOLATIONS))
def dq_summary_planted(spark, sf_dir):
    """All 31 checks over tables with violations of every kind."""
    t = _planted(spark, sf_dir)
    suite = checks.standard_suite({e: t[f"raw_{e}"] for e in ("orders", "customers", "restaurants")}, t["stg_orders"], t["dim_customer"],
                                  t["dim_restaurant"], t["dim_date"], t["fct_orders"], t["agg_daily_zone_metrics"],
                                  t["agg_monthly_revenue_by_tier"], O.LOOKBACK_DAYS, versions=t["scd2_versions"])
    return checks.summary(suite)


@register("dq_reconcile_planted", O.violations_sql(O.RECONCILE.format(stg="stg_orders_bad", fct="fct_orders_bad")))
def dq_reconcile_planted(spark, sf_dir):
    t = _planted(spark, sf_dir)
    return checks.fact_reconciles_with_staging(t["stg_orders"], t["fct_orders"])


@register("dq_overlap_planted", O.violations_sql(O.SCD2_OVERLAPS.format(versions="scd2_versions_bad")))
def dq_overlap_planted(spark, sf_dir):
    return checks.scd2_overlaps(_planted(spark, sf_dir)["scd2_versions"])


@register("dq_overlap_pairs", O.violations_sql(O.OVERLAP_COUNTS.format(versions="scd2_versions_bad")))
def dq_overlap_pairs(spark, sf_dir):
    """Overlapping pairs of versions, counted by a sweep that forms none."""
    return checks.overlap_pairs(_planted(spark, sf_dir)["scd2_versions"])


def _orders_in_overlaps(spark, sf_dir, strategy: str):
    m = Models(spark, sf_dir, materialize=True)
    versions = fixtures.violations(m)["scd2_versions"].where("dim = 'restaurant'")
    joined = pit_join.point_in_time_join(m.stg_orders, versions.withColumnRenamed("natural_key", "restaurant_id"), "restaurant_id", "order_ts",
                                         {"version_from": "valid_from", "version_to": "valid_to"}, strategy=strategy)
    return joined.select("order_id", "version_from", "version_to")


@register("pit_join_overlapping_broadcast", O.violations_sql(O.OVERLAPPING_JOIN))
def pit_join_overlapping_broadcast(spark, sf_dir):
    """Orders with every version of their restaurant at order time, where versions overlap."""
    return _orders_in_overlaps(spark, sf_dir, "broadcast")


@register("pit_join_overlapping_spans", O.violations_sql(O.OVERLAPPING_JOIN))
def pit_join_overlapping_spans(spark, sf_dir):
    return _orders_in_overlaps(spark, sf_dir, "spans")


@register("source_freshness", O.model_sql(O.FRESHNESS))
def source_freshness(spark, sf_dir):
    m = Models(spark, sf_dir)
    now = _dt.datetime.fromisoformat(O.FRESHNESS_NOW)
    return raw.freshness(m.raw, now, 26, 50)


# ---------------------------------------------------------------- reports
@register("gmv_latest_day", O.report_sql("gmv_latest_day"))
def gmv_latest_day(spark, sf_dir):
    return reports.gmv_latest_day(facts.read_fact(spark, stored_fact(spark, sf_dir)))


@register("orders_last7_one_restaurant", O.report_sql("orders_last7_one_restaurant"))
def orders_last7_one_restaurant(spark, sf_dir):
    return reports.orders_last7_one_restaurant(facts.read_fact(spark, stored_fact(spark, sf_dir)), "7")


@register("net_full_scan", O.report_sql("net_full_scan"))
def net_full_scan(spark, sf_dir):
    return reports.net_full_scan(Models(spark, sf_dir).fct_orders)


@register("multi_version_customer", O.report_sql("multi_version_customer"))
def multi_version_customer(spark, sf_dir):
    return reports.multi_version_customer(Models(spark, sf_dir).dim_customer)


@register("top_zone_days", O.report_sql("top_zone_days"))
def top_zone_days(spark, sf_dir):
    return reports.top_zone_days(Models(spark, sf_dir).agg_daily_zone_metrics)


@register("revenue_by_tier_sorted", O.report_sql("revenue_by_tier_sorted"))
def revenue_by_tier_sorted(spark, sf_dir):
    return reports.revenue_by_tier_sorted(Models(spark, sf_dir).agg_monthly_revenue_by_tier)


@register("unknown_orders_by_day", O.report_sql("unknown_orders_by_day"))
def unknown_orders_by_day(spark, sf_dir):
    return reports.unknown_orders_by_day(Models(spark, sf_dir).fct_orders)


@register("latest_orders", O.report_sql("latest_orders"))
def latest_orders(spark, sf_dir):
    return reports.latest_orders(Models(spark, sf_dir).fct_orders)


@register("pruning_report")
def pruning_report(spark, sf_dir):
    """Bytes a scan must open, flat copy vs date-partitioned fact (no oracle: file sizes)."""
    warehouse = pipeline.store(spark, stored_fact(spark, sf_dir))
    txn = warehouse.begin()
    txn.replace("fct_orders_unpartitioned", txn.read(facts.FACT))
    txn.commit()
    return reports.pruning_report(warehouse.files(facts.FACT), warehouse.files("fct_orders_unpartitioned"))


@register("pruning_rows", O.model_sql(O.PRUNING_ROWS))
def pruning_rows(spark, sf_dir):
    """Dates and rows that the dashboard queries read of the date-partitioned fact."""
    return reports.pruning_rows(facts.read_fact(spark, stored_fact(spark, sf_dir)))


@register("rerun_idempotency", O.model_sql(O.RERUN, seeded=True))
def rerun_idempotency(spark, sf_dir):
    """Re-run the last day of the day-by-day warehouse: (rows, GMV) before == after."""
    cfg = incremental_warehouse(spark, sf_dir)
    last = landing.complete_days(spark, cfg)[-1]
    r = pipeline.rerun_day(spark, cfg, last, severities=SIMULATION_SEVERITIES)
    return spark.createDataFrame(
        [("before", r["before"][0], r["before"][1]), ("after", r["after"][0], r["after"][1])],
        "state string, fct_rows bigint, gmv decimal(18,2)")
