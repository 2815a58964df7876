import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import facts, pit_join
from tidemark.plans import pipeline, registry
from tidemark.plans.catalog import Models
from tidemark.sources import landing, raw

from conftest import SF_SMALL


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_broadcast_and_bucketed_point_in_time_joins_agree(spark):
    m = Models(spark, SF_SMALL)
    cols = ["order_id", "customer_key", "restaurant_key", "customer_tier", "commission_amount"]
    a = facts.fact_rows(m.stg_orders, m.dim_customer, m.dim_restaurant, strategy="broadcast")
    b = facts.fact_rows(m.stg_orders, m.dim_customer, m.dim_restaurant, strategy="spans")
    assert _rows(a, cols) == _rows(b, cols)


def test_bucketed_join_with_many_versions_per_day(spark):
    t = dt.datetime.fromisoformat
    versions = spark.createDataFrame([
        ("k", t("1900-01-01 00:00:00"), t("2024-01-01 10:00:00"), 1),
        ("k", t("2024-01-01 10:00:00"), t("2024-01-01 12:00:00"), 2),
        ("k", t("2024-01-01 12:00:00"), t("2024-01-03 00:00:00"), 3),
        ("k", t("2024-01-03 00:00:00"), t("9999-12-31 23:59:59"), 4),
    ], "key string, valid_from timestamp_ntz, valid_to timestamp_ntz, v int")
    facts_df = spark.createDataFrame([
        (1, "k", t("2023-12-31 08:00:00")), (2, "k", t("2024-01-01 10:00:00")),
        (3, "k", t("2024-01-01 11:59:59")), (4, "k", t("2024-01-02 05:00:00")),
        (5, "k", t("2024-01-03 00:00:00")), (6, "x", t("2024-01-02 00:00:00")),
        (7, None, t("2024-01-02 00:00:00")),
    ], "id int, key string, ts timestamp_ntz")
    for strategy in ("broadcast", "spans"):
        got = dict(pit_join.point_in_time_join(facts_df, versions, "key", "ts", {"v": "v"},
                                               strategy=strategy).select("id", "v").collect())
        assert got == {1: 1, 2: 2, 3: 2, 4: 3, 5: 4, 6: None, 7: None}, strategy


def test_incremental_days_equal_full_build_and_rerun_is_idempotent(spark):
    """Seeded fixtures: bulk back-fill, then two daily runs == one full build."""
    cfg = registry.land_fixtures(spark, SF_SMALL, seeded=True, name="test-daily")
    days = landing.complete_days(spark, cfg)
    sev = registry.SIMULATION_SEVERITIES
    pipeline.bootstrap(spark, cfg, days[-3], severities=sev)
    pipeline.run_day(spark, cfg, days[-2], severities=sev)
    last = pipeline.run_day(spark, cfg, days[-1], severities=sev)
    assert last["fact"]["mode"] == "upsert"
    stored = facts.read_fact(spark, cfg)
    full = Models(spark, SF_SMALL, seeded=True).fct_orders
    cols = ["order_id", "customer_key", "restaurant_key", "status", "net_amount", "commission_amount",
            "updated_at"]
    assert _rows(stored, cols) == _rows(full, cols)

    # Marts rewritten only for touched partitions equal a full rebuild.
    m = Models(spark, SF_SMALL, seeded=True)
    for name, full_mart in (("agg_daily_zone_metrics", m.agg_daily_zone_metrics),
                            ("agg_monthly_revenue_by_tier", m.agg_monthly_revenue_by_tier)):
        published = pipeline.read(spark, cfg, name)
        mcols = sorted(full_mart.columns)
        assert _rows(published, mcols) == _rows(full_mart, mcols), name

    before = stored.agg(F.count(F.lit(1)), F.sum("net_amount")).first()
    rerun = pipeline.run_day(spark, cfg, days[-1], severities=sev, allow_rerun=True, check_scope="touched")
    after = facts.read_fact(spark, cfg).agg(F.count(F.lit(1)), F.sum("net_amount")).first()
    assert tuple(before) == tuple(after)
    assert len(rerun["checks"]) == 31
    failing = {c["check_name"] for c in rerun["checks"] if c["failures"]}
    assert failing <= {"assert_late_arriving_restaurants_are_resolved"}


def test_schema_change_is_refused(spark, cfg):
    import pytest
    m = Models(spark, SF_SMALL)
    facts.full_refresh(spark, cfg, m.fct_orders)
    with pytest.raises(facts.SchemaChangeError):
        facts.upsert(spark, cfg, m.fct_orders.withColumn("extra", F.lit(1)))


def _partition_filters(df) -> str:
    import re
    plan = df._jdf.queryExecution().executedPlan().toString()
    return " ".join(re.findall(r"PartitionFilters: \[[^\]]*\]", plan))


def test_lookback_prefilter_matches_filter_on_full_staging(spark, cfg):
    m = Models(spark, SF_SMALL)
    raw.replace(spark, cfg, "orders", m.raw_orders)
    stored_raw = raw.read(spark, cfg, "orders")
    wm = m.stg_orders.agg(F.max("updated_at")).first()[0]
    cutoff = facts.lookback_cutoff(wm, 3)
    fast = facts.incremental_source(stored_raw, cutoff)
    slow = m.stg_orders.where(F.col("updated_at") >= F.lit(cutoff).cast("timestamp_ntz"))
    assert _rows(fast, ["order_id", "updated_at"]) == _rows(slow, ["order_id", "updated_at"])
    # the cut-off reaches the scan as a partition filter (older days are never read)
    assert "_extract_date" in _partition_filters(fast)


def test_latest_day_report_prunes_partitions_of_the_stored_fact(spark, cfg):
    from tidemark.operators import reports
    facts.full_refresh(spark, cfg, Models(spark, SF_SMALL).fct_orders)
    stored = facts.read_fact(spark, cfg)
    filters = _partition_filters(reports.gmv_latest_day(stored))
    assert "order_date" in filters and "Subquery" in filters


def test_touched_scope_checks_catch_a_duplicate_in_a_touched_partition(spark):
    cfg = registry.land_fixtures(spark, SF_SMALL, seeded=True, name="test-scope")
    days = landing.complete_days(spark, cfg)
    sev = registry.SIMULATION_SEVERITIES
    pipeline.bootstrap(spark, cfg, days[-2], severities=sev)
    run = pipeline.run_day(spark, cfg, days[-1], severities=sev, check_scope="touched")
    touched = run["fact"]["dates"]
    assert touched
    txn = pipeline.store(spark, cfg).begin()
    changed = txn.read(facts.CHANGES).select("order_id").limit(1)
    fct = txn.read(facts.FACT)
    dup = fct.join(changed, "order_id", "left_semi").cache()
    d = dup.first()["order_date"]
    # seed the violation: the same order twice in its partition
    txn.replace_parts(facts.FACT, txn.read(facts.FACT, [d.isoformat()]).unionByName(dup), "order_date")
    result = {r["check_name"]: r["failures"] for r in pipeline.run_checks(
        txn, cfg, days[-1], None, None, sev, scope="touched", touched=touched).collect()}
    assert result["unique_fct_orders_order_id"] == 1
    assert result["assert_fact_reconciles_with_staging"] == 1


def test_full_refresh_replaces_and_upsert_follows_moved_dates(spark, cfg):

    rows = Models(spark, SF_SMALL).fct_orders.limit(40).checkpoint()
    shifted = rows.withColumn("order_date", F.date_add("order_date", 400))
    facts.full_refresh(spark, cfg, shifted)
    facts.full_refresh(spark, cfg, rows)
    assert facts.read_fact(spark, cfg).count() == 40
    facts.upsert(spark, cfg, shifted.orderBy("order_id").limit(3))
    stored = facts.read_fact(spark, cfg)
    assert stored.count() == 40 and stored.select("order_id").distinct().count() == 40
    assert stored.where("order_date > '2024-12-31'").count() == 3


def test_rerun_of_any_earlier_day_leaves_the_same_warehouse(spark):
    """A day folded daily, and one inside the bulk back-fill."""
    cfg = registry.land_fixtures(spark, SF_SMALL, seeded=True, name="test-rerun")
    days = landing.complete_days(spark, cfg)
    sev = registry.SIMULATION_SEVERITIES
    pipeline.bootstrap(spark, cfg, days[-3], severities=sev)
    pipeline.run_day(spark, cfg, days[-2], severities=sev)
    pipeline.run_day(spark, cfg, days[-1], severities=sev)

    def tables():
        out = {}
        for name in ("fct_orders", "dim_customer", "dim_restaurant", "agg_daily_zone_metrics", "agg_monthly_revenue_by_tier"):
            df = pipeline.read(spark, cfg, name)
            out[name] = sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())
        return out

    before = tables()
    for d in (days[-2], days[2]):
        pipeline.run_day(spark, cfg, d, severities=sev, allow_rerun=True)
        assert tables() == before, d


def test_joins_agree_on_overlapping_nested_and_equal_versions(spark):
    import random

    rng, base = random.Random(1), dt.datetime(2020, 1, 1)
    for span in (3, 400):
        versions, times = [], []
        for i in range(150):
            a = base + dt.timedelta(days=rng.uniform(0, span))
            b = a + dt.timedelta(days=rng.choice([0, 0.01, 1, 3, span / 3, span]) * rng.random())
            a = dt.datetime(1900, 1, 1) if rng.random() < 0.15 else a.replace(hour=0, minute=0, second=0, microsecond=0) if rng.random() < 0.2 else a
            b = dt.datetime(9999, 12, 31, 23, 59, 59) if rng.random() < 0.15 else b
            versions.append((rng.choice("abc"), a, b, i))
            versions += [(*versions[-1][:3], 1000 + i)] * (rng.random() < 0.1)
        for i in range(200):
            at_edge = rng.random() < 0.3
            times.append((i, rng.choice("abcd"), rng.choice(versions)[1 + rng.randrange(2)] if at_edge else base + dt.timedelta(days=rng.uniform(-5, span * 1.4))))
        v = spark.createDataFrame(versions, "key string, valid_from timestamp_ntz, valid_to timestamp_ntz, v int")
        f = spark.createDataFrame(times + [(1000, None, base), (1001, "a", None)], "id int, key string, ts timestamp_ntz")
        got = {s: sorted((r["id"], -1 if r["v"] is None else r["v"]) for r in pit_join.point_in_time_join(f, v, "key", "ts", {"v": "v"}, strategy=s).collect())
               for s in ("broadcast", "spans")}
        assert got["broadcast"] == got["spans"] and len(got["spans"]) > 400
        assert pit_join.point_in_time_join(f, v.limit(0), "key", "ts", {"v": "v"}, strategy="spans").where("v IS NULL").count() == 202


def test_spans_tile_every_interval_without_interpreted_lambdas(spark):
    """Spans were cut by nested lambda functions, row by row (38 of 95 task seconds of a day's changes)."""
    from tidemark.operators import pit_join

    days = 40  # 0 to 39: sizes up to 64
    frame = spark.range(days).selectExpr("id AS _start").crossJoin(spark.range(1, days + 1).selectExpr("id AS _end")).where("_start < _end")
    top = pit_join._top(F.lit(days - 1))
    cut = pit_join._spans(frame.withColumn("_top", top))
    assert "lambda" not in cut._jdf.queryExecution().optimizedPlan().toString()
    tiles: dict = {}
    for r in cut.collect():
        first = r["_block"] << r["_level"]
        tiles.setdefault((r["_start"], r["_end"]), []).append((first, first + (1 << r["_level"])))
    assert len(tiles) == days * (days + 1) // 2
    for (start, end), spans in tiles.items():
        spans.sort()
        assert spans[0][0] == start and spans[-1][1] == end
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_full_refresh_computes_its_rows_once(spark, cfg):
    """Range partitioning reads its input for the bounds and again for the rows: the fact was computed for both."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = Models(spark, SF_SMALL).fct_orders.localCheckpoint()
    facts.full_refresh(spark, cfg, rows.mapInArrow(counted, rows.schema))
    assert seen.value == rows.count() == facts.read_fact(spark, cfg).count()
