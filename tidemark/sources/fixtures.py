"""Source extracts derived from the driver's ``events`` table.

The reference lands three daily Parquet extracts produced by a simulator.
Here the same shapes and quirks are a deterministic function of ``events``
(rules in FIXTURES.md section 4), written as DataFrame expressions:

* orders: one order per event; its status versions are times in one row, of
  which the last of each calendar day becomes a row, so the whole order extract
  is a map-only job (no shuffle);
* customers / restaurants: sparse change logs; "last row per key and extract
  day" is an aggregation whose partial (map-side) step collapses hot keys
  before the shuffle.

``seeded=True`` gives the variant in which every dimension row arrives at most
one day late (used to show incremental == full refresh).
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import ntz, trunc_second
from tidemark.sources.schemas import LANDING, LOYALTY_TIERS, PAYMENT_METHODS

# Fixed values of the derivation rules.
N_RESTAURANTS = 40
NEVER_LISTED_RESTAURANT = 39
LATE_RESTAURANT = 38
LATE_RESTAURANT_LISTED_FROM = dt.date(2024, 1, 20)
SEED_REASSIGN_BEFORE = dt.date(2024, 1, 19)
SEED_FIRST_DAY = "2024-01-01 00:00:00"
SEED_LATE_RESTAURANT_TS = "2024-01-19 00:00:00"
SEED_LATE_RESTAURANT_EXTRACT = dt.date(2024, 1, 20)
NEVER_LISTED_USER_MOD = (50, 49)
DUPLICATE_EVERY = 331
MISSING_PAYMENT = (500, 7)
DELIVERY_FEES = [0, 25, 35, 49]
CUISINES = ["NORTH_INDIAN", "SOUTH_INDIAN", "CHINESE", "ITALIAN", "BURGERS", "DESSERTS"]
SIGNUP_EPOCH = "2023-01-01 00:00:00"
CREATED_EPOCH = "2023-06-01 00:00:00"


def _ev(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_id").alias("e"), "ts", "user_id", "event_type", "value")


def _minutes(ts: Column, n: Column) -> Column:
    return F.timestamp_add("MINUTE", n, ts)


def _pick(values: list, idx: Column) -> Column:
    """values[idx] for a 0-based index column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _utc(c: Column) -> Column:
    return c.cast("timestamp")


def order_extracts(events: DataFrame, seeded: bool = False) -> DataFrame:
    """All daily order extracts (landing schema, one row per order per extract day)."""
    e = F.col("e")
    order_ts = trunc_second("ts")
    restaurant = e % N_RESTAURANTS
    if seeded:
        restaurant = F.when((restaurant == LATE_RESTAURANT)
                            & (order_ts.cast("date") < F.lit(SEED_REASSIGN_BEFORE)), F.lit(0)) \
            .otherwise(restaurant)
    gross = F.col("value").cast("decimal(10,2)")
    discount = F.when(e % 10 < 3, F.round(gross * F.lit(Decimal("0.15")), 2)) \
        .otherwise(F.lit(Decimal("0.00"))).cast("decimal(10,2)")
    payment = F.when(e % MISSING_PAYMENT[0] == MISSING_PAYMENT[1], F.lit(None).cast("string")) \
        .otherwise(_pick(PAYMENT_METHODS, e % 4))

    base = _ev(events).select(
        e,
        e.cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        restaurant.cast("string").alias("restaurant_id"),
        order_ts.alias("order_ts"),
        (F.lit(1) + e % 5).cast("int").alias("items_count"),
        gross.alias("gross_amount"),
        discount.alias("discount_amount"),
        _pick(DELIVERY_FEES, e % 4).cast("decimal(10,2)").alias("delivery_fee"),
        payment.alias("payment_method"),
    )

    ots = F.col("order_ts")
    cancelled, refunded = e % 25 == 0, e % 50 == 1
    midnight = ots.cast("date").cast("timestamp_ntz")
    refund_at = _minutes(midnight, F.lit(1440) * (F.lit(1) + F.floor(e / 50) % 2) + 540 + e % 720)
    # Versions 1 and 2 are always there, 3 unless the order was cancelled, 4 when it was refunded.
    timed = base.select(
        "*", cancelled.alias("cancelled"), ots.alias("at_1"),
        F.when(cancelled, _minutes(ots, F.lit(2) + e % 9)).otherwise(_minutes(ots, F.lit(8) + e % 8)).alias("at_2"),
        F.when(~cancelled, _minutes(ots, F.lit(18) + e % 8 + e % 36)).alias("at_3"),
        F.when(refunded, refund_at).alias("at_4"),
    )

    def last_of_day(k: int, following: Column | None) -> Column:
        """``k`` when the next version, if any, is of another day (versions are in time order)."""
        return F.when(F.coalesce(F.to_date(following) != F.to_date(f"at_{k}"), F.lit(True)), k)

    # Numbers of versions and no lambda functions, so that Spark compiles it.
    kept = [last_of_day(1, F.col("at_2")),
            last_of_day(2, F.when(~F.col("cancelled"), F.col("at_3")).otherwise(F.col("at_4"))),
            F.when(~F.col("cancelled"), last_of_day(3, F.col("at_4"))),
            F.when(refunded, 4)]
    again = [F.when(e % DUPLICATE_EVERY == 0, k) for k in kept]
    k = F.col("k")
    rows = timed.select("*", F.explode(F.array(*kept, *again)).alias("k")).where(k.isNotNull())
    status = F.when(k == 1, "PLACED").when(k == 3, "DELIVERED").when(k == 4, "REFUNDED") \
        .when(F.col("cancelled"), "CANCELLED").otherwise("OUT_FOR_DELIVERY")
    updated = F.when(k == 1, F.col("at_1")).when(k == 2, F.col("at_2")).when(k == 3, F.col("at_3")).otherwise(F.col("at_4"))
    return rows.withColumn("updated", updated).select(
        "order_id", "customer_id", "restaurant_id",
        _utc(F.col("order_ts")).alias("order_ts"),
        status.alias("status"),
        "items_count", "gross_amount", "discount_amount", "delivery_fee", "payment_method",
        _utc(F.when(k >= 3, F.col("at_3"))).alias("delivered_ts"),
        _utc(F.col("updated")).alias("updated_at"),
        F.to_date(F.col("updated")).alias("_extract_date"),
    )


def _last_per_key_day(rows: DataFrame, key: str, order_cols: list[str], keep: list[str]) -> DataFrame:
    """Last row per (key, extract day) by ``order_cols`` - a max over a struct,
    so the partial aggregate collapses each key map-side before shuffling."""
    fields = order_cols + [c for c in keep if c not in order_cols]
    packed = F.max(F.struct(*[F.col(c) for c in fields])).alias("last")
    return rows.groupBy(key, "_extract_date").agg(packed) \
        .select(key, "_extract_date", *[F.col(f"last.{c}").alias(c) for c in keep])


def customer_extracts(events: DataFrame, seeded: bool = False) -> DataFrame:
    ev = _ev(events)
    e = F.col("e")
    listed = (ev.where((F.col("event_type") == "signup")
                       & (F.col("user_id") % NEVER_LISTED_USER_MOD[0] != NEVER_LISTED_USER_MOD[1]))
              .select(F.col("user_id"), e, trunc_second("ts").alias("updated_at"),
                      F.concat(F.lit("Z"), (e % 8).cast("string")).alias("zone"),
                      _pick(LOYALTY_TIERS, e % 4).alias("loyalty_tier")))
    if seeded:
        first = (ev.where(F.col("user_id") % NEVER_LISTED_USER_MOD[0] != NEVER_LISTED_USER_MOD[1])
                 .select("user_id").distinct()
                 .select("user_id", F.lit(-1).cast("long").alias("e"),
                         ntz(SEED_FIRST_DAY).alias("updated_at"),
                         F.lit("Z0").alias("zone"), F.lit(LOYALTY_TIERS[0]).alias("loyalty_tier")))
        listed = listed.unionByName(first)
    listed = listed.withColumn("_extract_date", F.to_date("updated_at")) \
        .withColumn("customer_id", F.col("user_id").cast("string"))
    last = _last_per_key_day(listed, "customer_id", ["updated_at", "e"],
                             ["updated_at", "zone", "loyalty_tier", "user_id"])
    signup = F.timestamp_add("DAY", (F.col("user_id") % 365).cast("int"),
                             ntz(SIGNUP_EPOCH))
    return last.select(
        "customer_id", "zone", "loyalty_tier",
        _utc(signup).alias("signup_ts"),
        _utc(F.col("updated_at")).alias("updated_at"),
        "_extract_date",
    ).select(*LANDING["customers"].fieldNames())


def restaurant_extracts(events: DataFrame, seeded: bool = False) -> DataFrame:
    ev = _ev(events)
    e = F.col("e")
    rid = e % N_RESTAURANTS
    logged = (ev.where((F.col("event_type") == "error")
                       & (rid != NEVER_LISTED_RESTAURANT)
                       & ~((rid == LATE_RESTAURANT)
                           & (F.col("ts").cast("date") < F.lit(LATE_RESTAURANT_LISTED_FROM))))
              .select(rid.alias("rid"), e, F.col("ts").alias("order_key_ts"),
                      trunc_second("ts").alias("updated_at"),
                      F.date_add(F.col("ts").cast("date"),
                                 F.when(F.floor(e / 40) % 2 == 1, 1).otherwise(0)).alias("_extract_date"),
                      F.concat(F.lit("Z"), (e % 8).cast("string")).alias("zone"),
                      (F.lit(12) + e % 19).cast("decimal(5,2)").alias("commission_pct")))
    if seeded:
        ids = events.sparkSession.range(N_RESTAURANTS - 2).select(F.col("id").alias("rid"))
        early = ids.select("rid", ntz(SEED_FIRST_DAY).alias("t"), F.lit(dt.date(2024, 1, 1)).alias("d"))
        late = ids.sparkSession.range(1).select(
            F.lit(LATE_RESTAURANT).cast("long").alias("rid"), ntz(SEED_LATE_RESTAURANT_TS).alias("t"),
            F.lit(SEED_LATE_RESTAURANT_EXTRACT).alias("d"))
        seeds = early.unionByName(late).select(
            "rid", F.lit(-1).cast("long").alias("e"),
            F.col("t").alias("order_key_ts"), F.col("t").alias("updated_at"),
            F.col("d").alias("_extract_date"), F.lit("Z0").alias("zone"),
            F.lit(Decimal("15.00")).cast("decimal(5,2)").alias("commission_pct"))
        logged = logged.unionByName(seeds)
    logged = logged.withColumn("restaurant_id", F.col("rid").cast("string"))
    last = _last_per_key_day(logged, "restaurant_id", ["order_key_ts", "e"],
                             ["updated_at", "zone", "commission_pct", "rid", "e"])
    e_abs = F.abs(F.col("e"))
    created = F.timestamp_add("DAY", F.col("rid").cast("int"), ntz(CREATED_EPOCH))
    return last.select(
        "restaurant_id",
        F.concat(F.lit("Restaurant "), F.col("restaurant_id")).alias("name"),
        "zone",
        _pick(CUISINES, e_abs % len(CUISINES)).alias("cuisine"),
        "commission_pct",
        (e_abs % 10 != 0).alias("is_active"),
        _utc(created).alias("created_at"),
        _utc(F.col("updated_at")).alias("updated_at"),
        "_extract_date",
    )


EXTRACTS = {
    "orders": order_extracts,
    "customers": customer_extracts,
    "restaurants": restaurant_extracts,
}


def extracts(events: DataFrame, seeded: bool = False) -> dict[str, DataFrame]:
    return {name: build(events, seeded) for name, build in EXTRACTS.items()}


def with_fixed_loaded_at(extract: DataFrame) -> DataFrame:
    """Raw rows as if each day were loaded at 01:00 the next morning.

    The real load stamps ``current_timestamp``; registered queries use this
    fixed rule so their results can be compared with an oracle.
    """
    loaded = F.timestamp_add("HOUR", F.lit(25), F.col("_extract_date").cast("timestamp_ntz"))
    return extract.withColumn("_loaded_at", loaded.cast("timestamp"))


def raw_tables(events: DataFrame, seeded: bool = False) -> dict[str, DataFrame]:
    return {name: with_fixed_loaded_at(df) for name, df in extracts(events, seeded).items()}


def dense_slices(extract: DataFrame, key: str, last_day: dt.date | None = None) -> DataFrame:
    """Full-snapshot variant of a sparse change log.

    Each day D holds every key seen so far with its latest state as of D.
    Rows that are not newer than an earlier row of the key (stale, late rows)
    never become the state. Built per row with ``explode(sequence(..))`` over
    the days the row is the state - output is the size of the dense data.
    """
    from pyspark.sql import Window as W

    w = W.partitionBy(key).orderBy("_extract_date")
    prior = F.max("updated_at").over(w.rowsBetween(W.unboundedPreceding, -1))
    kept = extract.withColumn("_prior", prior) \
        .where(F.col("_prior").isNull() | (F.col("updated_at") > F.col("_prior"))).drop("_prior")
    if last_day is None:  # one scalar aggregate, not the data
        last_day = extract.agg(F.max("_extract_date")).first()[0]
    end = F.lit(last_day)
    nxt = F.lead("_extract_date").over(w)
    spans = kept.withColumn("_until", F.coalesce(F.date_sub(nxt, 1), end))
    return spans.withColumn("_extract_date", F.explode(F.sequence("_extract_date", "_until"))) \
        .drop("_until")


def violations(m) -> dict[str, DataFrame]:
    """The checked tables of ``m`` with planted violations of every kind.

    Rows are chosen by order number, version number, day of month, zone or
    tier; ``m`` has the warehouse models as attributes.
    """
    def by(column: str, n: int, rest: int) -> Column:
        return F.col(column).cast("bigint") % n == rest

    def null_if(df: DataFrame, column: str, cond: Column) -> DataFrame:
        return df.withColumn(column, F.when(cond, F.lit(None)).otherwise(F.col(column)))

    def twice(df: DataFrame, cond) -> DataFrame:
        return df.unionByName(df.where(cond))

    def change(df: DataFrame, column: str, *cases: tuple) -> DataFrame:
        value = F.col(column)
        for cond, new in reversed(cases):
            value = F.when(cond, new).otherwise(value)
        return df.withColumn(column, value.cast(df.schema[column].dataType))

    version = F.col("version_number")
    out = {}
    number = F.col("order_id").cast("bigint")
    orders = m.raw["orders"].withColumn("e", number)
    out["raw_orders"] = null_if(null_if(orders, "order_id", F.col("e") % 101 == 3), "updated_at", F.col("e") % 103 == 4).drop("e")
    out["raw_customers"] = null_if(m.raw["customers"], "customer_id", by("customer_id", 10, 1))
    out["raw_restaurants"] = null_if(m.raw["restaurants"], "restaurant_id", F.col("restaurant_id") == "7")
    stg = twice(m.stg_orders, by("order_id", 211, 7)).withColumn("e", number)
    stg = change(stg, "status", (F.col("e") % 401 == 13, F.lit("LOST")), (F.col("e") % 409 == 17, F.lit("BROKEN")))
    stg = change(stg, "net_amount", (F.col("e") % 503 == 19, -1 - F.col("net_amount")))
    out["stg_orders"] = null_if(stg, "order_id", F.col("e") % 307 == 11).drop("e")
    customer = twice(m.dim_customer, "version_number = 2")
    customer = null_if(null_if(customer, "customer_key", version == 3), "customer_id", version == 4)
    out["dim_customer"] = change(customer, "loyalty_tier", (version == 5, F.lit("VIP")), (version == 6, F.lit("IRON")))
    restaurant = null_if(twice(m.dim_restaurant, "version_number = 2"), "restaurant_key", version == 3)
    out["dim_restaurant"] = change(restaurant, "commission_pct", (version == 4, F.lit(75)), (version == 5, F.lit(-1)))
    out["dim_date"] = null_if(twice(m.dim_date, "day_of_month = 3").where("day_of_month <> 5"), "date_key", F.col("day_of_month") == 4)
    e = F.col("e")
    fct = twice(m.fct_orders, by("order_id", 211, 8)).withColumn("e", number).where(e % 601 != 21)
    fct = change(fct, "customer_key", (e % 311 == 3, F.lit(None)), (e % 313 == 5, F.lit("nope")))
    fct = change(fct, "restaurant_key", (e % 317 == 6, F.lit(None)), (e % 331 == 7, F.lit("nope")))
    fct = change(fct, "net_amount", (e % 503 == 20, -1 - F.col("net_amount")))
    out["fct_orders"] = null_if(fct, "order_id", e % 307 == 12).drop("e")
    out["agg_daily_zone_metrics"] = change(twice(m.agg_daily_zone_metrics, "zone = 'Z3'"), "sla_hit_rate",
                                           (F.col("zone") == "Z4", F.lit(1.5)), (F.col("zone") == "Z5", F.lit(-0.5)))
    out["agg_monthly_revenue_by_tier"] = twice(m.agg_monthly_revenue_by_tier, "loyalty_tier = 'GOLD'")
    both = [d.where(version > 0).select(F.lit(n).alias("dim"), F.col(f"{n}_id").alias("natural_key"), "valid_from", "valid_to", "version_number", "is_current")
            for n, d in (("customer", m.dim_customer), ("restaurant", m.dim_restaurant))]
    longer = F.when((version % 3 == 1) & ~F.col("is_current"), F.timestamp_add("DAY", F.lit(10), F.col("valid_to"))).otherwise(F.col("valid_to"))
    out["scd2_versions"] = both[0].unionByName(both[1]).withColumn("valid_to", longer).drop("version_number", "is_current")
    return out
