"""Independent DuckDB formulations of the registered queries (correctness oracle).

Each query is plain SQL over the driver's pre-registered ``events`` view:
the derived extracts are written with UNION ALL / QUALIFY instead of the
array and aggregate forms used on Spark, and the fact uses the literal
range join of the reference model, so the two sides share no code.
"""

from __future__ import annotations

LOOKBACK_DAYS = 3

# ---------------------------------------------------------------- extracts
_EV = "ev AS (SELECT event_id AS e, ts, user_id, event_type, value FROM events)"


def _orders(seeded: bool) -> str:
    rid = "e % 40"
    if seeded:
        rid = ("CASE WHEN e % 40 = 38 AND CAST(date_trunc('second', ts) AS DATE) < DATE '2024-01-19' "
               "THEN 0 ELSE e % 40 END")
    return f"""
o_base AS (
  SELECT e,
    CAST(e AS VARCHAR) AS order_id,
    CAST(user_id AS VARCHAR) AS customer_id,
    CAST({rid} AS VARCHAR) AS restaurant_id,
    CAST(date_trunc('second', ts) AS TIMESTAMP) AS order_ts,
    CAST(1 + e % 5 AS INTEGER) AS items_count,
    CAST(value AS DECIMAL(10,2)) AS gross_amount,
    CAST(CASE WHEN e % 10 < 3 THEN round(CAST(value AS DECIMAL(10,2)) * 0.15, 2) ELSE 0 END
         AS DECIMAL(10,2)) AS discount_amount,
    CAST(CASE e % 4 WHEN 0 THEN 0 WHEN 1 THEN 25 WHEN 2 THEN 35 ELSE 49 END AS DECIMAL(10,2)) AS delivery_fee,
    CASE WHEN e % 500 = 7 THEN NULL
         ELSE CASE e % 4 WHEN 0 THEN 'UPI' WHEN 1 THEN 'CARD' WHEN 2 THEN 'COD' ELSE 'WALLET' END
    END AS payment_method
  FROM ev
),
o_ver AS (
  SELECT *, 1 AS seq, 'PLACED' AS st, order_ts AS upd, CAST(NULL AS TIMESTAMP) AS deliv FROM o_base
  UNION ALL
  SELECT *, 2, CASE WHEN e % 25 = 0 THEN 'CANCELLED' ELSE 'OUT_FOR_DELIVERY' END,
         order_ts + to_minutes(CAST(CASE WHEN e % 25 = 0 THEN 2 + e % 9 ELSE 8 + e % 8 END AS INTEGER)),
         CAST(NULL AS TIMESTAMP)
  FROM o_base
  UNION ALL
  SELECT *, 3, 'DELIVERED', order_ts + to_minutes(CAST(18 + e % 8 + e % 36 AS INTEGER)),
         order_ts + to_minutes(CAST(18 + e % 8 + e % 36 AS INTEGER))
  FROM o_base WHERE e % 25 <> 0
  UNION ALL
  SELECT *, 4, 'REFUNDED',
         CAST(CAST(order_ts AS DATE) AS TIMESTAMP)
           + to_minutes(CAST(1440 * (1 + (e // 50) % 2) + 540 + e % 720 AS INTEGER)),
         order_ts + to_minutes(CAST(18 + e % 8 + e % 36 AS INTEGER))
  FROM o_base WHERE e % 50 = 1
),
o_day AS (
  SELECT * FROM o_ver
  QUALIFY row_number() OVER (PARTITION BY e, CAST(upd AS DATE) ORDER BY seq DESC) = 1
),
o_emit AS (
  SELECT * FROM o_day UNION ALL SELECT * FROM o_day WHERE e % 331 = 0
),
raw_orders AS (
  SELECT order_id, customer_id, restaurant_id, order_ts, st AS status, items_count, gross_amount,
         discount_amount, delivery_fee, payment_method, deliv AS delivered_ts, upd AS updated_at,
         CAST(upd AS DATE) AS _extract_date,
         CAST(CAST(upd AS DATE) AS TIMESTAMP) + INTERVAL 25 HOUR AS _loaded_at
  FROM o_emit
)"""


def _customers(seeded: bool) -> str:
    seed = ""
    if seeded:
        seed = """
  UNION ALL
  SELECT DISTINCT user_id, CAST(-1 AS BIGINT), TIMESTAMP '2024-01-01 00:00:00', 'Z0', 'BRONZE'
  FROM ev WHERE user_id % 50 <> 49"""
    return f"""
c_log AS (
  SELECT user_id, e, CAST(date_trunc('second', ts) AS TIMESTAMP) AS updated_at,
         'Z' || CAST(e % 8 AS VARCHAR) AS zone,
         CASE e % 4 WHEN 0 THEN 'BRONZE' WHEN 1 THEN 'SILVER' WHEN 2 THEN 'GOLD' ELSE 'PLATINUM' END AS loyalty_tier
  FROM ev WHERE event_type = 'signup' AND user_id % 50 <> 49{seed}
),
raw_customers AS (
  SELECT CAST(user_id AS VARCHAR) AS customer_id, zone, loyalty_tier,
         TIMESTAMP '2023-01-01 00:00:00' + to_days(CAST(user_id % 365 AS INTEGER)) AS signup_ts,
         updated_at, CAST(updated_at AS DATE) AS _extract_date,
         CAST(CAST(updated_at AS DATE) AS TIMESTAMP) + INTERVAL 25 HOUR AS _loaded_at
  FROM c_log
  QUALIFY row_number() OVER (PARTITION BY user_id, CAST(updated_at AS DATE)
                             ORDER BY updated_at DESC, e DESC) = 1
)"""


def _restaurants(seeded: bool) -> str:
    seed = ""
    if seeded:
        seed = """
  UNION ALL
  SELECT range, CAST(-1 AS BIGINT), TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-01 00:00:00',
         DATE '2024-01-01', 'Z0', CAST(15 AS DECIMAL(5,2)) FROM range(38)
  UNION ALL
  SELECT 38, CAST(-1 AS BIGINT), TIMESTAMP '2024-01-19 00:00:00', TIMESTAMP '2024-01-19 00:00:00',
         DATE '2024-01-20', 'Z0', CAST(15 AS DECIMAL(5,2))"""
    return f"""
r_log AS (
  SELECT e % 40 AS rid, e, ts AS kts, CAST(date_trunc('second', ts) AS TIMESTAMP) AS updated_at,
         CAST(ts AS DATE) + CAST(CASE WHEN (e // 40) % 2 = 1 THEN 1 ELSE 0 END AS INTEGER) AS _extract_date,
         'Z' || CAST(e % 8 AS VARCHAR) AS zone, CAST(12 + e % 19 AS DECIMAL(5,2)) AS commission_pct
  FROM ev
  WHERE event_type = 'error' AND e % 40 <> 39
    AND NOT (e % 40 = 38 AND CAST(ts AS DATE) < DATE '2024-01-20'){seed}
),
raw_restaurants AS (
  SELECT CAST(rid AS VARCHAR) AS restaurant_id, 'Restaurant ' || CAST(rid AS VARCHAR) AS name, zone,
         CASE abs(e) % 6 WHEN 0 THEN 'NORTH_INDIAN' WHEN 1 THEN 'SOUTH_INDIAN' WHEN 2 THEN 'CHINESE'
              WHEN 3 THEN 'ITALIAN' WHEN 4 THEN 'BURGERS' ELSE 'DESSERTS' END AS cuisine,
         commission_pct, abs(e) % 10 <> 0 AS is_active,
         TIMESTAMP '2023-06-01 00:00:00' + to_days(CAST(rid AS INTEGER)) AS created_at,
         updated_at, _extract_date,
         CAST(_extract_date AS TIMESTAMP) + INTERVAL 25 HOUR AS _loaded_at
  FROM r_log
  QUALIFY row_number() OVER (PARTITION BY rid, _extract_date ORDER BY kts DESC, e DESC) = 1
)"""


# ----------------------------------------------------------------- models
STG = """
stg_orders AS (
  SELECT order_id, customer_id, restaurant_id, order_ts, CAST(order_ts AS DATE) AS order_date, status,
         status IN ('DELIVERED', 'CANCELLED', 'REFUNDED') AS is_final,
         items_count, gross_amount, discount_amount, delivery_fee,
         CAST(gross_amount - discount_amount + delivery_fee AS DECIMAL(12,2)) AS net_amount,
         coalesce(payment_method, 'UNKNOWN') AS payment_method,
         delivered_ts, updated_at, _extract_date AS last_extract_date
  FROM raw_orders
  QUALIFY row_number() OVER (PARTITION BY order_id
                             ORDER BY updated_at DESC, _loaded_at DESC, _extract_date DESC) = 1
)"""


def _history(name: str, source: str, key: str, attrs: list[str]) -> str:
    a = ", ".join(attrs)
    return f"""
{name} AS (
  SELECT {key}, {a}, updated_at,
         md5(coalesce(CAST({key} AS VARCHAR), '') || '|' || coalesce(CAST(updated_at AS VARCHAR), '')) AS dbt_scd_id,
         updated_at AS dbt_updated_at,
         updated_at AS dbt_valid_from,
         lead(updated_at) OVER (PARTITION BY {key} ORDER BY updated_at) AS dbt_valid_to
  FROM (
    SELECT *, max(updated_at) OVER (PARTITION BY {key} ORDER BY _extract_date
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_max
    FROM {source}
  ) WHERE prior_max IS NULL OR updated_at > prior_max
)"""


C_ATTRS = ["zone", "loyalty_tier", "signup_ts"]
R_ATTRS = ["name", "zone", "cuisine", "commission_pct", "is_active", "created_at"]
HIST_C = _history("snap_customers", "raw_customers", "customer_id", C_ATTRS)
HIST_R = _history("snap_restaurants", "raw_restaurants", "restaurant_id", R_ATTRS)

def _dimension(name: str, source: str, key: str, surrogate: str, columns: str, unknown: str) -> str:
    """Versions counted from the raw change rows themselves, and the unknown member beside them.

    A change counts when no earlier extract held one as new; its number is how
    many changes of the key are not newer, its end the next newer one.
    """
    return f"""
{name}_changes AS (
  SELECT r.* FROM {source} r
  WHERE NOT EXISTS (SELECT 1 FROM {source} p
                    WHERE p.{key} = r.{key} AND p._extract_date < r._extract_date AND p.updated_at >= r.updated_at)),
{name}_numbered AS (
  SELECT c.*, (SELECT count(*) FROM {name}_changes e WHERE e.{key} = c.{key} AND e.updated_at <= c.updated_at) AS nth,
         (SELECT min(e.updated_at) FROM {name}_changes e WHERE e.{key} = c.{key} AND e.updated_at > c.updated_at) AS until
  FROM {name}_changes c),
{name} AS (
  SELECT md5(concat_ws('-', {key}, updated_at)) AS {surrogate}, {columns}, nth::INTEGER AS version_number,
         if(nth = 1, TIMESTAMP '1900-01-01', updated_at) AS valid_from,
         ifnull(until, TIMESTAMP '9999-12-31 23:59:59') AS valid_to, until IS NULL AS is_current
  FROM {name}_numbered
  UNION ALL BY NAME
  SELECT '-1' AS {surrogate}, {unknown}, 0 AS version_number, TIMESTAMP '1900-01-01' AS valid_from,
         TIMESTAMP '9999-12-31 23:59:59' AS valid_to, true AS is_current
)"""


DIM_C = _dimension("dim_customer", "raw_customers", "customer_id", "customer_key", "customer_id, zone, loyalty_tier, signup_ts",
                   "'UNKNOWN' AS customer_id, 'UNKNOWN' AS zone, 'UNKNOWN' AS loyalty_tier")
DIM_R = _dimension("dim_restaurant", "raw_restaurants", "restaurant_id", "restaurant_key",
                   "restaurant_id, name, zone, cuisine, commission_pct, is_active, created_at",
                   "'UNKNOWN' AS restaurant_id, 'UNKNOWN' AS name, 'UNKNOWN' AS zone, 'UNKNOWN' AS cuisine")


def _fct() -> str:
    """Each order with the last version that began by its time, found by as-of joins."""
    return """
placed AS (
  SELECT o.*, c.customer_key AS c_key, c.loyalty_tier AS tier, r.restaurant_key AS r_key, r.zone AS r_zone, r.commission_pct AS pct
  FROM stg_orders o
  ASOF LEFT JOIN (FROM dim_customer WHERE version_number > 0) c ON c.customer_id = o.customer_id AND o.order_ts >= c.valid_from
  ASOF LEFT JOIN (FROM dim_restaurant WHERE version_number > 0) r ON r.restaurant_id = o.restaurant_id AND o.order_ts >= r.valid_from),
fct_orders AS (
  SELECT order_id, order_date, strftime(order_date, '%Y%m%d')::INTEGER AS date_key,
         ifnull(c_key, '-1') AS customer_key, ifnull(r_key, '-1') AS restaurant_key, customer_id, restaurant_id,
         r_zone AS restaurant_zone, tier AS customer_tier, order_ts, status, is_final, payment_method, items_count,
         gross_amount, discount_amount, delivery_fee, net_amount, pct AS commission_pct,
         round(net_amount * pct * 0.01, 2)::DECIMAL(18,2) AS commission_amount, delivered_ts,
         ((epoch(date_trunc('minute', delivered_ts)) - epoch(date_trunc('minute', order_ts))) / 60)::INTEGER AS delivery_minutes,
         updated_at
  FROM placed)"""


FCT = _fct()

# One group per date and zone over settled orders; each measure filters its statuses.
DAILY = """
settled AS (
  SELECT *, coalesce(restaurant_zone, 'UNKNOWN') AS zone FROM fct_orders WHERE is_final),
agg_daily_zone_metrics AS (
  SELECT order_date, zone, count(*) AS orders,
         count(*) FILTER (status = 'DELIVERED') AS delivered_orders,
         count(*) FILTER (status = 'CANCELLED') AS cancelled_orders,
         count(*) FILTER (status = 'REFUNDED') AS refunded_orders,
         CAST(coalesce(sum(net_amount) FILTER (status = 'DELIVERED'), 0) AS DECIMAL(18,2)) AS gmv,
         CAST(coalesce(sum(commission_amount) FILTER (status = 'DELIVERED'), 0) AS DECIMAL(18,2)) AS commission_revenue,
         avg(delivery_minutes) FILTER (status IN ('DELIVERED', 'REFUNDED')) AS avg_delivery_minutes,
         count(*) FILTER (status IN ('DELIVERED', 'REFUNDED') AND delivery_minutes <= 40)
           / nullif(count(*) FILTER (status IN ('DELIVERED', 'REFUNDED')), 0)::DOUBLE AS sla_hit_rate
  FROM settled GROUP BY order_date, zone
)"""

MONTHLY = """
agg_monthly_revenue_by_tier AS (
  SELECT CAST(date_trunc('month', order_date) AS DATE) AS month,
         coalesce(customer_tier, 'UNKNOWN') AS loyalty_tier,
         count(*) AS delivered_orders,
         CAST(sum(net_amount) AS DECIMAL(18,2)) AS gmv,
         count(DISTINCT customer_id) AS active_customers
  FROM fct_orders WHERE status = 'DELIVERED'
  GROUP BY 1, 2
)"""

DIM_DATE = """
dim_date AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key,
         d AS date_day, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS iso_day_of_week,
         isodow(d) >= 6 AS is_weekend
  FROM (
    SELECT CAST(unnest(generate_series(
             CAST(date_trunc('year', min(order_date)) AS DATE),
             CAST(date_trunc('year', max(order_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE),
             INTERVAL 1 DAY)) AS DATE) AS d
    FROM stg_orders
  )
)"""


def with_ctes(parts: list[str], body: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + body


def base_parts(seeded: bool = False) -> list[str]:
    return [_EV, _orders(seeded), _customers(seeded), _restaurants(seeded), STG,
            HIST_C, HIST_R, DIM_C, DIM_R, FCT]


def model_sql(body: str, seeded: bool = False, extra: list[str] | None = None) -> str:
    return with_ctes(base_parts(seeded) + (extra or []), body)


# ------------------------------------------------------------ raw layer
LANDING_ORDER_COLS = ("order_id, customer_id, restaurant_id, order_ts, status, items_count, gross_amount, "
                      "discount_amount, delivery_fee, payment_method, delivered_ts, updated_at, _extract_date")

# Every entity lands on every day of the extract period, with or without rows.
RAW_COUNTS = """
SELECT * FROM (WITH landed AS (
  SELECT 'orders' AS entity, _extract_date AS extract_date FROM raw_orders
  UNION ALL SELECT 'customers', _extract_date FROM raw_customers
  UNION ALL SELECT 'restaurants', _extract_date FROM raw_restaurants),
period AS (
  SELECT CAST(unnest(generate_series(min(extract_date), max(extract_date), INTERVAL 1 DAY)) AS DATE) AS extract_date
  FROM landed)
SELECT e.entity, p.extract_date, count(l.entity) AS file_rows, count(l.entity) AS loaded_rows, true AS ok
FROM period p CROSS JOIN (VALUES ('orders'), ('customers'), ('restaurants')) AS e(entity)
LEFT JOIN landed l ON l.entity = e.entity AND l.extract_date = p.extract_date
GROUP BY 1, 2)"""

LOOKBACK_SLICE = f"""
SELECT * FROM stg_orders
WHERE updated_at >= (SELECT max(updated_at) - INTERVAL {LOOKBACK_DAYS} DAY FROM fct_orders)"""

FRESHNESS_NOW = "2024-02-03 06:00:00"
FRESHNESS = f"""
SELECT source, max_loaded_at,
       date_diff('second', max_loaded_at, TIMESTAMP '{FRESHNESS_NOW}') / 3600.0 AS age_hours,
       CASE WHEN max_loaded_at IS NULL
              OR date_diff('second', max_loaded_at, TIMESTAMP '{FRESHNESS_NOW}') / 3600.0 > 50 THEN 'error'
            WHEN date_diff('second', max_loaded_at, TIMESTAMP '{FRESHNESS_NOW}') / 3600.0 > 26 THEN 'warn'
            ELSE 'pass' END AS status
FROM (
  SELECT 'orders' AS source, max(_loaded_at) AS max_loaded_at FROM raw_orders
  UNION ALL SELECT 'customers', max(_loaded_at) FROM raw_customers
  UNION ALL SELECT 'restaurants', max(_loaded_at) FROM raw_restaurants
)"""

# ------------------------------------------------------------- checks
SCD2_VERSIONS = """
scd2_versions AS (
  SELECT 'customer' AS dim, customer_id AS natural_key, valid_from, valid_to
  FROM dim_customer WHERE customer_key <> '-1'
  UNION ALL
  SELECT 'restaurant', restaurant_id, valid_from, valid_to
  FROM dim_restaurant WHERE restaurant_key <> '-1'
)"""

# One row per version that starts strictly inside an earlier version of its key.
SCD2_OVERLAPS = """
SELECT dim, natural_key, a_from AS valid_from, valid_from AS overlapping_from
FROM (
  SELECT b.dim, b.natural_key, b.valid_from,
         (SELECT arg_max(a.valid_from, a.valid_to) FROM {versions} a
          WHERE a.dim = b.dim AND a.natural_key = b.natural_key AND a.valid_from < b.valid_from) AS a_from,
         (SELECT max(a.valid_to) FROM {versions} a
          WHERE a.dim = b.dim AND a.natural_key = b.natural_key AND a.valid_from < b.valid_from) AS a_to
  FROM {versions} b
) WHERE a_to > valid_from"""

# Totals per date of both sides, side by side; one row when they do not add up to the same.
RECONCILE = """
SELECT sum(ifnull(s.n, 0))::BIGINT AS stg_rows, sum(ifnull(f.n, 0))::BIGINT AS fct_rows,
       sum(s.gross)::DECIMAL(18,2) AS stg_gross, sum(f.gross)::DECIMAL(18,2) AS fct_gross
FROM (SELECT order_date, count(*) AS n, sum(gross_amount) AS gross FROM {stg} GROUP BY ALL) s
FULL JOIN (SELECT order_date, count(*) AS n, sum(gross_amount) AS gross FROM {fct} GROUP BY ALL) f USING (order_date)
HAVING stg_rows IS DISTINCT FROM fct_rows OR stg_gross IS DISTINCT FROM fct_gross"""

UNRESOLVED = """
SELECT order_id, order_date, restaurant_id FROM {fct}
WHERE restaurant_key = '-1' AND order_date < (SELECT max(order_date) - %d FROM {fct})""" % LOOKBACK_DAYS


def _dq_rows(t: dict[str, str]) -> list[tuple[str, str]]:
    """(check, SQL of its failing rows) over the tables named by ``t``."""
    nn = "SELECT 1 FROM {t} WHERE {c} IS NULL"
    uq = "SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
    rel = ("SELECT 1 FROM {t} c WHERE c.{c} IS NOT NULL AND NOT EXISTS "
           "(SELECT 1 FROM {p} p WHERE p.{f} = c.{c})")
    return [
        ("source_not_null_orders_order_id", nn.format(t=t["raw_orders"], c="order_id")),
        ("source_not_null_orders_updated_at", nn.format(t=t["raw_orders"], c="updated_at")),
        ("source_not_null_customers_customer_id", nn.format(t=t["raw_customers"], c="customer_id")),
        ("source_not_null_restaurants_restaurant_id", nn.format(t=t["raw_restaurants"], c="restaurant_id")),
        ("unique_stg_orders_order_id", uq.format(t=t["stg_orders"], c="order_id")),
        ("not_null_stg_orders_order_id", nn.format(t=t["stg_orders"], c="order_id")),
        ("accepted_values_stg_orders_status",
         f"SELECT status FROM {t['stg_orders']} WHERE status NOT IN "
         "('PLACED','OUT_FOR_DELIVERY','DELIVERED','CANCELLED','REFUNDED') GROUP BY 1"),
        ("expression_is_true_stg_orders_net_amount", f"SELECT 1 FROM {t['stg_orders']} WHERE NOT (net_amount >= 0)"),
        ("unique_dim_customer_customer_key", uq.format(t=t["dim_customer"], c="customer_key")),
        ("not_null_dim_customer_customer_key", nn.format(t=t["dim_customer"], c="customer_key")),
        ("not_null_dim_customer_customer_id", nn.format(t=t["dim_customer"], c="customer_id")),
        ("accepted_values_dim_customer_loyalty_tier",
         f"SELECT loyalty_tier FROM {t['dim_customer']} WHERE loyalty_tier NOT IN "
         "('BRONZE','SILVER','GOLD','PLATINUM','UNKNOWN') GROUP BY 1"),
        ("unique_dim_restaurant_restaurant_key", uq.format(t=t["dim_restaurant"], c="restaurant_key")),
        ("not_null_dim_restaurant_restaurant_key", nn.format(t=t["dim_restaurant"], c="restaurant_key")),
        ("accepted_range_dim_restaurant_commission_pct",
         f"SELECT 1 FROM {t['dim_restaurant']} WHERE commission_pct < 0 OR commission_pct > 50"),
        ("unique_dim_date_date_key", uq.format(t=t["dim_date"], c="date_key")),
        ("not_null_dim_date_date_key", nn.format(t=t["dim_date"], c="date_key")),
        ("unique_fct_orders_order_id", uq.format(t=t["fct_orders"], c="order_id")),
        ("not_null_fct_orders_order_id", nn.format(t=t["fct_orders"], c="order_id")),
        ("relationships_fct_orders_date_key", rel.format(t=t["fct_orders"], c="date_key", p=t["dim_date"], f="date_key")),
        ("not_null_fct_orders_customer_key", nn.format(t=t["fct_orders"], c="customer_key")),
        ("relationships_fct_orders_customer_key",
         rel.format(t=t["fct_orders"], c="customer_key", p=t["dim_customer"], f="customer_key")),
        ("not_null_fct_orders_restaurant_key", nn.format(t=t["fct_orders"], c="restaurant_key")),
        ("relationships_fct_orders_restaurant_key",
         rel.format(t=t["fct_orders"], c="restaurant_key", p=t["dim_restaurant"], f="restaurant_key")),
        ("expression_is_true_fct_orders_net_amount", f"SELECT 1 FROM {t['fct_orders']} WHERE NOT (net_amount >= 0)"),
        ("unique_combination_agg_daily_zone_metrics",
         f"SELECT order_date, zone FROM {t['agg_daily_zone_metrics']} GROUP BY 1, 2 HAVING count(*) > 1"),
        ("accepted_range_agg_daily_zone_metrics_sla_hit_rate",
         f"SELECT 1 FROM {t['agg_daily_zone_metrics']} WHERE sla_hit_rate < 0 OR sla_hit_rate > 1"),
        ("unique_combination_agg_monthly_revenue_by_tier",
         f"SELECT month, loyalty_tier FROM {t['agg_monthly_revenue_by_tier']} GROUP BY 1, 2 HAVING count(*) > 1"),
        ("assert_fact_reconciles_with_staging", RECONCILE.format(stg=t["stg_orders"], fct=t["fct_orders"])),
        ("assert_late_arriving_restaurants_are_resolved", UNRESOLVED.format(fct=t["fct_orders"])),
        ("assert_scd2_versions_do_not_overlap", SCD2_OVERLAPS.format(versions=t["scd2_versions"])),
    ]


CHECKED = ("raw_orders", "raw_customers", "raw_restaurants", "stg_orders", "dim_customer", "dim_restaurant", "dim_date", "fct_orders",
           "agg_daily_zone_metrics", "agg_monthly_revenue_by_tier", "scd2_versions")


def dq_summary_sql(suffix: str = "", extra: list[str] | None = None) -> str:
    rows = _dq_rows({n: n + suffix for n in CHECKED})
    body = "\nUNION ALL\n".join(f"SELECT '{n}' AS check_name, 'error' AS severity, (SELECT count(*) FROM ({q})) AS failures" for n, q in rows)
    return model_sql(body, extra=[DIM_DATE, DAILY, MONTHLY, SCD2_VERSIONS, *(extra or [])])


# Every checked table with planted violations of every kind (the rules of fixtures.violations).
VIOLATIONS = [
    """raw_orders_bad AS (
  SELECT * REPLACE (if(CAST(order_id AS BIGINT) % 101 = 3, NULL, order_id) AS order_id,
                    if(CAST(order_id AS BIGINT) % 103 = 4, NULL, updated_at) AS updated_at) FROM raw_orders)""",
    "raw_customers_bad AS (SELECT * REPLACE (if(CAST(customer_id AS BIGINT) % 10 = 1, NULL, customer_id) AS customer_id) FROM raw_customers)",
    "raw_restaurants_bad AS (SELECT * REPLACE (if(restaurant_id = '7', NULL, restaurant_id) AS restaurant_id) FROM raw_restaurants)",
    """stg_orders_bad AS (
  SELECT * REPLACE (if(CAST(order_id AS BIGINT) % 307 = 11, NULL, order_id) AS order_id,
                    CASE WHEN CAST(order_id AS BIGINT) % 401 = 13 THEN 'LOST' WHEN CAST(order_id AS BIGINT) % 409 = 17 THEN 'BROKEN' ELSE status END AS status,
                    if(CAST(order_id AS BIGINT) % 503 = 19, -1 - net_amount, net_amount) AS net_amount)
  FROM (FROM stg_orders UNION ALL FROM stg_orders WHERE CAST(order_id AS BIGINT) % 211 = 7))""",
    """dim_customer_bad AS (
  SELECT * REPLACE (if(version_number = 3, NULL, customer_key) AS customer_key, if(version_number = 4, NULL, customer_id) AS customer_id,
                    CASE version_number WHEN 5 THEN 'VIP' WHEN 6 THEN 'IRON' ELSE loyalty_tier END AS loyalty_tier)
  FROM (FROM dim_customer UNION ALL FROM dim_customer WHERE version_number = 2))""",
    """dim_restaurant_bad AS (
  SELECT * REPLACE (if(version_number = 3, NULL, restaurant_key) AS restaurant_key,
                    CASE version_number WHEN 4 THEN 75 WHEN 5 THEN -1 ELSE commission_pct END AS commission_pct)
  FROM (FROM dim_restaurant UNION ALL FROM dim_restaurant WHERE version_number = 2))""",
    """dim_date_bad AS (
  SELECT * REPLACE (if(day_of_month = 4, NULL, date_key) AS date_key)
  FROM (FROM dim_date UNION ALL FROM dim_date WHERE day_of_month = 3) WHERE day_of_month <> 5)""",
    """fct_orders_bad AS (
  SELECT * EXCLUDE (e) REPLACE (if(e % 307 = 12, NULL, order_id) AS order_id,
                    CASE WHEN e % 311 = 3 THEN NULL WHEN e % 313 = 5 THEN 'nope' ELSE customer_key END AS customer_key,
                    CASE WHEN e % 317 = 6 THEN NULL WHEN e % 331 = 7 THEN 'nope' ELSE restaurant_key END AS restaurant_key,
                    if(e % 503 = 20, -1 - net_amount, net_amount) AS net_amount)
  FROM (SELECT *, CAST(order_id AS BIGINT) AS e FROM (FROM fct_orders UNION ALL FROM fct_orders WHERE CAST(order_id AS BIGINT) % 211 = 8))
  WHERE e % 601 <> 21)""",
    """agg_daily_zone_metrics_bad AS (
  SELECT * REPLACE (CASE zone WHEN 'Z4' THEN 1.5 WHEN 'Z5' THEN -0.5 ELSE sla_hit_rate END AS sla_hit_rate)
  FROM (FROM agg_daily_zone_metrics UNION ALL FROM agg_daily_zone_metrics WHERE zone = 'Z3'))""",
    """agg_monthly_revenue_by_tier_bad AS (
  FROM agg_monthly_revenue_by_tier UNION ALL FROM agg_monthly_revenue_by_tier WHERE loyalty_tier = 'GOLD')""",
    """scd2_versions_bad AS (
  SELECT * EXCLUDE (version_number, is_current) REPLACE (
           if(version_number % 3 = 1 AND NOT is_current, valid_to + INTERVAL 10 DAY, valid_to) AS valid_to)
  FROM (SELECT 'customer' AS dim, customer_id AS natural_key, valid_from, valid_to, version_number, is_current FROM dim_customer
        UNION ALL SELECT 'restaurant', restaurant_id, valid_from, valid_to, version_number, is_current FROM dim_restaurant)
  WHERE version_number > 0)""",
]


def violations_sql(body: str) -> str:
    """A query over the ``*_bad`` tables."""
    return model_sql(body, extra=[DIM_DATE, DAILY, MONTHLY, SCD2_VERSIONS, *VIOLATIONS])


PRUNING_ROWS = """
SELECT query, (SELECT count(DISTINCT order_date) FROM fct_orders) AS dates_before, (SELECT count(*) FROM fct_orders) AS rows_before,
       count(DISTINCT order_date) AS dates_after, count(*) AS rows_after,
       1.0::DOUBLE - count(*)::DOUBLE / (SELECT count(*) FROM fct_orders) AS saved
FROM (SELECT 'gmv_latest_day' AS query, order_date FROM fct_orders WHERE order_date = (SELECT max(order_date) FROM fct_orders)
      UNION ALL SELECT 'orders_last7_one_restaurant', order_date FROM fct_orders WHERE order_date >= (SELECT max(order_date) - 7 FROM fct_orders)
      UNION ALL SELECT 'net_full_scan', order_date FROM fct_orders)
GROUP BY query"""

# Pairs (a, b) of a key's versions with a starting first and reaching into b, counted for each b.
OVERLAP_COUNTS = """
SELECT b.dim, b.natural_key, b.valid_from, b.valid_to, count(*) AS pairs
FROM {versions} b JOIN {versions} a
  ON a.dim = b.dim AND a.natural_key = b.natural_key AND a.valid_from < b.valid_from AND a.valid_to > b.valid_from
GROUP BY ALL"""

# Point in time over overlapping versions: a row for every version that holds the order's time.
OVERLAPPING_JOIN = """
SELECT o.order_id, v.valid_from AS version_from, v.valid_to AS version_to
FROM stg_orders o LEFT JOIN (FROM scd2_versions_bad WHERE dim = 'restaurant') v
  ON v.natural_key = o.restaurant_id AND o.order_ts >= v.valid_from AND o.order_ts < v.valid_to"""


# ----------------------------------------------------------- reports
REPORTS = {
    "gmv_latest_day": """
SELECT CAST(sum(net_amount) AS DECIMAL(18,2)) AS gmv FROM fct_orders
WHERE order_date = (SELECT max(order_date) FROM fct_orders) AND status = 'DELIVERED'""",
    "orders_last7_one_restaurant": """
SELECT order_date, count(*) AS orders FROM fct_orders
WHERE order_date >= (SELECT CAST(max(order_date) - INTERVAL 7 DAY AS DATE) FROM fct_orders)
  AND restaurant_id = '7'
GROUP BY order_date""",
    "net_full_scan": "SELECT CAST(sum(net_amount) AS DECIMAL(18,2)) AS net_amount FROM fct_orders",
    "multi_version_customer": """
SELECT customer_id, loyalty_tier, zone, valid_from, valid_to, is_current FROM dim_customer
WHERE customer_id IN (SELECT customer_id FROM dim_customer GROUP BY 1 HAVING count(*) > 1
                      ORDER BY customer_id LIMIT 1)""",
    "top_zone_days": """
SELECT * FROM agg_daily_zone_metrics ORDER BY order_date DESC, gmv DESC, zone LIMIT 10""",
    "revenue_by_tier_sorted": "SELECT * FROM agg_monthly_revenue_by_tier ORDER BY month, loyalty_tier",
    "unknown_orders_by_day": """
SELECT order_date, count(*) AS orders FROM fct_orders WHERE restaurant_key = '-1' GROUP BY 1""",
    "latest_orders": "SELECT * FROM fct_orders ORDER BY order_date DESC, order_id DESC LIMIT 10",
}


def report_sql(name: str) -> str:
    return model_sql(REPORTS[name], extra=[DAILY, MONTHLY])


RERUN = """
SELECT state, fct_rows, gmv FROM (
  SELECT count(*) AS fct_rows,
         CAST(sum(CASE WHEN status = 'DELIVERED' THEN net_amount END) AS DECIMAL(18,2)) AS gmv
  FROM fct_orders
) CROSS JOIN (SELECT 'before' AS state UNION ALL SELECT 'after')"""
