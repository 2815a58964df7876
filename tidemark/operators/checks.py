"""Data-quality checks: each check is a DataFrame of violating rows.

A check passes when it has no rows. ``summary`` counts every check of a suite
in one query: each table is scanned once and gives (check, key) entries for all
its checks, which meet in one aggregation. A row check counts entries, a key
check the keys with too many of them, a relationship the child rows whose key
has no parent entry. ``gate`` raises when an error-level check fails, before
anything downstream is published.

The SCD2 overlap check flags each version that starts inside an earlier
version of the same key with a running maximum of ``valid_to`` - one window
pass per key, no pairing of versions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.schemas import LOYALTY_TIERS, ORDER_STATUSES, UNKNOWN, UNKNOWN_KEY

ROW, KEY, RELATION, BALANCE, OTHER = "row", "key", "relation", "balance", "other"


class DataQualityError(RuntimeError):
    """An error-level check has failures."""


@dataclass(frozen=True)
class Check:
    """A named check; ``rows()`` lists the failing rows.

    ``condition`` (SQL) marks the failing rows of a row check, and the rows that
    take part in a key check; a key fails with ``least`` rows or more. ``parent``
    and ``field`` are the other side of a relationship; of a balance they are the
    other table and the amount that must add up to the same on both sides.
    """

    name: str
    kind: str
    rows: Callable[[], DataFrame]
    severity: str = "error"
    table: DataFrame | None = None
    condition: str = "true"
    key: str = "NULL"
    least: int = 2
    parent: DataFrame | None = None
    field: str | None = None

    @property
    def violations(self) -> DataFrame:
        return self.rows()


def _list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def row_check(name: str, table: DataFrame, kind: str, column: str, arg=None) -> Check:
    """not_null / accepted_values / accepted_range / expression_is_true (SQL) on one column."""
    if kind == "not_null":
        return Check(name, ROW, lambda: not_null(table, column), table=table, condition=f"{column} IS NULL")
    if kind == "accepted_values":  # distinct values outside the list fail (nulls pass)
        return Check(name, KEY, lambda: accepted_values(table, column, arg), table=table, condition=f"{column} NOT IN ({_list(arg)})",
                     key=column, least=1)
    if kind == "accepted_range":
        lo, hi = arg
        return Check(name, ROW, lambda: accepted_range(table, column, lo, hi), table=table, condition=f"{column} < {lo} OR {column} > {hi}")
    if kind == "expression_is_true":
        return Check(name, ROW, lambda: expression_is_true(table, F.expr(arg)), table=table, condition=f"NOT ({arg})")
    raise ValueError(kind)


def unique_check(name: str, table: DataFrame, column: str) -> Check:
    return Check(name, KEY, lambda: unique(table, column), table=table, condition=f"{column} IS NOT NULL", key=column)


def combination_check(name: str, table: DataFrame, columns: list[str]) -> Check:
    return Check(name, KEY, lambda: unique_combination(table, columns), table=table, key=f"to_json(struct({', '.join(columns)}))")


def relation_check(name: str, child: DataFrame, column: str, parent: DataFrame, field: str) -> Check:
    return Check(name, RELATION, lambda: relationships(child, column, parent, field), table=child, condition=f"{column} IS NOT NULL",
                 key=column, parent=parent, field=field)


# ------------------------------------------------------------------ generic
def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull()).select(column)


def unique(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column) \
        .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.where(~F.col(column).isin(*values)).groupBy(column) \
        .agg(F.count(F.lit(1)).alias("n_records"))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child keys (non-null) with no parent row, one row per child row.

    Child rows are counted per key before the join, so a hot key is one row.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_child_key")) \
        .agg(F.count(F.lit(1)).alias("_n"))
    lost = keys.join(parent.select(F.col(field).alias("_child_key")), "_child_key", "left_anti")
    return lost.select("_child_key", F.explode(F.sequence(F.lit(1), F.col("_n")))).select("_child_key")


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None) -> DataFrame:
    c = F.col(column)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | (c < F.lit(min_value))
    if max_value is not None:
        bad = bad | (c > F.lit(max_value))
    return df.where(bad).select(column)


def expression_is_true(df: DataFrame, expr) -> DataFrame:
    return df.where(~expr)


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")) \
        .where(F.col("n_records") > 1)


# ----------------------------------------------------------------- singular
def fact_reconciles_with_staging(stg: DataFrame, fct: DataFrame) -> DataFrame:
    """One row when count(*) or sum(gross_amount) differ; an empty side never passes."""
    s = stg.agg(F.count(F.lit(1)).alias("stg_rows"), F.sum("gross_amount").alias("stg_gross"))
    f = fct.agg(F.count(F.lit(1)).alias("fct_rows"), F.sum("gross_amount").alias("fct_gross"))
    both = s.crossJoin(f)  # 1 row x 1 row
    same = F.col("stg_rows").eqNullSafe(F.col("fct_rows")) & F.col("stg_gross").eqNullSafe(F.col("fct_gross"))
    return both.where(~same).select(
        "stg_rows", "fct_rows",
        F.col("stg_gross").cast("decimal(18,2)").alias("stg_gross"),
        F.col("fct_gross").cast("decimal(18,2)").alias("fct_gross"))


def late_restaurants_unresolved(fct: DataFrame, late_arrival_days: int) -> DataFrame:
    """Orders older than the look-back that still point at the unknown restaurant."""
    cutoff = F.date_sub(fct.select(F.max("order_date")).scalar(), late_arrival_days)
    return fct.where((F.col("restaurant_key") == UNKNOWN_KEY) & (F.col("order_date") < cutoff)) \
        .select("order_id", "order_date", "restaurant_id")


def scd2_versions(dim_customer: DataFrame, dim_restaurant: DataFrame) -> DataFrame:
    c = dim_customer.where(F.col("customer_key") != UNKNOWN_KEY).select(
        F.lit("customer").alias("dim"), F.col("customer_id").alias("natural_key"), "valid_from", "valid_to")
    r = dim_restaurant.where(F.col("restaurant_key") != UNKNOWN_KEY).select(
        F.lit("restaurant").alias("dim"), F.col("restaurant_id").alias("natural_key"), "valid_from", "valid_to")
    return c.unionByName(r)


def scd2_overlaps(versions: DataFrame) -> DataFrame:
    """Versions ``b`` that start strictly inside an earlier version ``a`` of the same key.

    One row per overlapped ``b``: ``valid_from`` is the start of the earlier
    version reaching furthest (``a``), ``overlapping_from`` the start of ``b``.
    Empty exactly when the reference's pairwise self-join is empty.
    """
    start = F.unix_micros(F.col("valid_from").cast("timestamp"))
    w = Window.partitionBy("dim", "natural_key").orderBy(start) \
        .rangeBetween(Window.unboundedPreceding, -1)
    earlier = F.max_by(F.struct("valid_to", "valid_from"), "valid_to").over(w)
    flagged = versions.withColumn("_a", earlier) \
        .where(F.col("_a.valid_to") > F.col("valid_from"))
    return flagged.select("dim", "natural_key", F.col("_a.valid_from").alias("valid_from"),
                          F.col("valid_from").alias("overlapping_from"))


def overlap_pairs(versions: DataFrame) -> DataFrame:
    """Each version ``b`` with the number of its key's versions that start before it and reach into it.

    The pairs of an interval self join, counted without forming them: at the
    start of b, all versions that started before are in the running sum of
    starts, and those that ended by then in that of ends. One sort of starts
    and ends by key; versions without a length reach into none. Versions that
    start together count the same and not each other.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    real = F.col("valid_from") < F.col("valid_to")
    starts = versions.select("dim", "natural_key", "valid_from", "valid_to", micros("valid_from").alias("at"), F.when(real, 1).otherwise(0).alias("change"),
                             F.lit(True).alias("opens"))
    ends = versions.where(real).select("dim", "natural_key", "valid_from", "valid_to", micros("valid_to").alias("at"), F.lit(-1).alias("change"),
                                       F.lit(False).alias("opens"))
    key = Window.partitionBy("dim", "natural_key").orderBy("at")
    # Starts strictly before, less ends up to and including this moment.
    before = F.sum(F.when(F.col("opens"), F.col("change")).otherwise(0)).over(key.rangeBetween(Window.unboundedPreceding, -1))
    over = F.sum(F.when(~F.col("opens"), 1).otherwise(0)).over(key.rangeBetween(Window.unboundedPreceding, 0))
    swept = starts.unionByName(ends).withColumn("pairs", F.coalesce(before, F.lit(0)) - F.coalesce(over, F.lit(0)))
    return swept.where(F.col("opens") & (F.col("pairs") > 0)).select("dim", "natural_key", "valid_from", "valid_to", F.col("pairs").cast("bigint").alias("pairs"))


# -------------------------------------------------------------------- suite
def standard_suite(raw: dict[str, DataFrame], stg: DataFrame, dim_customer: DataFrame,
                   dim_restaurant: DataFrame, dim_date: DataFrame, fct: DataFrame,
                   daily: DataFrame | None, monthly: DataFrame | None,
                   late_arrival_days: int = 3, severities: dict[str, str] | None = None,
                   full_fct: DataFrame | None = None, latest_date: dt.date | None = None,
                   versions: DataFrame | None = None) -> list[Check]:
    """The reference's 31 data tests (28 generic + 3 singular).

    ``full_fct``: the whole fact for the late-arrival check when ``fct`` is
    only the touched partitions (that check looks at old partitions).
    ``latest_date``: the fact's largest order date, where it is known.
    ``versions``: intervals for the overlap check other than the dimensions'.
    """
    whole = full_fct if full_fct is not None else fct
    if latest_date is None:
        latest_date = whole.agg(F.max("order_date")).first()[0]
    old = f"order_date < DATE'{latest_date - dt.timedelta(days=late_arrival_days)}'" if latest_date else "false"
    suite = [
        row_check("source_not_null_orders_order_id", raw["orders"], "not_null", "order_id"),
        row_check("source_not_null_orders_updated_at", raw["orders"], "not_null", "updated_at"),
        row_check("source_not_null_customers_customer_id", raw["customers"], "not_null", "customer_id"),
        row_check("source_not_null_restaurants_restaurant_id", raw["restaurants"], "not_null", "restaurant_id"),
        unique_check("unique_stg_orders_order_id", stg, "order_id"),
        row_check("not_null_stg_orders_order_id", stg, "not_null", "order_id"),
        row_check("accepted_values_stg_orders_status", stg, "accepted_values", "status", ORDER_STATUSES),
        row_check("expression_is_true_stg_orders_net_amount", stg, "expression_is_true", "net_amount", "net_amount >= 0"),
        unique_check("unique_dim_customer_customer_key", dim_customer, "customer_key"),
        row_check("not_null_dim_customer_customer_key", dim_customer, "not_null", "customer_key"),
        row_check("not_null_dim_customer_customer_id", dim_customer, "not_null", "customer_id"),
        row_check("accepted_values_dim_customer_loyalty_tier", dim_customer, "accepted_values", "loyalty_tier", LOYALTY_TIERS + [UNKNOWN]),
        unique_check("unique_dim_restaurant_restaurant_key", dim_restaurant, "restaurant_key"),
        row_check("not_null_dim_restaurant_restaurant_key", dim_restaurant, "not_null", "restaurant_key"),
        row_check("accepted_range_dim_restaurant_commission_pct", dim_restaurant, "accepted_range", "commission_pct", (0, 50)),
        unique_check("unique_dim_date_date_key", dim_date, "date_key"),
        row_check("not_null_dim_date_date_key", dim_date, "not_null", "date_key"),
        unique_check("unique_fct_orders_order_id", fct, "order_id"),
        row_check("not_null_fct_orders_order_id", fct, "not_null", "order_id"),
        relation_check("relationships_fct_orders_date_key", fct, "date_key", dim_date, "date_key"),
        row_check("not_null_fct_orders_customer_key", fct, "not_null", "customer_key"),
        relation_check("relationships_fct_orders_customer_key", fct, "customer_key", dim_customer, "customer_key"),
        row_check("not_null_fct_orders_restaurant_key", fct, "not_null", "restaurant_key"),
        relation_check("relationships_fct_orders_restaurant_key", fct, "restaurant_key", dim_restaurant, "restaurant_key"),
        row_check("expression_is_true_fct_orders_net_amount", fct, "expression_is_true", "net_amount", "net_amount >= 0"),
    ]
    if daily is not None:
        suite += [
            combination_check("unique_combination_agg_daily_zone_metrics", daily, ["order_date", "zone"]),
            row_check("accepted_range_agg_daily_zone_metrics_sla_hit_rate", daily, "accepted_range", "sla_hit_rate", (0, 1)),
        ]
    if monthly is not None:
        suite.append(combination_check("unique_combination_agg_monthly_revenue_by_tier", monthly, ["month", "loyalty_tier"]))
    suite += [
        Check("assert_fact_reconciles_with_staging", BALANCE, lambda: fact_reconciles_with_staging(stg, fct), table=stg, parent=fct,
              field="gross_amount"),
        Check("assert_late_arriving_restaurants_are_resolved", ROW, lambda: late_restaurants_unresolved(whole, late_arrival_days),
              table=whole, condition=f"restaurant_key = '{UNKNOWN_KEY}' AND {old}"),
        Check("assert_scd2_versions_do_not_overlap", OTHER, 
              lambda: scd2_overlaps(versions if versions is not None else scd2_versions(dim_customer, dim_restaurant))),
    ]
    sev = severities or {}
    return [Check(**{**vars(c), "severity": sev.get(c.name, "error")}) for c in suite]


def _entry(number: int, key: str, condition: str, n: int = 1, parent: bool = False) -> str:
    return f"CASE WHEN {condition} THEN named_struct('number', {number}, 'key', CAST({key} AS STRING), 'n', {n}L, 'parent', {str(parent).lower()}) END"


def failure_counts(checks: list[Check]) -> DataFrame:
    """``check_name, failures`` of the checks that have failures, as one statement.

    Entries carry a check's number and no amounts, and are dropped behind the
    generator (a ``filter`` of the array would be interpreted row by row): each
    row of the fact and of staging gives several. Balances are two totals.
    """
    tables: dict[int, tuple[DataFrame, list[str]]] = {}

    def add(table: DataFrame, entry: str) -> None:
        tables.setdefault(id(table), (table, []))[1].append(entry)

    counted, frames = [], {}
    for i, c in enumerate(checks):
        if c.kind in (ROW, KEY, RELATION):
            add(c.table, _entry(i, c.key, c.condition))
        if c.kind == RELATION:
            add(c.parent, _entry(i, c.field, f"{c.field} IS NOT NULL", 0, True))
        if c.kind == BALANCE:
            frames |= {f"b{i}": c.table, f"p{i}": c.parent}
            total = f"count(*) AS n, coalesce(sum(CAST({c.field} AS DECIMAL(28,2))), 0) AS amount"
            counted.append(f"""SELECT '{c.name}' AS check_name, CAST(if(b.n <> p.n OR b.amount <> p.amount, 1, 0) AS BIGINT) AS failures
                               FROM (SELECT {total} FROM {{b{i}}}) b CROSS JOIN (SELECT {total} FROM {{p{i}}}) p""")
        if c.kind == OTHER:
            frames[f"o{i}"] = c.violations
            counted.append(f"SELECT '{c.name}' AS check_name, count(*) AS failures FROM {{o{i}}}")
    parts = []
    for k, (table, entries) in enumerate(tables.values()):
        frames[f"t{k}"] = table
        parts.append(f"SELECT * FROM (SELECT inline(array({', '.join(entries)})) FROM {{t{k}}}) WHERE number IS NOT NULL")
    if parts:
        least = {n: ", ".join(str(i) for i, c in enumerate(checks) if c.kind == KEY and c.least == n) or "-1" for n in (1, 2)}
        names = ", ".join(f"'{c.name}'" for c in checks)
        counted.append(f"""
            SELECT element_at(array({names}), number + 1) AS check_name,
                   sum(CASE WHEN number IN ({least[1]}) THEN 1 WHEN number IN ({least[2]}) THEN if(n > 1, 1, 0) WHEN parent THEN 0 ELSE n END) AS failures
            FROM (SELECT number, key, sum(n) AS n, max(parent) AS parent FROM ({' UNION ALL '.join(parts)}) GROUP BY number, key)
            GROUP BY number""")
    spark = next(iter(frames.values())).sparkSession
    return spark.sql(f"SELECT * FROM ({' UNION ALL '.join(counted)}) WHERE failures > 0", **frames)


def summary(checks: list[Check]) -> DataFrame:
    """(check_name, severity, failures) for every check; one count per failing check comes back to the driver."""
    counts = failure_counts(checks)
    found = {r["check_name"]: int(r["failures"]) for r in counts.collect()}
    return counts.sparkSession.createDataFrame([(c.name, c.severity, found.get(c.name, 0)) for c in checks],
                                               "check_name string, severity string, failures bigint")


def gate(result: DataFrame) -> list[dict]:
    """Raise ``DataQualityError`` when an error-level check failed; return all rows."""
    rows = [r.asDict() for r in result.collect()]  # one row per check
    failed = [r for r in rows if r["failures"] and r["severity"] == "error"]
    if failed:
        raise DataQualityError("failed checks: " + ", ".join(
            f"{r['check_name']}={r['failures']}" for r in failed))
    return rows
