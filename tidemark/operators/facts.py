"""fct_orders: one row per order with point-in-time dimension keys.

* ``fact_rows`` - the model (I14): staging x customer version x restaurant
  version, unmatched -> unknown member ``-1``.
* ``incremental_source`` - look-back slice of staging (I1), with the raw
  partition pre-filter that Catalyst cannot push below the dedup window.
* ``upsert_into`` - idempotent delete+insert on ``order_id`` (I2): the changed
  orders' partitions, and those that the order index names for orders stored
  under another date, are merged and replaced in one commit.
* ``refresh_into`` - rebuild (I4). Both refuse a schema change (I5).
"""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import WarehouseConfig
from tidemark.functions.exprs import date_key, minute_boundaries
from tidemark.operators import order_index, staging
from tidemark.operators.pit_join import point_in_time_join
from tidemark.session import stored_once
from tidemark.sources import storage
from tidemark.sources.schemas import UNKNOWN_KEY
from tidemark.sources.store import Snapshot, Store, Transaction

FACT, CHANGES = "fct_orders", "fct_orders_changes"
WATERMARK = "watermark"

FACT_COLUMNS = [
    "order_id", "order_date", "date_key", "customer_key", "restaurant_key", "customer_id",
    "restaurant_id", "restaurant_zone", "customer_tier", "order_ts", "status", "is_final",
    "payment_method", "items_count", "gross_amount", "discount_amount", "delivery_fee",
    "net_amount", "commission_pct", "commission_amount", "delivered_ts", "delivery_minutes",
    "updated_at",
]


class SchemaChangeError(RuntimeError):
    """The rows to write do not have the stored table's schema."""


def fact_rows(orders: DataFrame, dim_customer: DataFrame, dim_restaurant: DataFrame,
              strategy: str | dict[str, str] = "auto", max_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """``strategy``: "auto", "broadcast", "spans", or one per dimension
    (``{"customers": .., "restaurants": ..}``)."""
    per_dim = strategy if isinstance(strategy, dict) else {"customers": strategy, "restaurants": strategy}
    customers = dim_customer.where(f"customer_key <> '{UNKNOWN_KEY}'")
    restaurants = dim_restaurant.where(f"restaurant_key <> '{UNKNOWN_KEY}'")
    o = point_in_time_join(orders, customers, "customer_id", "order_ts",
                           {"_c_key": "customer_key", "customer_tier": "loyalty_tier"},
                           strategy=per_dim["customers"], max_bytes=max_bytes)
    o = point_in_time_join(o, restaurants, "restaurant_id", "order_ts",
                           {"_r_key": "restaurant_key", "restaurant_zone": "zone",
                            "commission_pct": "commission_pct"},
                           strategy=per_dim["restaurants"], max_bytes=max_bytes)
    return o.select(_columns())


@cache
def _columns() -> list[Column]:
    # net * pct * 0.01 keeps exact decimal arithmetic; round() is HALF_UP.
    commission = F.round(F.col("net_amount") * F.col("commission_pct") * F.lit(Decimal("0.01")), 2)
    made = {
        "date_key": date_key("order_date"),
        "customer_key": F.coalesce(F.col("_c_key"), F.lit(UNKNOWN_KEY)),
        "restaurant_key": F.coalesce(F.col("_r_key"), F.lit(UNKNOWN_KEY)),
        "commission_amount": commission.cast("decimal(18,2)"),
        "delivery_minutes": minute_boundaries("order_ts", "delivered_ts"),
    }
    return [made[c].alias(c) if c in made else F.col(c) for c in FACT_COLUMNS]


def lookback_cutoff(max_updated_at, days: int):
    """``max(updated_at) - days`` as a Python value (``None`` for an empty target)."""
    return None if max_updated_at is None else max_updated_at - dt.timedelta(days=days)


def incremental_source(raw_orders: DataFrame, cutoff: dt.datetime | None) -> DataFrame:
    """Staged orders with ``updated_at >= cutoff`` (all of them when cutoff is None).

    The dedup window ranks every raw row, and a filter on ``updated_at`` cannot
    move below it. A row is never extracted before it changed
    (``_extract_date >= date(updated_at)``), so the latest version of every
    order updated since the cut-off lies in partitions ``>= date(cutoff)``:
    pre-filtering raw on the partition column gives the same rows and lets the
    scan prune all older partitions.
    """
    if cutoff is None:
        return staging.stg_orders(raw_orders)
    recent = raw_orders.where(f"_extract_date >= DATE'{cutoff.date()}'")
    return staging.stg_orders(recent).where(f"updated_at >= TIMESTAMP_NTZ'{cutoff}'")


def check_schema(rows: DataFrame, stored: T.StructType) -> None:
    want = [(f.name, f.dataType.simpleString()) for f in stored.fields]
    got = [(f.name, f.dataType.simpleString()) for f in rows.schema.fields]
    if sorted(want) != sorted(got):
        raise SchemaChangeError(f"fct_orders schema changed: stored {want}, new {got}")


def _clustered(rows: DataFrame) -> DataFrame:
    # Range partitioning on (date, restaurant, customer) splits a hot date over
    # several tasks (hash on the date alone would give it one task) and clusters
    # each file by restaurant and customer, so Parquet min/max statistics skip
    # row groups for restaurant/customer filters.
    cluster = ["order_date", "restaurant_id", "customer_id"]
    return rows.repartitionByRange(*cluster).sortWithinPartitions(*cluster)


def _file_options(cfg: WarehouseConfig) -> dict[str, str]:
    return {"maxRecordsPerFile": str(cfg.fact_max_records_per_file), "parquet.bloom.filter.enabled#customer_id": "true"}


def watermark_of(state: Snapshot) -> dt.datetime | None:
    """max(updated_at) of the stored fact; kept in the manifest so a run does not scan the table."""
    text = state.properties.get(WATERMARK)
    return None if text is None else dt.datetime.fromisoformat(text)


def _set_watermark(txn: Transaction, value: dt.datetime | None) -> None:
    txn.state.properties[WATERMARK] = None if value is None else value.isoformat()


def _seen_watermark(seen: Observation) -> dt.datetime | None:
    text = seen.get.get("wm")
    return None if text is None else dt.datetime.fromisoformat(text)


def _stored_schema(txn: Transaction) -> T.StructType:
    return T.StructType.fromJson(json.loads(txn.state.tables[FACT].schema))


def refresh_into(txn: Transaction, cfg: WarehouseConfig, rows: DataFrame, at_rest: bool = False) -> dict:
    """Replace the whole fact and its index.

    Range partitioning reads its input twice, for the bounds and for the rows,
    so the rows are computed once and stored before; ``at_rest`` says that they
    come straight from stored tables.
    """
    if txn.has(FACT):
        check_schema(rows, _stored_schema(txn))
    seen = Observation()
    source = rows if at_rest else stored_once(rows, "fact-rows")
    txn.replace(FACT, _clustered(source.observe(seen, F.max("updated_at").cast("string").alias("wm"))), "order_date", _file_options(cfg))
    newest = _seen_watermark(seen)
    if not at_rest:
        storage.delete(txn.spark, source.stored_at)
    _set_watermark(txn, newest)
    order_index.rebuild(txn, txn.read(FACT))
    return {"mode": "full", "max_updated_at": newest}


def upsert_into(txn: Transaction, cfg: WarehouseConfig, changes: DataFrame) -> dict:
    """Delete+insert ``changes`` on ``order_id`` into the fact.

    The changes are written once, which cuts their lineage and gives their
    dates. The order index tells which of them are stored, and under which
    date. Only the partitions of old and new dates are read and replaced.
    """
    if not txn.has(FACT):
        return refresh_into(txn, cfg, changes)
    columns = _stored_schema(txn).fieldNames()
    check_schema(changes, _stored_schema(txn))
    seen = Observation()
    dates = txn.replace(CHANGES, changes.select(*columns).observe(seen, F.max("updated_at").cast("string").alias("wm")), "order_date")
    if not dates:
        return {"mode": "upsert", "partitions": 0, "dates": []}
    changes = txn.read(CHANGES)
    placed = changes.select("order_id", "order_date").join(order_index.stored_dates(txn, changes), "order_id", "left") \
        .where(F.col("stored_date").isNull() | (F.col("stored_date") != F.col("order_date")))
    moves = Observation()
    placed = placed.observe(moves, F.concat_ws(",", F.collect_set(F.col("stored_date").cast("string"))).alias("left"))  # one per date
    order_index.add(txn, placed, cfg.index_runs)
    left = {x for x in (moves.get.get("left") or "").split(",") if x}
    touched = sorted(dates | left)
    kept = txn.read(FACT, touched).join(changes.select("order_id"), "order_id", "left_anti")
    txn.replace_parts(FACT, _clustered(kept.unionByName(changes)), "order_date", touched, _file_options(cfg))
    newest = max((x for x in (watermark_of(txn.state), _seen_watermark(seen)) if x is not None), default=None)
    _set_watermark(txn, newest)
    # A null order date is no date to slice the marts by: they are built anew.
    dated = all(x[:4].isdigit() for x in touched)
    return {"mode": "upsert", "partitions": len(touched), "max_updated_at": newest,
            "dates": [dt.date.fromisoformat(x) for x in touched] if dated else None}


def _own_commit(spark: SparkSession, cfg: WarehouseConfig, step) -> dict:
    txn = Store(spark, cfg.marts).begin()
    info = step(txn)
    txn.commit()
    return info


def full_refresh(spark: SparkSession, cfg: WarehouseConfig, rows: DataFrame, at_rest: bool = False) -> dict:
    """:func:`refresh_into` as a commit of its own."""
    return _own_commit(spark, cfg, lambda txn: refresh_into(txn, cfg, rows, at_rest))


def upsert(spark: SparkSession, cfg: WarehouseConfig, changes: DataFrame) -> dict:
    """:func:`upsert_into` as a commit of its own."""
    return _own_commit(spark, cfg, lambda txn: upsert_into(txn, cfg, changes))


def read_fact(spark: SparkSession, cfg: WarehouseConfig) -> DataFrame:
    return Store(spark, cfg.marts).read(FACT)
