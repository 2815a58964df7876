"""stg_orders: one row per order, its latest known state."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import to_ntz
from tidemark.sources.schemas import FINAL_STATUSES, UNKNOWN

STG_COLUMNS = [
    "order_id", "customer_id", "restaurant_id", "order_ts", "order_date", "status", "is_final",
    "items_count", "gross_amount", "discount_amount", "delivery_fee", "net_amount",
    "payment_method", "delivered_ts", "updated_at", "last_extract_date",
]


def latest_versions(raw_orders: DataFrame) -> DataFrame:
    """Keep the newest row per order: ``updated_at desc, _loaded_at desc``.

    ``_extract_date desc`` breaks the remaining ties (exact duplicates).
    ``rank = 1`` lets Catalyst insert a partial WindowGroupLimit before the
    shuffle, so duplicate copies are dropped map-side.
    """
    return raw_orders.withColumn("_version_rank", _rank()).where("_version_rank = 1").drop("_version_rank")


# Columns are built once: each takes several calls to the JVM, every day anew.
@cache
def _rank() -> Column:
    return F.row_number().over(Window.partitionBy("order_id").orderBy(
        F.col("updated_at").desc(), F.col("_loaded_at").desc(), F.col("_extract_date").desc()))


@cache
def _columns() -> list[Column]:
    order_ts = to_ntz("order_ts")
    return [
        *map(F.col, ("order_id", "customer_id", "restaurant_id")),
        order_ts.alias("order_ts"),
        order_ts.cast("date").alias("order_date"),
        F.col("status"),
        F.col("status").isin(*FINAL_STATUSES).alias("is_final"),
        *map(F.col, ("items_count", "gross_amount", "discount_amount", "delivery_fee")),
        (F.col("gross_amount") - F.col("discount_amount") + F.col("delivery_fee"))
        .cast("decimal(12,2)").alias("net_amount"),
        F.coalesce(F.col("payment_method"), F.lit(UNKNOWN)).alias("payment_method"),
        to_ntz("delivered_ts").alias("delivered_ts"),
        to_ntz("updated_at").alias("updated_at"),
        F.col("_extract_date").alias("last_extract_date"),
    ]


def project(latest: DataFrame) -> DataFrame:
    return latest.select(_columns())


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    return project(latest_versions(raw_orders))
