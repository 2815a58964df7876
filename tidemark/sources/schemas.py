"""Declared schemas of the three landed extracts and their raw tables.

Landed timestamps are UTC instants (``TimestampType``); staging and history
turn them into UTC wall-clock ``timestamp_ntz``. Schemas are always declared,
never inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

TS = T.TimestampType()
MONEY = T.DecimalType(10, 2)
PCT = T.DecimalType(5, 2)

LANDING = {
    "restaurants": T.StructType([
        T.StructField("restaurant_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("zone", T.StringType()),
        T.StructField("cuisine", T.StringType()),
        T.StructField("commission_pct", PCT),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("created_at", TS),
        T.StructField("updated_at", TS),
        T.StructField("_extract_date", T.DateType()),
    ]),
    "customers": T.StructType([
        T.StructField("customer_id", T.StringType()),
        T.StructField("zone", T.StringType()),
        T.StructField("loyalty_tier", T.StringType()),
        T.StructField("signup_ts", TS),
        T.StructField("updated_at", TS),
        T.StructField("_extract_date", T.DateType()),
    ]),
    "orders": T.StructType([
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("restaurant_id", T.StringType()),
        T.StructField("order_ts", TS),
        T.StructField("status", T.StringType()),
        T.StructField("items_count", T.IntegerType()),
        T.StructField("gross_amount", MONEY),
        T.StructField("discount_amount", MONEY),
        T.StructField("delivery_fee", MONEY),
        T.StructField("payment_method", T.StringType()),
        T.StructField("delivered_ts", TS),
        T.StructField("updated_at", TS),
        T.StructField("_extract_date", T.DateType()),
    ]),
}

LOADED_AT = T.StructField("_loaded_at", TS)


def raw_schema(entity: str) -> T.StructType:
    return T.StructType(LANDING[entity].fields + [LOADED_AT])


def columns(entity: str, raw: bool = False) -> list[str]:
    return (raw_schema(entity) if raw else LANDING[entity]).fieldNames()


# Status, loyalty tier and payment method domains of the source.
ORDER_STATUSES = ["PLACED", "OUT_FOR_DELIVERY", "DELIVERED", "CANCELLED", "REFUNDED"]
FINAL_STATUSES = ["DELIVERED", "CANCELLED", "REFUNDED"]
LOYALTY_TIERS = ["BRONZE", "SILVER", "GOLD", "PLATINUM"]
PAYMENT_METHODS = ["UPI", "CARD", "COD", "WALLET"]
UNKNOWN = "UNKNOWN"
UNKNOWN_KEY = "-1"

# Per-entity history description: natural key and the tracked attributes.
HISTORY = {
    "customers": ("customer_id", ["zone", "loyalty_tier", "signup_ts"]),
    "restaurants": ("restaurant_id",
                    ["name", "zone", "cuisine", "commission_pct", "is_active", "created_at"]),
}
