"""Aggregate marts over the fact (partial/final aggregation by Spark)."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.schemas import UNKNOWN

SLA_MINUTES = 40


# Columns are built once: each takes several calls to the JVM, every day anew.
@cache
def _daily_columns() -> list[Column]:
    status = F.col("status")
    settled_delivery = status.isin("DELIVERED", "REFUNDED")
    minutes = F.col("delivery_minutes")

    def count_if(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")

    return [
        F.count(F.lit(1)).alias("orders"),
        count_if(status == "DELIVERED").alias("delivered_orders"),
        count_if(status == "CANCELLED").alias("cancelled_orders"),
        count_if(status == "REFUNDED").alias("refunded_orders"),
        F.sum(F.when(status == "DELIVERED", F.col("net_amount")).otherwise(F.lit(0)))
         .cast("decimal(18,2)").alias("gmv"),
        F.sum(F.when(status == "DELIVERED", F.coalesce(F.col("commission_amount"), F.lit(0)))
              .otherwise(F.lit(0))).cast("decimal(18,2)").alias("commission_revenue"),
        F.avg(F.when(settled_delivery, minutes)).cast("double").alias("avg_delivery_minutes"),
        # A missing duration counts as a miss here but is skipped in the average above.
        F.avg(F.when(settled_delivery,
                     F.when(minutes <= SLA_MINUTES, F.lit(1.0)).otherwise(F.lit(0.0))))
         .alias("sla_hit_rate"),
    ]


def agg_daily_zone_metrics(fct: DataFrame) -> DataFrame:
    """Daily metrics per zone of the restaurant at order time (settled orders)."""
    return fct.where("is_final").groupBy("order_date", F.expr(f"coalesce(restaurant_zone, '{UNKNOWN}') AS zone")).agg(*_daily_columns())


def agg_monthly_revenue_by_tier(fct: DataFrame) -> DataFrame:
    """Revenue by the loyalty tier the customer had when ordering (delivered orders)."""
    return fct.where("status = 'DELIVERED'").groupBy(
        F.expr("trunc(order_date, 'MM') AS month"), F.expr(f"coalesce(customer_tier, '{UNKNOWN}') AS loyalty_tier"),
    ).agg(
        F.count(F.lit(1)).alias("delivered_orders"),
        F.sum("net_amount").cast("decimal(18,2)").alias("gmv"),
        F.countDistinct("customer_id").alias("active_customers"),
    )


# Stored layout: each mart is partitioned by the column its groups live in,
# so a daily run rewrites only the partitions whose orders changed.
PARTITION_COLUMN = {"agg_daily_zone_metrics": "order_date", "agg_monthly_revenue_by_tier": "month"}


def month_starts(dates) -> list:
    return sorted({d.replace(day=1) for d in dates})


def touched_slices(fct: DataFrame, dates: list) -> dict[str, DataFrame]:
    """Mart rows of the touched order dates and their whole months.

    Each daily group is one ``order_date`` and each monthly group one month,
    so recomputing just these partitions equals a full rebuild. The filters
    are on the fact's partition column, so only those partitions are read.
    """
    import datetime as dt

    months = month_starts(dates)
    month_end = (months[-1].replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    listed = lambda days: ", ".join(f"DATE'{x}'" for x in days)
    in_months = f"order_date >= DATE'{months[0]}' AND order_date < DATE'{month_end}' AND trunc(order_date, 'MM') IN ({listed(months)})"
    return {
        "agg_daily_zone_metrics": agg_daily_zone_metrics(fct.where(f"order_date IN ({listed(dates)})")),
        "agg_monthly_revenue_by_tier": agg_monthly_revenue_by_tier(fct.where(in_months)),
    }


def full(fct: DataFrame) -> dict[str, DataFrame]:
    return {"agg_daily_zone_metrics": agg_daily_zone_metrics(fct),
            "agg_monthly_revenue_by_tier": agg_monthly_revenue_by_tier(fct)}
