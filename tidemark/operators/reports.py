"""Ad-hoc queries of the reference's README and cost report, as DataFrames.

Filters against "the latest date" are scalar subqueries (``DataFrame.scalar``)
so that on the stored, date-partitioned fact they become partition filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import saved_share
from tidemark.sources.schemas import UNKNOWN_KEY


def _latest_date(fct: DataFrame):
    return fct.select(F.max("order_date")).scalar()


def gmv_latest_day(fct: DataFrame) -> DataFrame:
    """GMV of delivered orders on the latest order date."""
    return fct.where((F.col("order_date") == _latest_date(fct)) & (F.col("status") == "DELIVERED")) \
        .agg(F.sum("net_amount").cast("decimal(18,2)").alias("gmv"))


def orders_last7_one_restaurant(fct: DataFrame, restaurant_id: str, days: int = 7) -> DataFrame:
    """Orders per day in the last ``days`` days (relative to the latest date) for one restaurant."""
    since = F.date_sub(_latest_date(fct), days)
    return fct.where((F.col("order_date") >= since) & (F.col("restaurant_id") == restaurant_id)) \
        .groupBy("order_date").agg(F.count(F.lit(1)).alias("orders"))


def net_full_scan(fct: DataFrame) -> DataFrame:
    return fct.agg(F.sum("net_amount").cast("decimal(18,2)").alias("net_amount"))


def multi_version_customer(dim_customer: DataFrame) -> DataFrame:
    """Full history of the first customer (by id) that has more than one version."""
    first = dim_customer.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") > 1).orderBy("customer_id").limit(1).select("customer_id")
    return dim_customer.join(first, "customer_id", "left_semi").select(
        "customer_id", "loyalty_tier", "zone", "valid_from", "valid_to", "is_current")


def top_zone_days(daily: DataFrame, n: int = 10) -> DataFrame:
    return daily.orderBy(F.col("order_date").desc(), F.col("gmv").desc(), F.col("zone")).limit(n)


def revenue_by_tier_sorted(monthly: DataFrame) -> DataFrame:
    return monthly.orderBy("month", "loyalty_tier")


def unknown_orders_by_day(fct: DataFrame) -> DataFrame:
    return fct.where(F.col("restaurant_key") == UNKNOWN_KEY).groupBy("order_date") \
        .agg(F.count(F.lit(1)).alias("orders"))


def latest_orders(fct: DataFrame, n: int = 10) -> DataFrame:
    return fct.orderBy(F.col("order_date").desc(), F.col("order_id").desc()).limit(n)


# ------------------------------------------------------------ pruning report
def _date_predicates(latest) -> dict:
    """The partitions that each dashboard query must open."""
    return {
        "gmv_latest_day": F.col("order_date") == latest,
        "orders_last7_one_restaurant": F.col("order_date") >= F.date_sub(latest, 7),
        "net_full_scan": F.lit(True),
    }


def _per_query(parts: DataFrame, measures: dict, latest) -> DataFrame:
    """One row for each query: the measures over the partitions that it opens."""
    names = _date_predicates(latest)
    sums = parts.agg(*[F.coalesce(m(F.when(cond, 1)), F.lit(0)).alias(f"{q}|{name}") for q, cond in names.items() for name, m in measures.items()])
    rows = F.array(*[F.struct(F.lit(q).alias("query"), *[F.col(f"`{q}|{name}`").alias(name) for name in measures]) for q in names])
    return sums.select(F.inline(rows))


def pruning_report(partitioned: DataFrame, flat: DataFrame) -> DataFrame:
    """Files and bytes a scan must open, flat copy vs date-partitioned fact.

    Both arguments list files (``path, length``, and ``order_date`` for the
    partitioned table). For the three dashboard queries (latest day GMV, last 7
    days of one restaurant, full scan) the flat table must open every file, the
    partitioned one only files of partitions that pass the date predicate.
    """
    latest = partitioned.select(F.max("order_date")).scalar()
    after = _per_query(partitioned, {"files_after": F.count, "bytes_after": lambda on: F.sum(on * F.col("length"))}, latest)
    before = flat.agg(F.count(F.lit(1)).alias("files_before"), F.sum("length").alias("bytes_before"))
    return before.crossJoin(after).select("query", "files_before", "bytes_before", "files_after", "bytes_after") \
        .withColumn("saved", saved_share("bytes_before", "bytes_after"))


def pruning_rows(fct: DataFrame) -> DataFrame:
    """Dates and rows a scan must read, all of them vs those of the partitions each query opens.

    Rows are counted per partition from the file footers.
    """
    per_date = fct.groupBy("order_date").agg(F.count(F.lit(1)).alias("n"))
    latest = fct.select(F.max("order_date")).scalar()
    after = _per_query(per_date, {"dates_after": F.count, "rows_after": lambda on: F.sum(on * F.col("n"))}, latest)
    before = per_date.agg(F.count(F.lit(1)).alias("dates_before"), F.sum("n").alias("rows_before"))
    return before.crossJoin(after).select("query", "dates_before", "rows_before", "dates_after", "rows_after") \
        .withColumn("saved", saved_share("rows_before", "rows_after"))
