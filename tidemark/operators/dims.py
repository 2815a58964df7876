"""SCD2 dimensions (customer, restaurant) and the date dimension."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import (VALID_FROM_FLOOR, VALID_TO_CEILING, date_key,
                                      iso_day_of_week, ntz, surrogate_key)
from tidemark.sources.schemas import HISTORY, UNKNOWN, UNKNOWN_KEY

DIM_KEYS = {"customers": "customer_key", "restaurants": "restaurant_key"}


def versions_to_dim(history: DataFrame, entity: str) -> DataFrame:
    """One row per version plus the unknown member ``-1``.

    The first captured version is back-dated to 1900-01-01, so that orders from
    before the first snapshot find it; the surrogate key still hashes the
    real start. Open versions end at 9999-12-31 23:59:59 and are current.
    """
    dim = history.withColumn("version_number", _version_number(entity)).select(_columns(entity))
    return dim.unionByName(unknown_member(dim, entity))


# Columns are built once: each takes several calls to the JVM, every day anew.
@cache
def _version_number(entity: str) -> Column:
    return F.row_number().over(Window.partitionBy(HISTORY[entity][0]).orderBy("dbt_valid_from"))


@cache
def _columns(entity: str) -> list[Column]:
    key, attrs = HISTORY[entity]
    return [
        surrogate_key(key, "dbt_valid_from").alias(DIM_KEYS[entity]),
        F.col(key), *map(F.col, attrs),
        F.col("version_number").cast("int").alias("version_number"),
        F.when(F.col("version_number") == 1, ntz(VALID_FROM_FLOOR))
         .otherwise(F.col("dbt_valid_from")).alias("valid_from"),
        F.coalesce(F.col("dbt_valid_to"), ntz(VALID_TO_CEILING)).alias("valid_to"),
        F.col("dbt_valid_to").isNull().alias("is_current"),
    ]


def unknown_member(dim: DataFrame, entity: str) -> DataFrame:
    """The single ``-1`` row, typed like the dimension."""
    return dim.sparkSession.range(1).select(_unknown_columns(entity, tuple(dim.dtypes)))


@cache
def _unknown_columns(entity: str, dtypes: tuple[tuple[str, str], ...]) -> list[Column]:
    key, attrs = HISTORY[entity]
    values: dict[str, Column] = {DIM_KEYS[entity]: F.lit(UNKNOWN_KEY), key: F.lit(UNKNOWN)}
    for a in attrs:
        values[a] = F.lit(UNKNOWN) if dict(dtypes)[a] == "string" else F.lit(None)
    values.update(version_number=F.lit(0), valid_from=ntz(VALID_FROM_FLOOR),
                  valid_to=ntz(VALID_TO_CEILING), is_current=F.lit(True))
    return [values[c].cast(t).alias(c) for c, t in dtypes]


def dim_customer(history: DataFrame) -> DataFrame:
    return versions_to_dim(history, "customers")


def dim_restaurant(history: DataFrame) -> DataFrame:
    return versions_to_dim(history, "restaurants")


def dim_date_from_bounds(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Calendar rows for every day in ``[start, end]`` of each bounds row.

    ``bounds`` is a one-row frame (for example the min/max order date rounded
    out to whole years) so the range never passes through the driver.
    """
    days = bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("date_day"))
    return days.select(
        date_key("date_day").alias("date_key"),
        "date_day",
        F.year("date_day").cast("int").alias("year"),
        F.month("date_day").cast("int").alias("month"),
        F.dayofmonth("date_day").cast("int").alias("day_of_month"),
        iso_day_of_week("date_day").alias("iso_day_of_week"),
        (iso_day_of_week("date_day") >= 6).alias("is_weekend"),
    )


def dim_date(spark, start: str, end_exclusive: str) -> DataFrame:
    """Date spine ``[start, end_exclusive)`` like the reference's 2026-2027 table."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("start"),
                                   F.date_sub(F.lit(end_exclusive).cast("date"), 1).alias("end"))
    return dim_date_from_bounds(bounds)


def dim_date_covering(dates: DataFrame, column: str = "order_date") -> DataFrame:
    """Whole calendar years covering every value of ``dates[column]``."""
    bounds = dates.agg(F.trunc(F.min(column), "year").alias("start"),
                       F.date_sub(F.add_months(F.trunc(F.max(column), "year"), 12), 1).alias("end"))
    return dim_date_from_bounds(bounds.where(F.col("start").isNotNull()))
