"""Column helpers shared by the models (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentinels of the SCD2 dimensions and the surrogate-key null marker.
VALID_FROM_FLOOR = "1900-01-01 00:00:00"
VALID_TO_CEILING = "9999-12-31 23:59:59"
SURROGATE_NULL_MARKER = "_dbt_utils_surrogate_key_null_"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(literal: str) -> Column:
    """A ``timestamp_ntz`` literal such as the SCD2 sentinels."""
    return F.lit(literal).cast("timestamp_ntz")


def to_ntz(c: str | Column) -> Column:
    """UTC instant -> UTC wall clock (the session time zone is UTC)."""
    return col(c).cast("timestamp_ntz")


def trunc_second(c: str | Column) -> Column:
    return F.date_trunc("second", col(c)).cast("timestamp_ntz")


def date_key(d: str | Column) -> Column:
    """2026-09-30 -> 20260930."""
    d = col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_day_of_week(d: str | Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.weekday(col(d)) + 1).cast("int")


def lookback(ts: str | Column, days: int) -> Column:
    """Timestamp minus ``days`` days."""
    return F.timestamp_add("DAY", F.lit(-int(days)), col(ts))


def minute_boundaries(start: str | Column, end: str | Column) -> Column:
    """Minute boundaries crossed between two timestamps (10:00:59 -> 10:02:01 is 2)."""
    return F.timestamp_diff(
        "MINUTE",
        F.date_trunc("minute", col(start)).cast("timestamp_ntz"),
        F.date_trunc("minute", col(end)).cast("timestamp_ntz"),
    ).cast("int")


def surrogate_key(*cols: str | Column) -> Column:
    """md5 of the '-'-joined text of the columns, nulls replaced by a marker."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(SURROGATE_NULL_MARKER)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def scd_id(key: str | Column, updated_at: str | Column) -> Column:
    """Identifier of one history row: md5 of key '|' updated_at."""
    return F.md5(F.concat_ws("|", F.coalesce(col(key).cast("string"), F.lit("")),
                             F.coalesce(col(updated_at).cast("string"), F.lit(""))))


def saved_share(before: str | Column, after: str | Column) -> Column:
    """1 - after / before, 0 when nothing was scanned before."""
    before, after = col(before), col(after)
    return F.when(before > 0, F.lit(1.0) - after.cast("double") / before.cast("double")) \
        .otherwise(F.lit(0.0))
