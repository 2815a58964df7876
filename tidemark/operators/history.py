"""SCD Type 2 history from daily extracts (timestamp strategy).

A version opens at the source's ``updated_at`` and closes at the
``updated_at`` of the next newer row of the same key. A row whose
``updated_at`` did not move forward changes nothing; keys missing from a
slice stay open.

Two equal ways to build it:

* ``bulk_history`` - all slices in one pass (back-fill): per key, ordered by
  extract date, keep rows newer than every earlier row; ``valid_to`` is the
  next kept row's ``valid_from``. A key has at most one row per extract day,
  so each window partition is bounded by the number of days, not by data.
* ``snapshot_rows`` / ``snapshot_into`` - the daily step: the open versions
  after day D-1 full-outer-joined with slice D on the key, in one pass to the
  versions that are open after the day and those it closed. Both are partitions
  of one stored table (``open-D``, ``closed-D``), so a re-run of D replaces
  exactly these. Open sets older than ``history_days`` are dropped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import WarehouseConfig
from tidemark.functions.exprs import scd_id
from tidemark.sources.schemas import HISTORY
from tidemark.sources.store import EMPTY, Snapshot, Store, Transaction

META = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


class HistoryOrderError(RuntimeError):
    """A history step was asked to run out of date order."""


class DuplicateKeyError(RuntimeError):
    """A slice holds the same natural key twice."""


def _slice_columns(entity: str) -> tuple[str, list[str]]:
    key, attrs = HISTORY[entity]
    return key, attrs


def source_rows(raw: DataFrame, entity: str) -> DataFrame:
    """Snapshot input: tracked columns with wall-clock timestamps."""
    key, attrs = _slice_columns(entity)
    types = dict(raw.dtypes)
    local = [f"CAST({c} AS TIMESTAMP_NTZ) AS {c}" if types[c] == "timestamp" else c for c in [*attrs, "updated_at"]]
    return raw.selectExpr(key, *local, "_extract_date")


def _with_meta(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("dbt_scd_id", scd_id(key, "updated_at")) \
        .withColumn("dbt_updated_at", F.col("updated_at")) \
        .withColumn("dbt_valid_from", F.col("updated_at"))


def bulk_history(raw: DataFrame, entity: str, with_close_day: bool = False) -> DataFrame:
    """All versions from every slice in ``raw`` (I7).

    ``with_close_day`` adds ``_close_day``: the extract day whose row closed
    the version (null while open), i.e. the daily run that would close it.
    """
    key, attrs = _slice_columns(entity)
    rows = source_rows(raw, entity)
    by_day = Window.partitionBy(key).orderBy("_extract_date")
    prior_max = F.max("updated_at").over(by_day.rowsBetween(Window.unboundedPreceding, -1))
    kept = rows.withColumn("_prior", prior_max) \
        .where(F.col("_prior").isNull() | (F.col("updated_at") > F.col("_prior")))
    # Kept rows are increasing in updated_at along extract dates, so the same
    # window (same partitioning and order, no new exchange) gives the successor.
    versions = kept.withColumn("dbt_valid_to", F.lead("updated_at").over(by_day))
    extra = []
    if with_close_day:
        versions = versions.withColumn("_close_day", F.lead("_extract_date").over(by_day))
        extra = ["_close_day"]
    return _with_meta(versions, key).select(key, *attrs, "updated_at", *META, *extra)


def snapshot_rows(open_prev: DataFrame, slice_rows: DataFrame, entity: str) -> DataFrame:
    """One day of history (I6): the rows of both sets, ``_closed`` telling them apart.

    ``_copies`` is the number of slice rows of the key: above 1 the slice is invalid.
    """
    key, attrs = _slice_columns(entity)
    cols = [key, *attrs, "updated_at"]

    def version(side: str, valid_to: str, closed: str) -> str:
        start = "o.dbt_valid_from" if side == "o" else "s.updated_at"
        scd = "o.dbt_scd_id" if side == "o" else f"md5(concat_ws('|', coalesce(CAST(s.{key} AS STRING), ''), coalesce(CAST(s.updated_at AS STRING), '')))"
        fields = {c: f"{side}.{c}" for c in cols} | {"dbt_scd_id": scd, "dbt_updated_at": start, "dbt_valid_from": start,
                                                     "dbt_valid_to": valid_to, "_closed": closed}
        return f"named_struct({', '.join(f'{name!r}, {value}' for name, value in fields.items())})"

    never = "CAST(NULL AS TIMESTAMP_NTZ)"
    moved = "s IS NOT NULL AND (o IS NULL OR s.updated_at > o.dbt_valid_from)"
    return open_prev.sparkSession.sql(f"""
        SELECT v.*, _copies, _key FROM (
          SELECT coalesce(_copies, 1) AS _copies, _key, explode(filter(array(
                   CASE WHEN o IS NOT NULL AND ({moved}) THEN {version("o", "s.updated_at", "true")} END,
                   CASE WHEN o IS NOT NULL AND NOT ({moved}) THEN {version("o", never, "false")} END,
                   CASE WHEN {moved} THEN {version("s", never, "false")} END), v -> v IS NOT NULL)) AS v
          FROM (SELECT {key} AS _key, struct({', '.join(cols + META)}) AS o FROM {{open_prev}})
          FULL JOIN (SELECT {key} AS _key, max(struct({', '.join(["updated_at", key, *attrs])})) AS s, count(*) AS _copies
                     FROM {{slice_rows}} GROUP BY {key}) USING (_key))""", open_prev=open_prev, slice_rows=slice_rows)


def empty_history(spark: SparkSession, raw_like: DataFrame, entity: str) -> DataFrame:
    key, attrs = _slice_columns(entity)
    meta = T.StructType([T.StructField("dbt_scd_id", T.StringType()), *(T.StructField(c, T.TimestampNTZType()) for c in META[1:])])
    return spark.createDataFrame([], T.StructType(source_rows(raw_like, entity).drop("_extract_date").schema.fields + meta.fields))


# ----------------------------------------------------------------- stored state
START = "history_start"


def _started(txn: Transaction, entity: str, day: str) -> None:
    """Remember the first day of the history (a bulk build has no first state)."""
    txn.state.properties[f"{START}.{entity}"] = day


def table_name(entity: str) -> str:
    return f"snap_{entity}"


def _open(d: dt.date) -> str:
    return f"open-{d.isoformat()}"


def _closed(d: dt.date) -> str:
    return f"closed-{d.isoformat()}"


def _days(state: Snapshot, entity: str, kind: str) -> list[dt.date]:
    return [dt.date.fromisoformat(v.split("-", 1)[1]) for v in state.values(table_name(entity)) if v.startswith(kind)]


def open_days(state: Snapshot, entity: str) -> list[dt.date]:
    """Days whose open set is stored, in order."""
    return _days(state, entity, "open-")


def finished_through(state: Snapshot, entity: str) -> dt.date | None:
    days = open_days(state, entity)
    return days[-1] if days else None


def snapshot_into(txn: Transaction, entity: str, d: dt.date, raw: DataFrame, allow_rerun: bool = False,
                  keep_days: int | None = None) -> None:
    """The history step for day ``d`` from the raw rows with ``_extract_date = d``.

    ``raw`` may hold more days (only day ``d`` is used); passing just that
    partition avoids listing the whole raw table.

    Refuses to run when state for a later day exists (unless ``allow_rerun``)
    or when the previous day's state is missing after history has started.
    """
    key, attrs = _slice_columns(entity)
    done = open_days(txn.state, entity)
    later = [x for x in done if x > d]
    if later and not allow_rerun:
        raise HistoryOrderError(f"{entity}: state for {later[-1]} exists; re-run {d} explicitly")
    earlier = [x for x in done if x < d]
    prev = d - dt.timedelta(days=1)
    if earlier and earlier[-1] != prev:
        raise HistoryOrderError(f"{entity}: previous day {prev} has no state (last is {earlier[-1]})")
    start = txn.state.properties.get(f"{START}.{entity}")
    if not earlier and start and start < d.isoformat():
        raise HistoryOrderError(f"{entity}: the state before {d} is no longer stored")
    _started(txn, entity, min(start or d.isoformat(), d.isoformat()))

    slice_rows = source_rows(raw.where(F.col("_extract_date") == F.lit(d)), entity).drop("_extract_date")
    open_prev = txn.read(table_name(entity), [_open(prev)]).drop("part") if earlier else empty_history(txn.spark, raw, entity)
    seen = Observation()
    rows = snapshot_rows(open_prev, slice_rows, entity).observe(
        seen, F.max("_copies").alias("most"), F.max_by("_key", "_copies").alias("key"))
    part = f"if(_closed, '{_closed(d)}', '{_open(d)}')"
    txn.replace_parts(table_name(entity), rows.withColumn("part", F.expr(part)).drop("_closed", "_copies", "_key"), "part", [_open(d), _closed(d)])
    found = seen.get
    if (found.get("most") or 0) > 1:
        raise DuplicateKeyError(f"slice holds {key}={found['key']} {found['most']} times")
    # Without any version the day still counts as done.
    txn.state.tables[table_name(entity)].parts.setdefault(_open(d), EMPTY)
    if keep_days is not None:
        limit = open_days(txn.state, entity)[-1] - dt.timedelta(days=keep_days)
        txn.drop_parts(table_name(entity), [_open(x) for x in open_days(txn.state, entity) if x < limit])


def bulk_into(txn: Transaction, entity: str, raw: DataFrame, through: dt.date) -> None:
    """The history of all rows of ``raw`` in one pass, stored as the daily steps would leave it after ``through``."""
    rows = bulk_history(raw, entity, with_close_day=True)
    part = F.coalesce(F.concat(F.lit("closed-"), F.col("_close_day").cast("string")), F.lit(_open(through)))
    txn.replace(table_name(entity), rows.withColumn("part", part).drop("_close_day"), "part")
    txn.state.tables[table_name(entity)].parts.setdefault(_open(through), EMPTY)
    _started(txn, entity, dt.date.min.isoformat())


def history_in(txn: Transaction, entity: str, as_of: dt.date) -> DataFrame:
    """Every version known after day ``as_of``: closed up to it plus the open set."""
    values = [_closed(x) for x in _days(txn.state, entity, "closed-") if x <= as_of] + [_open(as_of)]
    return txn.read(table_name(entity), values).drop("part")


def snapshot_day(spark: SparkSession, cfg: WarehouseConfig, entity: str, d: dt.date, raw: DataFrame,
                 allow_rerun: bool = False) -> None:
    """:func:`snapshot_into` as a commit of its own."""
    txn = Store(spark, cfg.marts).begin()
    snapshot_into(txn, entity, d, raw, allow_rerun, cfg.history_days)
    txn.commit()


def read_history(spark: SparkSession, cfg: WarehouseConfig, entity: str, as_of: dt.date) -> DataFrame:
    return history_in(Store(spark, cfg.marts).begin(), entity, as_of)
