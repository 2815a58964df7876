"""Point-in-time left join: each fact row gets the dimension versions whose
half-open interval ``[valid_from, valid_to)`` contains the fact's timestamp.

Two physical plans with the same rows for any versions, overlapping, nested or
with equal starts included (a fact inside several versions has a row for each):

* ``broadcast`` - the versions are broadcast and matched on the key with the
  interval as a residual condition. Taken only when Spark's estimate for the
  versions, which comes from file sizes without a job, stays under
  ``max_bytes`` with room for ``EXPANSION`` between files and memory.
* ``spans`` - for versions of any size. Days are numbered, and a version's days
  are cut into the fewest dyadic spans: blocks of ``4**k`` days that start at a
  multiple of their size, at most three of a size at either end. A day lies in
  one block of each size, and in one span of a version or in none. So the
  versions that touch a (key, day) come from an equi-join on (key, size,
  block) with the distinct (key, day) pairs of the facts, and the facts then
  join on (key, day) with the interval as residual. Neither a long history nor
  a hot key makes a row meet more versions than touch its day; a hot
  (key, day) is split by AQE's skew join on the fact side.

Days outside the period in which any version starts or ends are folded into
its edges, so a version that is open at an end needs few spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes in memory allowed for a byte of Spark's estimate.
EXPANSION = 8
#: Sizes of spans: powers of 4 days. 4**12 days are 45,000 years.
_LEVELS = range(0, 26, 2)


def estimated_bytes(df: DataFrame) -> int:
    """Spark's size estimate for the rows of a plan, without running it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, max_bytes: int) -> bool:
    return estimated_bytes(df) * EXPANSION <= max_bytes


def _top(last: Column) -> Column:
    """The first span size that covers the day numbers 0 to ``last``; 0 without any."""
    top = F.when(last.isNull(), 0)
    for k in _LEVELS[:-1]:
        top = top.when(last < F.lit(1 << k), k)
    return top.otherwise(_LEVELS[-1])


def _each_level(df: DataFrame) -> DataFrame:
    """A row for each span size up to ``_top``."""
    return df.withColumn("_level", F.explode(F.array(*(F.lit(k) for k in _LEVELS)))).where("_level <= _top")


def _spans(df: DataFrame) -> DataFrame:
    """A row for each span (``_level``, ``_block``) of those that tile the days ``[_start, _end)``.

    Of the blocks of a size that lie inside, those that a larger one covers are
    left out. Whole numbers and no lambda functions, so that Spark compiles it:
    a table has millions of versions.
    """
    up = lambda n, k: f"(({n} + (CAST(1 AS BIGINT) << {k}) - 1) >> {k})"
    span = lambda a, b: f"IF({b} > {a}, sequence({a}, {b} - 1), CAST(array() AS ARRAY<BIGINT>))"
    cut = _each_level(df).selectExpr("*", f"{up('_start', '_level')} AS _a", "_end >> _level AS _b",
                                     f"{up('_start', '(_level + 2)')} << 2 AS _ca", "(_end >> (_level + 2)) << 2 AS _cb")
    cut = cut.withColumn("_outer", F.expr("_level = _top OR _ca >= _cb"))
    cut = cut.selectExpr("*", "IF(_outer, _b, _ca) AS _left", "IF(_outer, _b, _cb) AS _right")
    return cut.withColumn("_block", F.explode(F.expr(f"concat({span('_a', '_left')}, {span('_right', '_b')})")))


def _candidates_by_day(fact_days: DataFrame, versions: DataFrame, key: str, payload: list[str]) -> DataFrame:
    """(key, day) -> every version that touches the day."""
    real = versions.where(F.col(key).isNotNull() & (F.col("_v_from") < F.col("_v_to")))
    first = F.unix_date(F.to_date("_v_from"))
    last = F.unix_date(F.to_date(F.timestamp_add("MICROSECOND", F.lit(-1), F.col("_v_to"))))
    lo = real.select(F.min(last)).scalar()
    hi = real.select(F.max(first) + 1).scalar()

    def numbered(df: DataFrame) -> DataFrame:
        df = df.withColumn("_lo", lo).withColumn("_hi", hi).withColumn("_base", F.least(F.col("_lo"), F.col("_hi")))
        return df.withColumn("_last", F.col("_hi") - F.col("_base")).withColumn("_top", _top(F.col("_last")))

    def folded(day: Column) -> Column:
        return F.greatest(F.least(day - F.col("_base"), F.col("_last")), F.lit(0))

    end = F.when(folded(last) >= F.col("_last"), F.expr("CAST(1 AS BIGINT) << _top")).otherwise(folded(last) + 1)
    tiled = numbered(real).withColumn("_start", folded(first).cast("bigint")).withColumn("_end", end)
    spans = _spans(tiled).select(F.col(key).alias("_key"), "_level", "_block", "_v_from", "_v_to", *payload)
    asked = _each_level(numbered(fact_days).withColumn("_number", folded(F.unix_date("_day")).cast("bigint"))) \
        .selectExpr(f"`{key}` AS _key", "_day", "_level", "_number >> _level AS _block")
    return asked.join(spans, ["_key", "_level", "_block"]).select(F.col("_key").alias("_v_key"), F.col("_day").alias("_v_day"), "_v_from", "_v_to", *payload)


def point_in_time_join(facts: DataFrame, versions: DataFrame, key: str, ts: str,
                       columns: dict[str, str], valid_from: str = "valid_from",
                       valid_to: str = "valid_to", strategy: str = "auto",
                       max_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """Left join ``facts`` to ``versions`` on ``key`` and ``valid_from <= ts < valid_to``.

    ``columns`` maps output column name -> version column name.
    """
    payload = list(columns)
    v = versions.selectExpr(key, f"`{valid_from}` AS _v_from", f"`{valid_to}` AS _v_to", *[f"`{src}` AS `{out}`" for out, src in columns.items()])
    if strategy == "auto":
        strategy = "broadcast" if fits_broadcast(v, max_bytes) else "spans"

    if strategy == "broadcast":
        vb = F.broadcast(v.withColumnRenamed(key, "_v_key"))
        cond = F.expr(f"`{key}` = _v_key AND `{ts}` >= _v_from AND `{ts}` < _v_to")
        return facts.join(vb, cond, "left").drop("_v_key", "_v_from", "_v_to")

    if strategy != "spans":
        raise ValueError(f"unknown strategy {strategy!r}")
    f = facts.withColumn("_day", F.to_date(F.col(ts)))
    fact_days = f.select(key, "_day").where(F.col(key).isNotNull() & F.col("_day").isNotNull()).distinct()
    cand = _candidates_by_day(fact_days, v, key, payload)
    cond = F.expr(f"`{key}` = _v_key AND _day = _v_day AND `{ts}` >= _v_from AND `{ts}` < _v_to")
    return f.join(cand, cond, "left").drop("_day", "_v_key", "_v_day", "_v_from", "_v_to")
