"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised to equal-sized bins (strings by the
rank of the whole value, weighted by its rows), a document's place is the Hilbert index of its bins, and runs of the sorted places become
shards. Documents that are alike in all dimensions share a shard, so ranges of
each dimension per file are narrow and readers prune files by any of them.

Shards follow the law ``rows``: counts differ by one at most. A hot cell is
cut by ``doc_id`` like any other stretch of the curve.

Defined cases: null dimensions come first; a null text has size 16; repeated
rows are placed one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tables import discard, stored

BITS = 6
OVERHEAD = 16


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Index along the curve of integer points, given as one row per axis.

    Works level by level from the highest bit: the quadrant's Gray code is the
    next digit, and lower bits are reflected or exchanged to the quadrant's
    orientation.
    """
    x = axes.astype(np.int64).copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for axis in range(dims):
            high = (x[axis] >> level) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(high, low, swap)
            x[axis] ^= swap
    for axis in range(1, dims):
        x[axis] ^= x[axis - 1]
    flip = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= ((x[-1] >> level) & 1) * ((1 << level) - 1)
    x ^= flip
    index = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(dims):
            index = index << 1 | (x[axis] >> level) & 1
    return index


def order_key(name: str) -> Column:
    """All bytes of a string behind a mark, so that null comes before the empty string."""
    return F.coalesce(F.concat(F.lit(b"\1"), F.col(name).cast("binary")), F.lit(b""))


def ranked_bins(named: DataFrame, name: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Least value and number of every used bin of a binary column.

    A value's bin is the place of its middle row among all rows, so values with
    a bin's worth of rows never share one.
    """
    run = stored(named.groupBy(F.col(name).alias("v")).agg(F.count(F.lit(1)).alias("n"))
                 .repartitionByRange("v").withColumn("_part", F.spark_partition_id()), "values")
    # One row per range partition.
    starts, total = [], 0
    for r in run.groupBy("_part").agg(F.sum("n").alias("n")).orderBy("_part").collect():
        starts.append((r["_part"], total))
        total += r["n"]
    before = F.sum("n").over(Window.partitionBy("_part").orderBy("v")) + F.col("_start")
    starts = named.sparkSession.createDataFrame(starts, "_part int, _start long")
    bins = (run.join(F.broadcast(starts), "_part").withColumn("upto", before)
            .withColumn("bin", F.expr(f"int((2 * upto - n) * {1 << bits} div {max(2 * total, 1)})"))
            .groupBy("bin").agg(F.min("v").alias("v")))
    # At most 2**bits rows.
    found = sorted((r["bin"], bytes(r["v"])) for r in bins.collect())
    discard(run)
    least = np.empty(len(found), object)
    least[:] = [v for _, v in found]
    return least, np.array([k for k, _ in found], np.int64)


def place(docs: DataFrame, dimensions: dict[str, Column], bits: int = BITS) -> DataFrame:
    """``docs`` with ``hilbert``, the index of the quantised dimensions.

    Binary dimensions are ranked over their whole values, others as doubles.
    """
    named = docs.withColumns({f"_d_{k}": v for k, v in dimensions.items()})
    ranked = {k: isinstance(named.schema[f"_d_{k}"].dataType, T.BinaryType) for k in dimensions}
    named = named.withColumns({f"_d_{k}": F.col(f"_d_{k}").cast("double") for k, by_rank in ranked.items() if not by_rank})
    cuts = [(k + 1) / (1 << bits) for k in range((1 << bits) - 1)]
    # The bin limits are 2**bits - 1 numbers for each dimension.
    limits = named.agg(F.lit(0), *(F.percentile_approx(f"_d_{k}", cuts, 10_000).alias(k) for k, by_rank in ranked.items() if not by_rank)).first()
    edges = [ranked_bins(named, f"_d_{k}", bits) if by_rank else np.unique(limits[k]) if limits[k] else np.zeros(0) for k, by_rank in ranked.items()]

    def bins_of(edge, axis: pd.Series) -> np.ndarray:
        if not isinstance(edge, tuple):
            return np.searchsorted(edge, axis.to_numpy(float))
        least, bins = edge
        return bins[np.searchsorted(least, axis.to_numpy(object), "right") - 1]

    @F.pandas_udf("long")
    def index(*axes: pd.Series) -> pd.Series:
        bins = np.array([bins_of(e, a) for e, a in zip(edges, axes, strict=True)])
        return pd.Series(hilbert_index(bins, bits))

    return named.withColumn("hilbert", index(*(f"_d_{k}" for k in dimensions))).drop(*(f"_d_{k}" for k in dimensions))


def shard_documents(docs: DataFrame, shards: int, carry: list[str] | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, hilbert, shard, slot`` of every document.

    With ``carry``, those columns travel along in a struct ``row``.
    """
    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    row = [] if carry is None else [F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row")]
    meta = docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), *row)
    placed = place(meta, {"lang": order_key("lang"), "source": order_key("source"), "size": F.col("size")})
    keys = ("hilbert", "text_crc32", "doc_id")
    run = stored(placed.drop("lang", "source").repartitionByRange(*keys).sortWithinPartitions(*keys)
                 .withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "curve")
    # One row per range partition.
    counts, start = [], 0
    for r in run.groupBy("_part").count().orderBy("_part").collect():
        counts.append((r["_part"], start))
        start += r["count"]
    starts, total = docs.sparkSession.createDataFrame(counts, "_part int, _start long"), max(start, 1)
    return (run.join(F.broadcast(starts), "_part").withColumn("shard", F.expr(f"int((_start + _row) * {shards} div {total})"))
            .withColumn("slot", F.expr(f"_start + _row - (shard * bigint({total}) + {shards - 1}) div {shards}"))
            .drop("_part", "_row", "_start"))


def write_shards(docs: DataFrame, path: str, shards: int) -> None:
    """Write ``docs`` as one folder per shard, in curve order."""
    (shard_documents(docs, shards, docs.columns).select("row.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
     .repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot").write.partitionBy("_shard").parquet(path))
