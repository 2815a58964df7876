"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import discard, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of every node to the least of them.

    Large star: larger neighbours only; small star: smaller ones and the node.
    """
    if large:
        near = edges.union(edges.select("v", "u"))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = near.join(least, "u")
    if large:
        out = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` (the least node of its component) for nodes with an edge.

    ``edges`` has two columns ``u`` and ``v`` of one orderable type. Each round
    is written out, and ends when a round changes nothing.
    """
    now, before = stored(edges.where("u != v").distinct(), "edges"), None
    while True:
        last, now = now, stored(_star(_star(now, True), False), "edges")
        discard(last)
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(now.select("v", "v").distinct())
