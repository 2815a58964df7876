"""Exact top-k inner products by a Voronoi kNN join.

Vectors are turned into integers (``floor(scale * x)``) and lifted by one
coordinate, ``sqrt(M**2 - |x|**2)`` for candidates and 0 for queries, M being
the largest norm. Then the highest inner products are the nearest neighbours,
and the triangle inequality holds.

A bounded number of pivots cuts the space into Voronoi cells. Summaries of the
cells (rows, least and greatest distance to the pivot) come from one
aggregation. Each query is first solved inside its own cell, which gives the
distance of its k-th neighbour there. A query is then copied only to the cells
that this distance does not exclude: by the ring between least and greatest
distance, or by the half space between two pivots. Cells are split into blocks
of bounded size, and a task holds one block while queries stream past it.

Pivots are chosen from the whole table by a hash; ``MAX_PIVOTS`` and
``PIVOT_BYTES`` bound what the driver and each task hold. They decide speed
only: every candidate is compared or excluded by a bound, and all scores are
exact integers. When the bounds exclude nothing (vectors spread evenly in many
dimensions) every query meets every block: the work is then queries x rows.

Defined cases: rows whose id or vector is null, or whose vector has a null or
non-finite component or one of 2**17 and more in size (scores could pass 64
bits), take no part; a shorter vector counts as ended by zeros; rows with equal
ids are rows of their own (only the query's own row is left out); ties go to
the smaller id; fewer candidates than k are all returned; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored

SCALE, LIMIT = 256, 1 << 17
MAX_PIVOTS, PIVOT_BYTES = 1024, 8 << 20
#: Rows of a cell that one block holds, and rows that call for a pivot of their own.
BLOCK, ROWS_PER_PIVOT = 8192, 800
#: Queries that are compared with a block at once.
STEP = 256


def integer_vectors(rows: DataFrame, vec_id: str, vector: str, scale: int = SCALE) -> DataFrame:
    """Stored ``row, vec_id, x`` with integer components, of the rows that take part."""
    whole = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    fits = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT))
    good = rows.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), whole.alias("x")).where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & fits)
    return stored(good.select(F.monotonically_increasing_id().alias("row"), "vec_id",
                              F.transform("x", lambda x: F.floor(x * scale).cast("int")).alias("x")), "vectors")


def _dense(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as a matrix; shorter rows end in zeros."""
    lengths = column.value_lengths().to_numpy()
    out = np.zeros((len(column), dim), np.int64)
    out[np.arange(dim) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; by floating point where every sum stays below 2**53."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    top = [float(np.sqrt((m.astype(np.float64) ** 2).sum(axis=1).max())) for m in (a, b)]
    if top[0] * top[1] < 2.0 ** 52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class Cells:
    """Pivots and, once they are known, the summaries of their cells."""

    def __init__(self, pivots: np.ndarray, norm2: int):
        self.pivots, self.norm2, self.dim = pivots.astype(np.float64), float(norm2), pivots.shape[1]
        self.lift = np.sqrt(np.maximum(self.norm2 - (self.pivots ** 2).sum(axis=1), 0))
        gram = self.pivots @ self.pivots.T + np.outer(self.lift, self.lift)
        self.apart = np.sqrt(np.maximum(2 * self.norm2 - 2 * gram, 0))
        #: Rounding of distances is far below this part of the largest norm.
        self.slack = 1e-5 * float(np.sqrt(self.norm2)) + 1e-9

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """Distances of lifted candidates to all pivots."""
        x = x.astype(np.float64)
        lift = np.sqrt(np.maximum(self.norm2 - (x ** 2).sum(axis=1), 0))
        return np.sqrt(np.maximum(2 * self.norm2 - 2 * (x @ self.pivots.T + np.outer(lift, self.lift)), 0))

    def queries(self, q: np.ndarray) -> np.ndarray:
        q = q.astype(np.float64)
        return np.sqrt(np.maximum((q ** 2).sum(axis=1)[:, None] + self.norm2 - 2 * q @ self.pivots.T, 0))

    def summarise(self, rows: list) -> None:
        n = len(self.pivots)
        self.count, self.least, self.greatest = np.zeros(n, np.int64), np.full(n, np.inf), np.full(n, -np.inf)
        for r in rows:
            self.count[r["cell"]], self.least[r["cell"]], self.greatest[r["cell"]] = r["rows"], r["least"], r["greatest"]
        self.blocks = -(-self.count // BLOCK)

    def needed(self, q: np.ndarray, home: np.ndarray, kth: np.ndarray) -> np.ndarray:
        """Which cells may hold a candidate of score ``kth`` or more, for each query; never its home cell."""
        far = self.queries(q)
        # A score s lies at the lifted distance sqrt(|q|^2 + M^2 - 2 s); without k candidates nothing is excluded.
        radius = np.sqrt(np.maximum((q.astype(np.float64) ** 2).sum(axis=1) + self.norm2 - 2 * np.where(np.isnan(kth), -np.inf, kth), 0)) + self.slack
        need = (self.count > 0)[None, :] & (far - self.greatest[None, :] <= radius[:, None]) & (self.least[None, :] - far <= radius[:, None])
        between = self.apart[home]
        with np.errstate(divide="ignore", invalid="ignore"):
            beyond = (far ** 2 - far[np.arange(len(q)), home][:, None] ** 2) / (2 * between)
        need &= ~((between > self.slack) & (beyond > radius[:, None] + self.slack * (1 + np.sqrt(self.norm2) / np.maximum(between, self.slack))))
        need[np.arange(len(q)), home] = False
        return need


_DEALT = "row long, vec_id long, x array<int>, query boolean, cell int, far double, home int"


def _deal(cells: Cells):
    """Cell and distance of every candidate, and home cell of every query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _dense(batch.column("x"), cells.dim)
            far = cells.candidates(x)
            cell = far.argmin(axis=1)
            homes = np.where(cells.count > 0, cells.queries(x), np.inf).argmin(axis=1) if hasattr(cells, "count") else cell
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far[np.arange(len(x)), cell]), pa.array(homes.astype(np.int32))],
                                             names=["row", "vec_id", "x", "query", "cell", "far", "home"])

    return run


_VISIT = "cell int, block int, kind int, row long, vec_id long, x array<int>, floor long"


def _visits(cells: Cells, first: bool):
    """Copies of queries for the blocks they must meet: those of the home cell, or of all other needed cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            home = batch.column("home").to_numpy()
            if first:
                need = np.zeros((len(home), len(cells.count)), bool)
                need[np.arange(len(home)), home] = cells.count[home] > 0
                floor = pa.nulls(len(home), pa.int64())
            else:
                floor = batch.column("floor")
                need = cells.needed(_dense(batch.column("x"), cells.dim), home, floor.to_numpy(zero_copy_only=False).astype(np.float64))
            which, cell = np.nonzero(need)
            times = cells.blocks[cell]
            which, cell = np.repeat(which, times), np.repeat(cell, times)
            block = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
            for i in range(0, len(which), 4096):
                at = pa.array(which[i:i + 4096])
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[i:i + n].astype(np.int32)), pa.array(block[i:i + n].astype(np.int32)), pa.array(np.ones(n, np.int32)),
                     batch.column("row").take(at), batch.column("vec_id").take(at), batch.column("x").take(at), floor.take(at)],
                    names=["cell", "block", "kind", "row", "vec_id", "x", "floor"])

    return run


_FOUND = "query long, query_id long, row long, vec_id long, score long"


def _solve(dim: int, k: int):
    """Top k of each block for the queries that follow it in the sorted stream."""

    def best(block: list[np.ndarray], queries: list[tuple]) -> pa.RecordBatch:
        rows, ids, x = block
        q_row, q_id, q, floor = (np.concatenate(c) for c in zip(*queries, strict=True))
        out: list[tuple] = []
        for i in range(0, len(q_row), STEP):
            score = _products(q[i:i + STEP], x)
            own = rows[None, :] == q_row[i:i + STEP, None]
            # The k-th highest score of the block, then all rows at or above it: ties are settled by id.
            masked = np.where(own, np.iinfo(np.int64).min, score)
            at = masked.shape[1] - min(k, masked.shape[1])
            bar = np.maximum(np.partition(masked, at, axis=1)[:, at], floor[i:i + STEP])
            u, v = np.nonzero((masked >= bar[:, None]) & ~own)
            order = np.lexsort((rows[v], ids[v], -score[u, v], u))
            u, v = u[order], v[order]
            rank = np.arange(len(u)) - np.searchsorted(u, u)
            u, v = u[rank < k], v[rank < k]
            out.append((q_row[i + u], q_id[i + u], rows[v], ids[v], score[u, v]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "query_id", "row", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, block = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("cell").to_numpy().astype(np.int64) << 32 | batch.column("block").to_numpy()
            kind = batch.column("kind").to_numpy()
            edges = np.flatnonzero(np.diff(key * 2 + kind)) + 1
            for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(key)], strict=True):
                if key[i] != now:
                    now, parts, block = key[i], [], None
                part = batch.slice(i, j - i)
                row, vec, x = part.column("row").to_numpy(), part.column("vec_id").to_numpy(), _dense(part.column("x"), dim)
                if kind[i] == 0:
                    parts.append((row, vec, x))
                    continue
                if block is None and parts:
                    block = [np.concatenate(c) for c in zip(*parts, strict=True)]
                    parts = []
                if block is not None:
                    floor = part.column("floor").fill_null(np.iinfo(np.int64).min).to_numpy()
                    yield best(block, [(row, vec, x, floor)])

    return run


def _round(data: DataFrame, visits: DataFrame, dim: int, k: int) -> DataFrame:
    met = data.unionByName(visits).repartition("cell", "block").sortWithinPartitions("cell", "block", "kind")
    return met.mapInArrow(_solve(dim, k), _FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_products(rows: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest integer inner products of each query row with all other rows.

    ``is_query`` is a condition on ``vec_id``.
    """
    vectors = integer_vectors(rows, vec_id, vector, scale)
    norm2 = F.aggregate("x", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x)
    seen = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("dim"), F.max(norm2).alias("norm2")).first()
    dim = max(seen["dim"] or 1, 1)
    want = max(1, min(MAX_PIVOTS, PIVOT_BYTES // (8 * dim), seen["n"] // ROWS_PER_PIVOT))
    chosen = vectors.select("x").distinct().orderBy(F.xxhash64("x"), "x").limit(want).collect()  # bounded above
    pivots = np.zeros((max(len(chosen), 1), dim), np.int64)
    for i, r in enumerate(chosen):
        pivots[i, :len(r["x"])] = r["x"]
    cells = Cells(pivots, seen["norm2"] or 0)
    marked = vectors.withColumn("query", is_query)
    summary = (marked.mapInArrow(_deal(cells), _DEALT).groupBy("cell")
               .agg(F.count(F.lit(1)).alias("rows"), F.min("far").alias("least"), F.max("far").alias("greatest")))
    cells.summarise(summary.collect())  # one row for each pivot
    dealt = stored(marked.mapInArrow(_deal(cells), _DEALT), "dealt")
    blocks = F.element_at(F.array(*(F.lit(int(b)) for b in np.maximum(cells.blocks, 1))), F.col("cell") + 1)
    data = dealt.select("cell", F.pmod(F.xxhash64("row"), blocks).cast("int").alias("block"), F.lit(0).alias("kind"), "row", "vec_id", "x",
                        F.lit(None).cast("long").alias("floor"))
    queries = dealt.where("query").select("row", "vec_id", "x", "home")
    home = stored(_top(_round(data, queries.mapInArrow(_visits(cells, True), _VISIT), dim, k), k).drop("rank"), "home")
    floors = home.groupBy("query").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
    onward = queries.join(floors, queries["row"] == floors["query"], "left").drop("query")
    other = _round(data, onward.mapInArrow(_visits(cells, False), _VISIT), dim, k)
    return _top(home.unionByName(other), k).select(F.col("query_id"), "rank", "vec_id", "score")
