"""Documents packed into chunk rows, which carry their own identity.

A chunk is a bounded amount of text from one partition, sorted by ``doc_id``
and stored once. Every later step reads chunk rows and names them by
``batch``, so it does not depend on how a scan is split or retried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import text as X
from tidemark.llm.tables import LARGE_ROWS, lean, stored

CHUNK_BYTES = 4 << 20
NO_ID = -(1 << 63)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, made = TaskContext.get().partitionId(), 0
    held: dict[int, list[pa.RecordBatch]] = {}
    size: dict[int, int] = {}

    def flush(fold: int) -> pa.RecordBatch:
        nonlocal made
        rows = pa.Table.from_batches(held.pop(fold)).combine_chunks()
        size.pop(fold)
        order = np.argsort(rows["doc_id"].fill_null(NO_ID).to_numpy(), kind="stable")
        rows = rows.take(pa.array(order)).combine_chunks()
        data, offsets = X.text_bytes(rows["text"].combine_chunks() if rows.num_rows else rows["text"])
        made += 1
        row = rows["row"].combine_chunks()
        row = row.chunk(0) if isinstance(row, pa.ChunkedArray) else row
        return pa.RecordBatch.from_arrays(
            [pa.array([part << 32 | made], pa.int64()), pa.array([fold], pa.int32()), pa.array([len(data)], pa.int64()),
             pa.array([rows["doc_id"].to_pylist()], pa.list_(pa.int64())), pa.array([np.diff(offsets)], pa.list_(pa.int64())),
             pa.ListArray.from_arrays(pa.array([0, len(row)], pa.int32()), row),
             pa.array([zstandard.ZstdCompressor(level=3).compress(data.tobytes())], pa.binary())],
            names=["batch", "fold", "n_bytes", "doc_ids", "lengths", "rows", "payload"])

    for batch in batches:
        folds = batch.column("fold").to_numpy()
        for fold in np.unique(folds).tolist():
            mine = batch.filter(pa.array(folds == fold))
            _, offsets = X.text_bytes(mine.column("text"))
            for i, j in X.slices(offsets, CHUNK_BYTES // 4):
                part_bytes = int(offsets[j] - offsets[i])
                if fold in size and size[fold] + part_bytes > CHUNK_BYTES:
                    yield flush(fold)
                held.setdefault(fold, []).append(mine.slice(i, j - i))
                size[fold] = size.get(fold, 0) + part_bytes
    for fold in list(held):
        yield flush(fold)


def chunked(docs: DataFrame, carry: list[str], fold: Column | None = None) -> DataFrame:
    """Stored chunk rows of all documents; a chunk has documents of one fold."""
    source = docs.select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in carry)).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text"), (F.lit(0) if fold is None else fold).cast("int").alias("fold"))
    schema = T.StructType([T.StructField("batch", T.LongType()), T.StructField("fold", T.IntegerType()), T.StructField("n_bytes", T.LongType()),
                           T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.LongType())),
                           T.StructField("rows", T.ArrayType(source.schema["row"].dataType)), T.StructField("payload", T.BinaryType())])
    return stored(source.mapInArrow(lean(_pack), schema), "chunks", LARGE_ROWS)


def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of batches as dictionaries; only one at a time is copied out of its batch."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def unpacked(chunk: dict) -> tuple[np.ndarray, np.ndarray]:
    """Text bytes and row offsets of a chunk row."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(chunk["payload"]), np.uint8)
    return data, np.concatenate(([0], np.cumsum(np.array(chunk["lengths"], np.int64)))).astype(np.int64)


def bucket_bits(chunks: DataFrame, bytes_per_entry: int, entries: int = 1 << 19) -> int:
    """Bits of the key space's buckets, so that each gets about ``entries`` keys."""
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(6, int(total / bytes_per_entry / entries).bit_length())


def cuts(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket's keys begin in a sorted array."""
    limits = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.append(np.searchsorted(keys, limits), len(keys))
