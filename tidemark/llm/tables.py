"""Tables and packed arrays that the operators pass between their steps."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import work_dir


#: Parquet looks at the size of pages and row groups every hundred rows. Where rows
#: have megabytes that is every one: a page goes whole through the codec's direct
#: buffers, which executors keep, and a row group through the heap.
LARGE_ROWS = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1"}


def stored(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written under ``spark.checkpoint.dir`` and read back: cuts lineage."""
    path = work_dir(df.sparkSession, name)
    df.write.options(**(options or {})).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that no later step reads."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def sweep(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps: it does once their plans are garbage."""
    gc.collect()
    spark._jvm.System.gc()


def prepare(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that long texts do not add up in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def release() -> None:
    """Give freed memory of this worker process back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:  # another C library
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, giving memory back at its end.

    Workers stay alive between tasks, several for each core; what they keep
    adds up beside the executor's heap.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return task


def lean_groups(run: Callable[[pa.Table], pa.Table]):
    """``run`` for ``applyInArrow``, giving memory back after each group."""
    def group(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            release()

    return group


def planes(values: np.ndarray) -> bytes:
    """Compress fixed-size integers plane by plane (all first bytes, all second ...)."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw.T).tobytes())


def unplaned(blob: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted 64-bit values as differences, plane by plane."""
    return planes(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unplaned(blob, np.uint64), dtype=np.uint64)
