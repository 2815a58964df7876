"""File-system helpers over the Hadoop FileSystem of the session.

Works for any URI Spark can write to (local, HDFS, object stores), so markers
and partition folders are handled the same way as the data.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import SparkSession


_handles: dict[str, tuple] = {}


def _fs(spark: SparkSession, path: str):
    """File system and path; the JVM classes are looked up once per application and scheme."""
    sc = spark.sparkContext
    key = f"{sc.applicationId} {path.split(':/', 1)[0] if ':/' in path else ''}"
    if key not in _handles:
        make = sc._jvm.org.apache.hadoop.fs.Path
        _handles[key] = (make, make(path).getFileSystem(sc._jsc.hadoopConfiguration()), sc._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths,
                         sc._jvm.scala.Predef.genericWrapArray, sc._jvm.org.apache.commons.io.IOUtils.toString)
    return _handles[key][1], _handles[key][0](path)


def _tools(spark: SparkSession, path: str) -> tuple:
    _fs(spark, path)
    sc = spark.sparkContext
    return _handles[f"{sc.applicationId} {path.split(':/', 1)[0] if ':/' in path else ''}"][2:]


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p) and fs.delete(p, True))


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file whole (manifests)."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return _tools(spark, path)[2](stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file beside ``path`` and rename it there; False if ``path`` exists."""
    fs, target = _fs(spark, path)
    if fs.exists(target):
        return False
    beside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rsplit('/', 1)[0]}/.tmp-{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    out.write(bytearray(text.encode()))
    out.close()
    return bool(fs.rename(beside, target))


def glob(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = _fs(spark, pattern)
    paths_of, wrapped, _ = _tools(spark, pattern)
    found = fs.globStatus(p)
    # One call for all names: file names hold no line feed.
    names = "" if found is None else wrapped(paths_of(found)).mkString("\n")
    return sorted(names.split("\n")) if names else []


def partition_values(spark: SparkSession, root: str, name: str) -> list[dt.date]:
    """Sorted dates of the ``name=YYYY-MM-DD`` folders directly under ``root``."""
    out = []
    for path in glob(spark, f"{root}/{name}=*"):
        value = path.rstrip("/").rsplit(f"{name}=", 1)[1]
        try:
            out.append(dt.date.fromisoformat(value))
        except ValueError:
            continue
    return sorted(out)


def size_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0
