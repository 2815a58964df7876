"""Session settings every job relies on.

Only runtime SQL settings are changed on an existing session, so the helpers
work on a cluster session created elsewhere. ``work_dir`` resolves the shared
folder named by ``spark.checkpoint.dir``; a private temporary folder is
created only when that setting is absent and the session runs on one machine.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the warehouse semantics depend on.
RUNTIME_CONF = {
    # Extract timestamps are UTC instants; staging works on UTC wall clock.
    "spark.sql.session.timeZone": "UTC",
    # Bad casts fail instead of turning into nulls.
    "spark.sql.ansi.enabled": "true",
    # Partition replace touches only the partitions present in the output.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # A table is read by the folders of its current partitions: up to so many
    # are listed by the driver instead of a job.
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "512",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    If that is unset, a session on one machine (``local[...]``) gets a temporary
    folder, and any other raises: its executors would not see such a folder.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="tidemark-checkpoints-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for one job's tables."""
    return f"{checkpoint_root(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def stored_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder; ``stored_at`` names its place."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored
