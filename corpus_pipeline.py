"""A training-data pipeline: documents in, token digests out.

``STAGES`` run in order; each takes what its predecessor kept. ``run`` writes
every stage's output under ``spark.checkpoint.dir`` and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bagminhash, bpe_transducer, decontaminate, outliers, suffix_dedup
from tidemark.llm.queries import vocabulary
from tidemark.llm.tables import documents, prepare, stored, sweep


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return outliers.keep_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bagminhash.keep_one(docs)


def suffix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    sweep(spark)  # near-dedup shuffles the most
    return suffix_dedup.dedup_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe_transducer.token_digests(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("near-dedup", near_dedup),
    ("suffix-array dedup", suffix),
    ("benchmark decontamination", decontamination),
    ("BPE encoding", encode),
]

#: Robust estimates, signatures and byte-pair merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return docs
