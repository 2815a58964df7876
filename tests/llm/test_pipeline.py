"""The pipeline's stages, each on what its predecessor kept."""

import corpus_pipeline
import pyarrow.parquet as pq
from test_contracts import tokenizer
from test_near import brute as near_classes
from test_suffix import brute as suffix_rows

from tidemark.llm import decontaminate as D
from tidemark.llm import outliers
from tidemark.llm.tables import stored

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], SF), "stage"))
    assert all(t.columns == docs.columns for t in tables[:-1])
    texts = [{r["doc_id"]: r["text"] for r in t.collect()} for t in tables[:-1]]

    judged = {r["row"]["doc_id"]: r["kept"] for r in outliers.quality_outliers(docs, ["doc_id"]).collect()}
    assert set(texts[1]) == {i for i, k in judged.items() if k} and len(texts[1]) < len(texts[0])
    assert set(texts[2]) == {c for _, c in near_classes(texts[1].items())}
    cut = {r[0]: r for r in suffix_rows(texts[2].items())}
    assert set(texts[3]) == set(texts[2])
    assert all(texts[3][i] == texts[2][i] for i, r in cut.items() if not r[2])
    assert all(len(texts[3][i].encode()) <= r[1] - r[2] for i, r in cut.items())
    items = [D.plain(t) for t in pq.read_table(f"{SF}/benchmark.parquet")["text"].to_pylist()]
    assert not any(i in D.plain(t) for t in texts[4].values() for i in items)
    assert {i for i, t in texts[3].items() if any(x in D.plain(t) for x in items)} <= set(texts[3]) - set(texts[4])
    tok = tokenizer("word_bpe_49k.json")
    assert {r["doc_id"]: r["n_tokens"] for r in tables[5].collect()} == {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in texts[4].items()}


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "stage")
    assert docs.count() == 0
