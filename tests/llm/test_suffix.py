"""Suffix-array dedup against brute force."""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidemark.llm import chunks, queries
from tidemark.llm import suffix_dedup as S

SF = "/root/testdata/sf0.001"
NAMES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def brute(rows):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 100, int)
        for k in range(len(raw) - 99):
            if (w := raw[k:k + 100]) in seen:
                gone[k] += 1
                gone[k + 100] -= 1
            seen.add(w)
        flags = np.cumsum(gone)[:len(raw)] > 0
        kept = bytes(b for b, f in zip(raw, flags, strict=True) if not f)
        out.append((i, len(raw), int(flags.sum()), int((flags & ~np.concatenate(([False], flags[:-1]))).sum()) if len(raw) else 0, hashlib.sha256(kept).hexdigest()))
    return out


def found(df):
    return sorted(tuple(r[n] for n in NAMES) for r in df.collect())


def test_op6(spark):
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    assert found(queries.op6_suffix_arrays(spark, SF)) == brute(zip(t["doc_id"], t["text"], strict=True))


def test_suffix_arrays_and_common_prefixes():
    rng = np.random.default_rng(1)
    for text in (rng.integers(97, 99, 700), np.zeros(300), np.tile(rng.integers(0, 256, 37), 20), rng.integers(0, 256, 500), np.zeros(1)):
        text = text.astype(np.uint8)
        order, words = S.suffix_array(text)
        raw = text.tobytes()
        tail = lambda k: raw[k:]
        assert sorted(order) == list(range(len(text)))
        got = [tail(k) for k in order]
        assert got == sorted(got)
        shared = S.common_prefixes(words, order, 50, lanes=7)
        for a, b, n in zip(order, order[1:], shared[1:]):
            want = next((k for k in range(50) if max(a, b) + k >= len(raw) or raw[a + k] != raw[b + k]), 50)
            assert n == want


@pytest.fixture(scope="module")
def crossed():
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdé"), rng.integers(1, 7)))
    passages = [" ".join(word() for _ in range(60)) for _ in range(6)]
    rows = []
    for k in range(160):
        parts = [" ".join(word() for _ in range(rng.integers(0, 40)))]
        for _ in range(rng.integers(0, 4)):
            p = passages[rng.integers(6)]
            a = rng.integers(0, len(p) // 2)
            parts += [p[a:a + rng.integers(60, 300)], word()]
        rows.append((k, " ".join(parts)))
    rows += [(200, None), (201, ""), (202, "x" * 99), (203, "x" * 100), (204, "x" * 350), (205, "ab" * 300), (206, rows[3][1]), (207, rows[3][1] + "!"),
             (208, "é" * 200), (209, "zé" + "é" * 120), (210, "short")]
    order = rng.permutation(len(rows))
    return [rows[k] for k in order]


def test_across_shards(spark, crossed, monkeypatch):
    want = brute(crossed)
    many = spark.createDataFrame(crossed, "doc_id long, text string").repartition(9)
    assert found(S.remove_repeats(many, [])) == want
    one = spark.createDataFrame(crossed, "doc_id long, text string").coalesce(1)
    assert found(S.remove_repeats(one, [])) == want


def test_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(60_000))
    rows = [(None, "n" * 150, 1, "b"), (1, None, 1, "b"), (2, long, 7, None), (3, long, None, "b"), (4, "é" * 90, 90, "b"), (4, "é" * 90, 90, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, batch string")
    got = sorted(found(S.remove_repeats(docs, ["batch"]).where("doc_id is not null")))
    assert [(g[0], g[1], g[2]) for g in got] == [(1, 0, 0), (2, len(long), 0), (3, len(long), len(long)), (4, 180, 178), (4, 180, 180)]
    back = S.dedup_documents(docs)
    assert back.schema == docs.schema or [f.dataType for f in back.schema] == [f.dataType for f in docs.schema]
    texts = {r["doc_id"]: r["text"] for r in back.collect()}
    assert texts[1] is None and texts[2] == long and texts[3] == ""
    assert S.remove_repeats(docs.limit(0), []).count() == 0


def test_chunks_keep_every_row(spark, monkeypatch):
    rows = [(k % 7, "t" * (k * 37 % 5000)) for k in range(300)]
    packed = chunks.chunked(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()
    got = []
    for c in packed:
        data, offsets = chunks.unpacked(c.asDict())
        assert c["doc_ids"] == sorted(c["doc_ids"]) and [r["doc_id"] for r in c["rows"]] == c["doc_ids"]
        got += [(i, data[a:b].tobytes().decode()) for i, a, b in zip(c["doc_ids"], offsets, offsets[1:])]
    assert sorted(got) == sorted(rows)


def test_workers_give_memory_back_after_each_task_and_group(spark, monkeypatch):
    """Only some steps did: idle workers of the others added up beside the executor's heap (pipeline, op1)."""
    from tidemark.llm import deleted_interpolation, tables

    group = tables.lean_groups(lambda table: table)
    freed = []
    monkeypatch.setattr(tables, "release", lambda: freed.append(1))
    assert group(pa.table({"a": [1]})).num_rows == 1 and freed == [1]
    made = []
    for module in (S, deleted_interpolation):
        for name in ("lean", "lean_groups"):
            wrap = getattr(tables, name)
            monkeypatch.setattr(module, name, lambda run, wrap=wrap, name=name: made.append((name, run.__qualname__.split(".")[0])) or wrap(run))
    docs = spark.createDataFrame([(1, "one two"), (2, "one two three"), (10, None)], "doc_id long, text string")
    tables.prepare(spark)
    assert deleted_interpolation.score_documents(docs).count() == 3
    assert S.remove_repeats(docs, ["doc_id"]).count() == 3
    assert {("lean", n) for n in ("_publish", "_held_out_cells", "_score", "_sort_windows", "_finish")} \
        | {("lean_groups", "_sum_range"), ("lean_groups", "_merge")} <= set(made)


def test_anchors_fill_the_key_ranges_evenly():
    """Least hashes are small: the first of 64 ranges had two thirds of the anchors, at any size (pipeline, op6)."""
    data = np.random.default_rng(3).integers(97, 123, 300_000).astype(np.uint8)
    s = S.stretches(data, np.array([0, 200_000, 300_000]))
    assert len(s["anchor"]) > 5000
    for column in ("anchor", "text"):
        assert np.bincount((s[column] >> np.uint64(58)).astype(np.int64)).max() < 2 * len(s[column]) / 64


def test_windows_are_hashed_by_bounded_stretches_of_the_text(monkeypatch):
    """A worker hashed the whole shard at once and kept the powers for it."""
    data = np.random.default_rng(4).integers(97, 100, 3 * S.CACHE_BYTES).astype(np.uint8)
    at = np.concatenate((np.arange(0, len(data) - S.LENGTH, 977), [len(data) - S.LENGTH]))
    want = S.X.SpanHash(data, longest=S.LENGTH)(at, at + S.LENGTH)
    sizes, whole = [], S.X.SpanHash
    monkeypatch.setattr(S.X, "SpanHash", lambda part, **kw: sizes.append(len(part)) or whole(part, **kw))
    assert (S._fingerprints(data, at) == want).all() and len(S._fingerprints(data, at[:0])) == 0
    assert len(sizes) == 3 and max(sizes) <= S.CACHE_BYTES + S.LENGTH


def test_chunk_files_have_row_groups_of_bounded_size(spark):
    """All rows of a file were in one row group and one page, which goes whole through the codec's buffers."""
    letters = np.random.default_rng(5).integers(97, 123, (12, 1 << 20)).astype(np.uint8)
    docs = spark.createDataFrame([(k, t.tobytes().decode()) for k, t in enumerate(letters)], "doc_id long, text string").coalesce(1)
    packed = chunks.chunked(docs, ["doc_id", "text"])
    groups = [pq.ParquetFile(f.removeprefix("file:")).metadata.num_row_groups for f in packed.inputFiles()]
    assert sum(groups) > 1 and sum(len(r["doc_ids"]) for r in packed.select("doc_ids").collect()) == 12
