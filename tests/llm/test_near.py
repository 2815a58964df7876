"""Weighted MinHash near-duplicates against brute force."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemark.llm import bagminhash as B
from tidemark.llm import queries
from tidemark.llm.text import text_bytes

import pyarrow as pa

SF = "/root/testdata/sf0.001"


def multiset(text):
    words = (text or "").encode().lower().split()
    if 0 < len(words) < 5:
        return Counter([tuple(words)])
    return Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))


def overlap(a, b):
    both = sum((a & b).values())
    return both / max(sum(a.values()) + sum(b.values()) - both, 1)


def brute(rows):
    """doc_id -> least doc_id of its class, over (doc_id, text) rows."""
    sets = [(i, t, multiset(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for k, (_, _, s) in enumerate(sets):
        for e in s:
            where[e].append(k)
    near = {(a, b) for ks in where.values() for a in ks for b in ks if a < b}
    for a, b in near:
        if overlap(sets[a][2], sets[b][2]) >= 0.8:
            parent[root(a)] = root(b)
    least = {}
    for k, (i, _, _) in enumerate(sets):
        least[root(k)] = min(least.get(root(k), i), i)
    return sorted((i, least[root(k)]) for k, (i, _, _) in enumerate(sets))


def mutated(rng, base, share):
    return " ".join(w if rng.random() > share else f"x{rng.integers(1 << 30)}" for w in base.split())


@pytest.fixture(scope="module")
def crowd():
    """Chains of near copies around some bases, at similarities about the threshold."""
    rng = np.random.default_rng(11)
    rows = []
    for share, copies, words in ((0.01, 120, 150), (0.02, 150, 150), (0.03, 60, 300), (0.2, 30, 80)):
        base = " ".join(f"w{rng.integers(400)}" for _ in range(words))
        rows += [mutated(rng, base, share) for _ in range(copies)]
    rows += ["a b c a b c a b c a b c a b c", "a b c a b c a b c a b c", "A b C", "a b c", "", None, " \n", "", "zz"]
    return list(enumerate(rows))


def test_registers_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    a = {int(k): int(w) for k, w in zip(rng.integers(0, 1 << 48, 300), rng.integers(1, 12, 300), strict=True)}
    b = {k: max(1, w + int(rng.integers(-3, 4))) for k, w in list(a.items())[:250]}
    want = sum(min(w, b.get(k, 0)) for k, w in a.items()) / (sum(max(w, b.get(k, 0)) for k, w in a.items()))

    def sign(m):
        keys = np.array(sorted(m), np.uint64)
        return B.signatures(np.zeros(len(m), np.int64), keys, np.array([m[int(k)] for k in keys]), 1, 4000)[0]

    assert abs((sign(a) == sign(b)).mean() - want) < 0.03
    assert (sign(a) == sign(a)).all()


def test_shingles_are_the_multiset():
    texts = ["a b c d e a b c d e a b c d e", "x", "", "é é é é é é"]
    row, _, count, words = B.shingles(*text_bytes(pa.array(texts)))
    for k, t in enumerate(texts):
        assert sorted(count[row == k]) == sorted(multiset(t).values())
    assert list(words) == [15, 1, 0, 6]


def test_op9(spark):
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    got = queries.op9_bagminhash(spark, SF).collect()
    assert sorted((r["doc_id"], r["class_id"]) for r in got) == brute(zip(t["doc_id"], t["text"], strict=True))


def test_crowds(spark, crowd, monkeypatch):
    docs = spark.createDataFrame(crowd, "doc_id long, text string")
    want = brute([(i, t) for i, t in crowd])
    got = B.classes(docs).collect()
    assert sorted((r["doc_id"], r["class_id"]) for r in got) == want
    kept = B.keep_one(docs).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted({c for _, c in want})


def test_block_links_find_the_same_components(crowd):
    sets, labels = [], []
    for k, (_, t) in enumerate(crowd[:330]):
        row, shingle, count, _ = B.shingles(*text_bytes(pa.array([t])))
        sets.append(B.element_set(shingle, count))
        labels.append(k)
    links = B.block_links(sets, labels)
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    least = {}
    for k in range(len(sets)):
        least.setdefault(root(k), k)
    assert sorted((k, least[root(k)]) for k in range(len(sets))) == brute(crowd[:330])


def test_odd_rows(spark):
    rows = [(None, "one two three four five six", "k"), (3, "one two three four five six", "k"), (3, "one two three four five six", "k"),
            (None, "alone", None), (5, None, "k"), (5, None, "k"), (7, "q " * 50_000, "k"), (2, "ONE two three four five six", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = B.classes(docs).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == Counter([(None, 2), (3, 2), (3, 2), (None, None), (5, 5), (5, 5), (7, 7), (2, 2)])
    kept = B.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([2, None, 5, 5, 7])
    assert B.classes(docs.limit(0)).count() == 0 and B.keep_one(docs.limit(0)).count() == 0
