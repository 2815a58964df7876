"""Top-k search, phrases and spelling variants against brute force and awkward rows."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.llm import phrases, queries, spelling, voronoi

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, n string, word string, code string, rank string"


def doc_rows(spark, rows):
    return spark.createDataFrame([(i, t, g, "n", "w", "c", "r") for i, t, g in rows], DOCS)


def tables(con, spark, **frames):
    for name, df in frames.items():
        con.register(name, df.toPandas())


# --- op11


def brute_top(rows, k):
    rows = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) and abs(x) < 2 ** 17 for x in v)]
    ints = [[int(np.floor(256 * float(x))) for x in v] for _, v in rows]
    out = []
    for a, (i, _) in enumerate(rows):
        if i % 50 == 0:
            found = sorted((-sum(x * y for x, y in zip(ints[a], ints[b], strict=False)), j) for b, (j, _) in enumerate(rows) if b != a)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


def topk(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, row int, score double")
    return sorted(map(tuple, voronoi.top_products(df, F.col("vec_id") % 50 == 0, k).collect()))


def test_topk_query_equals_its_sql(spark):
    got = sorted(map(tuple, queries.op11_voronoi_topk(spark, SF).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert got == sorted(con.execute(queries.ORACLE["op11_voronoi_topk"]).fetchall())


def test_topk_of_clustered_vectors_excludes_cells_and_stays_exact(spark, monkeypatch):
    monkeypatch.setattr(voronoi, "ROWS_PER_PIVOT", 40)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16)) * 5
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * 0.05).astype(np.float32).tolist()) for i in range(900)]
    assert topk(spark, rows) == brute_top(rows, 5)
    cells = voronoi.Cells(np.floor(256 * centres), int((np.floor(256 * np.array([v for _, v in rows])) ** 2).sum(axis=1).max()) + 1)
    x = np.floor(256 * np.array([v for _, v in rows])).astype(np.int64)
    far = cells.candidates(x)
    home = far.argmin(axis=1)
    cells.summarise([{"cell": c, "rows": int((home == c).sum()), "least": far[home == c, c].min(), "greatest": far[home == c, c].max()} for c in range(12)])
    scores = x[::50] @ x.T
    need = cells.needed(x[::50], home[::50], np.sort(scores, axis=1)[:, -6].astype(float))
    assert need.mean() < 0.5


def test_topk_of_awkward_vectors(spark):
    rows = [(0, [0.5, 0.25]), (50, [0.5, 0.25]), (50, [0.5, 0.25]), (1, [0.5, 0.25]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]),
            (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, []), (7, [-1.0]), (8, [1e9, 1.0]), (9, [100000.0, -100000.0, 3.0]), (100, [-0.001, 0.0])]
    assert topk(spark, rows) == brute_top(rows, 5)
    assert topk(spark, rows[:1]) == [] and topk(spark, []) == []


# --- op12


def phrase_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    return sorted(con.execute(queries.ORACLE["op12_era_phrases"]).fetchall())


@pytest.mark.parametrize("prefix", [phrases.PREFIX, 40])
def test_phrases_equal_their_sql(spark, prefix):
    rows = [(i, t, g) for i, t, g in zip(*(pq.read_table(f"{SF}/documents.parquet")[c].to_pylist() for c in ("doc_id", "text", "lang")), strict=True)]
    rows += [(10_000 + i, "Of the people by the people; OF THE people\tfor the\x0bpeople of the: the the the the", None) for i in range(40)]
    got = sorted(map(tuple, phrases.collocations(doc_rows(spark, rows), prefix=prefix, group=prefix * 4).collect()))
    assert got == phrase_sql(rows) and len(got) > 10


def test_phrases_of_awkward_rows(spark):
    long = "alpha beta gamma. " * 30_000
    rows = [(1, None, "en"), (2, "", "en"), (None, "a b", None), (3, long, "en"), (3, long, "en"), (4, " .,; \n\t", "x\ty"), (5, "É é ß\u0085x a b\n" * 35, "x\ty")]
    got = sorted(map(tuple, phrases.collocations(doc_rows(spark, rows)).collect()))
    assert got == phrase_sql(rows) and any(r[0] == "x\ty" for r in got)
    assert phrases.collocations(doc_rows(spark, [])).collect() == []


def test_scores_past_64_bits(spark):
    f = spark.createDataFrame([(10 ** 13, 10 ** 13, 10 ** 13)], "f long, l long, r long")
    assert f.select(F.expr(f"CAST(f AS DECIMAL(20,0)) * {phrases.SCALE} DIV (CAST(l AS DECIMAL(20,0)) + r)")).first()[0] == 1_000_000


# --- op13


def brute_variants(rows):
    count, upper = Counter(), str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = word.translate(upper)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 31 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            count[word] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    wild, near = defaultdict(set), defaultdict(set)
    for w in words:
        for k in range(len(w)):
            x = w[:k] + w[k + 1:]
            wild[w[:k], w[k + 1:]].add(w)
            if x in words:
                near[w].add(x)
                near[x].add(w)
    for same in wild.values():
        for w in same if len(same) > 1 else ():
            near[w] |= same - {w}
    form = {w: min(near[w], key=lambda x: (-words[x], x)) for w in words if near[w]}
    form = {w: f for w, f in form.items() if words[f] >= 10 * words[w]}
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None)
    return out


def spelled(spark, rows):
    return {r["word"]: tuple(r) for r in spelling.variants(doc_rows(spark, [(i, t, "en") for i, t in rows])).collect()}


def test_variants_equal_brute_force(spark):
    rows = list(zip(*(pq.read_table(f"{SF}/documents.parquet")[c].to_pylist() for c in ("doc_id", "text")), strict=True))
    got = spelled(spark, rows)
    assert got == brute_variants(rows) and sum(r[4] for r in got.values()) > 100


@pytest.mark.parametrize("group", [spelling.GROUP, 8])
def test_crowded_halves_and_chains(spark, monkeypatch, group):
    monkeypatch.setattr(spelling, "GROUP", group)
    rng = np.random.default_rng(5)
    words = {"".join(rng.choice(list("ab"), int(rng.integers(7, 10)))) for _ in range(150)} | {"aaaaaaa", "aaaaaaaa", "aaaaaaab"}
    rows = [(1, " ".join([w] * int(rng.choice([1, 2, 3, 30, 400])))) for w in sorted(words)]
    assert spelled(spark, rows) == brute_variants(rows)


def test_variants_of_awkward_rows(spark):
    long = "Interna×tional" * 5_000
    rows = [(1, None), (2, ""), (None, "spelling Spelling spellings spellings"), (3, long + " " + long), (4, long[:-1] + "m " + long[:-1] + "m"),
            (5, "ÉCLAIRCIE Éclaircie éclaircie éclaircie"), (5, "ÉCLAIRCIE Éclaircie éclaircie éclaircie"), (6, "short words on ly 1234567 1234567")]
    assert spelled(spark, rows) == brute_variants(rows)
    assert spelled(spark, []) == {}
