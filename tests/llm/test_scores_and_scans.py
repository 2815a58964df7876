"""LM scores, decontamination and license scans against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemark.llm import decontaminate as D
from tidemark.llm import deleted_interpolation as LM
from tidemark.llm import licenses, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows():
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    return list(zip(t["doc_id"], t["text"], strict=True))


# --- LM scoring


def sequences(rows):
    out = []
    for i, t in rows:
        fold = zlib.crc32(("" if i is None else str(i)).encode()) % 10
        out.append((i, fold, [*(t or "").encode().lower().split(), None]))
    return out


def level(c):
    return int(math.log2(c)) + 1 if c else 0


def brute_scores(rows):
    """Exact EM over single tokens, then the scores."""
    docs = sequences(rows)
    uni, bi, ctx = Counter(), Counter(), Counter()
    d_uni, d_bi, d_ctx = Counter(), Counter(), Counter()
    for _, fold, seq in docs:
        if fold:
            for a, b in zip(["<s>", *seq], seq):
                uni[b] += 1
                bi[a, b] += 1
                ctx[a] += 1
                if fold == 9:
                    d_uni[b] += 1
                    d_bi[a, b] += 1
                    d_ctx[a] += 1
    n, v, m = sum(uni.values()), len(uni), sum(d_uni.values())
    held = defaultdict(list)
    for (a, b), k in d_bi.items():
        c = ctx[a] - d_ctx[a]
        held[level(c)].append((k, (bi[a, b] - k) / c if c else 0, (uni[b] - d_uni[b]) / max(n - m, 1), 1 / (v + 1)))
    weights = defaultdict(lambda: np.full(3, 1 / 3))
    for b, found in held.items():
        x = np.array(found)
        w = np.full(3, 1 / 3)
        for _ in range(LM.ROUNDS):
            share = w * x[:, 1:]
            got = (x[:, :1] * share / share.sum(axis=1, keepdims=True)).sum(axis=0) + 1 / 3
            w = got / got.sum()
        weights[b] = w
    out = {}
    for i, fold, seq in docs:
        base = sum(math.log10((uni[b] + 0.1) / (n + 0.1 * (v + 1))) for b in seq)
        score = sum(math.log10(weights[level(ctx[a])] @ np.array([bi[a, b] / ctx[a] if ctx[a] else 0, uni[b] / max(n, 1), 1 / (v + 1)]))
                    for a, b in zip(["<s>", *seq], seq))
        out[i] = (fold == 0, len(seq), sum(uni[b] > 0 for b in seq), n, base, score)
    return out


def check_scores(got, want):
    assert len(got) == len(want)
    for r in got:
        held, tokens, known, n, base, score = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, tokens, known, n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(score, rel=2e-3)


def test_op1(spark, rows):
    got = queries.op1_deleted_interpolation(spark, SF).collect()
    check_scores(got, brute_scores(rows))
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_scores_of_odd_rows(spark):
    rows = [(1, None, "k"), (2, "", "k"), (3, " \n", None), (4, "The the THE", "k"), (5, "a b " * 20_000, "k"), (None, "a b c", "k"),
            (11, "é É\u0085x a b", "k"), (21, "a b a", "k"), (23, "b a", "k"), *((k, f"a b c w{k}", "k") for k in range(100, 140))]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, fold string, batch int")
    check_scores(LM.score_documents(docs).collect(), brute_scores([r[:2] for r in rows]))
    assert LM.score_documents(docs.limit(0)).count() == 0
    only = LM.score_documents(docs.where("doc_id is null")).collect()
    assert only[0]["held_out"] and only[0]["train_tokens"] == 0 and only[0]["base_score"] == pytest.approx(0)
    twice = LM.score_documents(docs.where("doc_id = 4").union(docs.where("doc_id = 4"))).collect()
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0]["train_tokens"] == 8


# --- decontamination


def semi_global(item, text):
    return D.best_distances([np.frombuffer(item, np.uint8)], [np.frombuffer(text, np.uint8)])[0]


def plain_distance(item, text):
    """Cell by cell."""
    row = [0] * (len(text) + 1)
    for k, a in enumerate(item, 1):
        new = [k]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_best_distances():
    rng = np.random.default_rng(0)
    pairs = [[rng.integers(97, 100, rng.integers(1, 14)).astype(np.uint8) for _ in range(2)] for _ in range(80)]
    got = D.best_distances([a for a, _ in pairs], [b for _, b in pairs], at_once=7)
    assert got == [plain_distance(a.tobytes(), b.tobytes()) for a, b in pairs]


def found(df):
    return sorted((r["doc_id"], r["item_id"], r["edits"]) for r in df.collect())


def brute_matches(docs, items):
    """Every item against every whole text, all texts in one pass."""
    gap = b"\xff" * 500
    texts = [D.plain(t) for _, t in docs]
    joined = np.frombuffer(gap.join(texts) + gap, np.uint8)
    ends = np.cumsum([len(t) + len(gap) for t in texts])
    out = []
    for i, t in items:
        item = np.frombuffer(D.plain(t), np.uint8)
        if not len(item):
            continue
        row, step = np.zeros(len(joined) + 1, np.int32), np.arange(len(joined) + 1, dtype=np.int32)
        for k, symbol in enumerate(item, 1):
            new = row + 1
            new[1:] = np.minimum(new[1:], row[:-1] + (joined != symbol))
            new[0] = k
            row = np.minimum.accumulate(new - step) + step
        for (d, _), t2, end in zip(docs, texts, ends, strict=True):
            best = int(row[end - len(t2) - len(gap):end - len(gap) + 1].min())
            if best <= int(len(item) * D.EDITS):
                out.append((d, i, best))
    return sorted(out)


def test_op2(spark, rows):
    t = pq.read_table(f"{SF}/benchmark.parquet").to_pydict()
    items = [x for x in zip(t["item_id"], t["text"], strict=True)]
    got = found(queries.op2_cgk_decontamination(spark, SF))
    some = items[::4]
    assert [g for g in got if g[1] in dict(some)] == brute_matches(rows, some)
    exact = {(d, i) for d, text in rows for i, item in items if D.plain(item) in D.plain(text)}
    assert exact == {(d, i) for d, i, e in got if e == 0} and exact


def test_edited_passages(spark):
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), rng.integers(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(k, text(int(rng.integers(5, 60)))) for k in range(30)] + [(90, ""), (91, None), (92, "Zq"), (None, text(20))]
    docs = []
    for k in range(150):
        item = items[rng.integers(30)][1]
        edited = list(item)
        for _ in range(int(rng.integers(0, max(1, int(len(item) * 0.12)) + 1))):
            at = int(rng.integers(0, len(edited)))
            edited[at:at + int(rng.integers(0, 2))] = rng.choice(list("xyz"), int(rng.integers(0, 2))).tolist()
        docs.append((k, f"{text(20)} {''.join(edited).upper()}\n {text(20)}" if k % 3 else text(60)))
    docs += [(200, None), (201, ""), (202, items[0][1]), (202, items[0][1]), (203, items[33][1].replace(" ", " \n")), (None, items[1][1])]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, matches string")
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    key = lambda m: tuple((v is None, v) for v in m)
    want = []
    for d, t in docs:
        for i, item in items:
            if item and t and (e := semi_global(D.plain(item), D.plain(t))) <= int(len(D.plain(item)) * D.EDITS):
                want.append((d, i, e))
    got = [(r["doc_id"], r["item_id"], r["edits"]) for r in D.contaminations(frame, bench).collect()]
    assert sorted(map(key, got)) == sorted(map(key, want))
    kept = D.drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    dirty = {d for d, _, _ in want}
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((d for d, _ in docs if d not in dirty), key=str)
    assert D.contaminations(frame.limit(0), bench).count() == 0
    assert D.contaminations(frame, bench.limit(0)).count() == 0 and D.drop_contaminated(frame, bench.limit(0)).count() == len(docs)


def test_blocks_of_items(spark, monkeypatch, rows):
    monkeypatch.setattr(D, "BLOCK_BYTES", 2000)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    blocks = list(D.item_blocks(bench))
    assert len(blocks) > 2 and sum(map(len, blocks)) == bench.count()
    texts = {i: D.plain(t) for b in blocks for i, t in b}
    want = {(d, i) for d, t in rows for i, item in texts.items() if item in D.plain(t)}
    assert want <= {(d, i) for d, i, _ in found(D.contaminations(docs, bench))}


# --- licenses


def brute_licenses(rows, texts):
    split = lambda t: [w for w in re.split(r"[^\w]|_", (t or "").lower()) if w]
    shingle = lambda w: [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
    out = set()
    for d, t in rows:
        have = shingle(split(t))
        for name, template in texts.items():
            words = split(template)
            want, step = set(shingle(words)), licenses.Template(name, len(words), [1]).step
            best = max((len(want & set(have[k:k + 2 * step - 4])) / len(want) for k in range(0, len(have), step)), default=0)
            if best >= 0.8:
                out.add((d, name, round(best, 9)))
    return out


def scans(df):
    return [(r["doc_id"], r["template"], round(r["containment"], 9)) for r in df.collect()]


def test_op5(spark, rows):
    got = scans(queries.op5_license_windows(spark, SF))
    assert len(got) == len(set(got)) and set(got) == brute_licenses(rows, licenses.TEMPLATES) and got
    plan = queries.op5_license_windows(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_license_edges(spark):
    rng = np.random.default_rng(2)
    filler = lambda n: " ".join(f"f{rng.integers(900)}" for _ in range(n))
    rows = [(None, "Released under the MIT License."), (1, None), (2, ""), (3, "mit license"), (4, "Released under the MIT License.")]
    for k, (name, text) in enumerate(licenses.TEMPLATES.items()):
        words = text.split()
        for at in (0, 3, 17, 40):
            rows.append((100 * k + at + 1000, f"{filler(at)} {text} {filler(30)} {text}"))
        words[len(words) // 2] = "other"
        rows.append((100 * k + 1099, f"{filler(9)} {' '.join(words)}"))
    rows.append((9999, filler(30_000) + " Licensed under CC BY-NC 4.0. " + filler(50)))
    rows.append((4, "Released under the MIT License."))
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, _h string")
    got = scans(licenses.scan(docs))
    assert Counter(got) == Counter(x for r in rows for x in brute_licenses([r], licenses.TEMPLATES))
    assert licenses.scan(docs.limit(0)).count() == 0


def test_bands_for_the_target():
    for share in (0.05, 0.2, 0.9):
        assert 1 - (1 - share) ** licenses.bands_needed(share) >= licenses.RECALL
