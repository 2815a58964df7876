"""MinHash near-dedup with weighted signatures.

A text is the multiset of its five-word shingles. Every shingle and weight
layer owns a Poisson process of points over time, dealt to ``REGISTERS``
registers; layers are grouped into dyadic weight intervals whose joint process
is thinned to the layers below the shingle's count, so a weight w costs
log2(w) processes. A register holds its earliest point, and two texts agree in
a register with the probability of their weighted Jaccard similarity. Points
are generated up to a time limit only, raised where a register stays empty.

Registers are banded; the members of a band's bucket are compared with its
least member first, verified links are contracted, and members of different
components are then compared with each other: in small buckets as pairs, in
large ones in blocks inside a task. No link that the bands find is lost, and
no group is gathered or written as all its pairs.

A link is a multiset overlap of ``THRESHOLD`` or more; a class is a connected
component. Defined cases: words are lower-cased (A-Z); a text of one to four
words is one shingle; a null or wordless text is a class of its own; equal
texts are one class; the class id is its least ``doc_id`` (null if none has
one); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as X
from tidemark.llm.components import components
from tidemark.llm.tables import discard, lean, pack_sorted, stored, unpack_sorted

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 26, 6
REGISTERS = BANDS * ROWS
#: Least estimated similarity of a pair that is verified: over four standard
#: deviations of the estimate below the threshold.
ESTIMATE = 0.65
#: Bucket members compared as pairs, and members of a block compared in a task.
SMALL_BUCKET, BLOCK = 24, 1024

_HASH_BITS = np.uint64(16)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _nth(k: int) -> np.uint64:
    return np.uint64(k * int(_STEP) & (1 << 64) - 1)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, 48-bit shingle, count) of every distinct shingle, ordered, and words per row."""
    words = X.Words(data, offsets)
    hashes = words.hashes(X.LOWER)
    run = X.runs(hashes, SHINGLE)
    whole = words.doc[:len(run)] == words.doc[len(words.doc) - len(run):]
    doc, value = words.doc[:len(run)][whole], run[whole]
    first = np.concatenate(([0], np.cumsum(words.counts)))
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    whole_text = np.array([X.runs(hashes[first[k]:first[k + 1]], int(words.counts[k]))[0] for k in short], np.uint64)
    doc, value = np.concatenate((doc, short)), np.concatenate((value, whole_text))
    key = np.sort(doc.astype(np.uint64) << np.uint64(48) | value >> _HASH_BITS)
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate((at, [len(key)]))) if len(key) else np.zeros(0, np.int64)
    key = key[at]
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1), counts, words.counts


def _uniform(bits: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1] from 64-bit values."""
    return ((bits >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53


def signatures(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, rows: int, registers: int = REGISTERS) -> np.ndarray:
    """Registers (arrival times) of each row; infinite for rows without shingles."""
    total = np.bincount(row, weights=weight, minlength=rows)
    best = np.full(rows * registers, np.inf)
    limit = registers * (np.log(registers) + 3) / np.maximum(total, 1)
    todo = total > 0
    # Dyadic weight intervals: [0, 1), then [2**(j-1), 2**j).
    levels = np.zeros(len(weight), np.int64)
    levels[weight > 1] = np.ceil(np.log2(weight[weight > 1])).astype(np.int64)
    while todo.any():
        for level in range(int(levels.max(initial=0)) + 1):
            use = np.flatnonzero((levels >= level) & todo[row])
            low, span = (0, 1) if level == 0 else (1 << level - 1, 1 << level - 1)
            seed = X.mix(shingle[use] + _nth(level + 1))
            doc, count, until = row[use], weight[use], limit[row[use]]
            time, k = np.zeros(len(use)), 0
            while len(seed):
                k += 1
                draw = X.mix(seed + _nth(k))
                time = time - np.log(_uniform(draw)) / span
                live = time <= until
                seed, doc, count, until, time = seed[live], doc[live], count[live], until[live], time[live]
                mark = X.mix(draw[live] ^ _STEP)
                inside = slice(None) if span == 1 and low == 0 else np.flatnonzero(
                    low + ((mark >> np.uint64(32)) * np.uint64(span) >> np.uint64(32)).astype(np.int64) < count)
                register = (mark & np.uint64(0xFFFFFFFF)) * np.uint64(registers) >> np.uint64(32)
                np.minimum.at(best, (doc * registers + register.astype(np.int64))[inside], time[inside])
        full = best.reshape(rows, registers).max(axis=1) <= limit
        todo &= ~full
        limit = np.where(todo, 2 * limit, limit)
    return best.reshape(rows, registers)


def band_hashes(best: np.ndarray) -> np.ndarray:
    """One key for each row and band; bands do not share keys."""
    bits = np.ascontiguousarray(best).view(np.uint64).reshape(len(best), BANDS, ROWS)
    out = np.zeros((len(best), BANDS), np.uint64)
    for k in range(ROWS):
        out = out * _STEP + X.mix(bits[:, :, k])
    return X.mix(out + X.mix(np.arange(BANDS, dtype=np.uint64)))


def element_set(shingle: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A multiset as a sorted set: the k-th copy of a shingle is its own element."""
    many = np.repeat(shingle, count)
    copy = np.arange(len(many)) - np.repeat(np.cumsum(count) - count, count)
    return np.sort(np.where(copy == 0, many, X.mix(many + copy.astype(np.uint64) * _STEP) >> _HASH_BITS))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = X.text_bytes(batch.column("text"))
        for i, j in X.slices(offsets):
            row, shingle, count, words = shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            best = signatures(row, shingle, count, j - i)
            bands = band_hashes(best).view(np.int64)
            check = X.mix(best.view(np.uint64)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, j - i), batch.column("node").slice(i, j - i), pa.array(words.astype(np.int64)),
                 pa.ListArray.from_arrays(np.arange(j - i + 1, dtype=np.int32) * BANDS, pa.array(bands.ravel())),
                 pa.array([c.tobytes() for c in check], pa.binary())],
                names=["doc_id", "node", "words", "bands", "registers"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = X.text_bytes(batch.column("text"))
        for i, j in X.slices(offsets):
            row, shingle, count, _ = shingles(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            cut = np.searchsorted(row, np.arange(j - i + 1))
            packed = [pack_sorted(element_set(shingle[a:b], count[a:b])) for a, b in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(i, j - i), pa.array(packed, pa.binary())], names=["node", "elements"])


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = int(X.members(a, b).sum()) if len(a) <= len(b) else int(X.members(b, a).sum())
    return both / max(len(a) + len(b) - both, 1)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("u_elements"), batch.column("v_elements")
        fits = [similarity(unpack_sorted(x.as_py()), unpack_sorted(y.as_py())) >= THRESHOLD for x, y in zip(a, b, strict=True)]
        yield batch.select(["u", "v"]).filter(pa.array(fits, pa.bool_()))


def block_links(sets: list[np.ndarray], labels: list) -> list[tuple[int, int]]:
    """A spanning forest of the links between components, among one block pair.

    Members whose elements too rarely occur in any other member are dropped
    first: no partner can reach the threshold with what is left.
    """
    size = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.concatenate(([True], every[1:] != every[:-1]))
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    every, owner = column[shared], owner[shared]
    able = np.bincount(owner, minlength=len(sets)) >= THRESHOLD * size
    keep = np.flatnonzero(able)
    place = np.full(len(sets), -1)
    place[keep] = np.arange(len(keep))
    use = able[owner]
    rows, columns = place[owner[use]], every[use]
    overlap = np.zeros((len(keep), len(keep)), np.float32)
    if len(keep):
        wide = 4096
        starts = np.unique(columns, return_index=True)[1] if len(columns) else np.zeros(0, int)
        cuts = np.append(starts[::wide], len(columns))
        for a, b in zip(cuts, cuts[1:]):
            part = np.zeros((len(keep), wide), np.float32)
            part[rows[a:b], np.unique(columns[a:b], return_inverse=True)[1]] = 1
            overlap += part @ part.T
    n = size[keep]
    linked = overlap >= THRESHOLD * (n[:, None] + n[None, :] - overlap) - 1e-3
    u, v = np.nonzero(np.triu(linked, 1))
    parent: dict = {}

    def root(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    out = []
    for a, b in zip(keep[u].tolist(), keep[v].tolist(), strict=True):
        x, y = root(labels[a]), root(labels[b])
        if x != y and similarity(sets[a], sets[b]) >= THRESHOLD:
            parent[x] = y
            out.append((a, b))
    return out


def _compare_block(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.drop_duplicates("node")
    nodes, labels = [bytes(n) for n in frame["node"]], [bytes(n) for n in frame["label"]]
    links = block_links([unpack_sorted(e) for e in frame["elements"]], labels) if len(set(labels)) > 1 else []
    return pd.DataFrame({"u": [nodes[a] for a, _ in links], "v": [nodes[b] for _, b in links]}, dtype=object)


def _agreeing(a: str, b: str) -> Column:
    """Estimated similarity: share of equal register bytes."""

    @F.pandas_udf("double")
    def share(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        left = np.frombuffer(b"".join(x), np.uint8).reshape(len(x), -1)
        right = np.frombuffer(b"".join(y), np.uint8).reshape(len(y), -1)
        return pd.Series((left == right).mean(axis=1))

    return share(F.col(a), F.col(b))


def near_duplicates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id, node`` of every document, and ``node, label`` of linked texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.md5(F.encode(text, "UTF-8"))).alias("node"))
    signed = stored(keyed.mapInArrow(lean(_signed), "doc_id long, node binary, words long, bands array<long>, registers binary"), "signatures")

    # One row per distinct text with words, and the document that lends it.
    texts = stored(signed.where("words > 0").groupBy("node")
                   .agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.first("registers").alias("registers")), "texts")
    members = texts.select("node", F.explode("bands").alias("hash"))
    buckets = members.groupBy("hash").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("least")).where("size > 1")
    crowd = stored(members.join(buckets, "hash"), "buckets")

    star = crowd.where("node != least").select(F.col("least").alias("u"), F.col("node").alias("v")).distinct()
    wanted = texts.select("node", "doc_id").join(crowd.select("node").distinct(), "node")
    lent = keyed.join(wanted, (keyed["node"] == wanted["node"]) & keyed["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi")
    sets = stored(lent.select("node", "text").mapInArrow(lean(_sets), "node binary, elements binary")
                  .groupBy("node").agg(F.first("elements").alias("elements")), "elements")
    links = stored(_verified(_likely(star, texts), sets), "links")

    # Members of one bucket in different components, compared once more.
    label = components(links)
    parted = crowd.select("hash", "size", "node").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    split = parted.groupBy("hash").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("hash")
    parted = stored(parted.join(split, "hash", "left_semi"), "parted")
    few = parted.where(F.col("size") <= SMALL_BUCKET)
    a, b = few.alias("a"), few.alias("b")
    pairs = (a.join(b, (F.col("a.hash") == F.col("b.hash")) & (F.col("a.label") < F.col("b.label")))
             .select(F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct())
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    many = (parted.where(F.col("size") > SMALL_BUCKET).withColumn("blocks", blocks).withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("hash", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "label")
            .join(sets, "node"))
    across = many.groupBy("hash", "i", "j").applyInPandas(_compare_block, "u binary, v binary")
    more = _verified(_likely(pairs, texts), sets).union(across)
    every = stored(links.union(more), "links")
    discard(texts, crowd, sets, links, parted)
    return signed.select("doc_id", "node", "words"), components(every)


def _likely(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose registers agree often enough to be verified."""
    return (pairs.join(texts.select(F.col("node").alias("v"), F.col("registers").alias("rv")), "v")
            .join(texts.select(F.col("node").alias("u"), F.col("registers").alias("ru")), "u")
            .where(_agreeing("ru", "rv") >= ESTIMATE).select("u", "v"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose exact multiset overlap reaches the threshold."""
    return (pairs.join(sets.select(F.col("node").alias("v"), F.col("elements").alias("v_elements")), "v")
            .join(sets.select(F.col("node").alias("u"), F.col("elements").alias("u_elements")), "u")
            .mapInArrow(lean(_verify), "u binary, v binary"))


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id`` of every document."""
    rows, label = near_duplicates(docs)
    labelled = rows.join(label, "node", "left").withColumn("label", F.when(F.col("words") > 0, F.coalesce("label", "node")))
    least = labelled.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("class_id"))
    return labelled.join(least, "label", "left").select("doc_id", F.when(F.col("words") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One whole row of each class: that with the least ``doc_id``."""
    rows, label = near_duplicates(docs)
    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    wordless = F.col("text").isNull() | ~F.col("text").cast("string").rlike("[^ \\t-\\r]")
    whole = docs.select(F.struct("*").alias("row"), F.unhex(F.md5(text)).alias("node"), F.col("doc_id").cast("long").alias("doc_id"), wordless.alias("wordless"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")
    one = whole.where("not wordless").groupBy("node").agg(F.min_by("row", order).alias("row"), F.min(order).alias("first"))
    best = (label.join(rows.where("words > 0").groupBy("node").agg(F.min(order).alias("first")), "node")
            .groupBy("label").agg(F.min(F.struct("first", "node")).alias("best")).select(F.col("best.node").alias("node"), F.lit(True).alias("chosen")))
    linked = label.select("node", F.lit(True).alias("linked")).distinct()
    kept = one.join(linked, "node", "left").join(best, "node", "left").where("linked is null or chosen").select("row.*")
    return kept.unionByName(whole.where("wordless").select("row.*"))
