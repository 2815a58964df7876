"""Spelling variants of a corpus vocabulary by reduced-alphabet generation.

Every letter is hashed to one of a few symbols. Two words one edit apart have
reduced words that are equal or one edit apart, so the one-edit neighbourhood
of each reduced word (replacements and deletions; an insertion is the longer
word's deletion) is generated and joined with the reduced vocabulary, and the
matches are verified on the original strings. The alphabet grows with the
vocabulary (``symbols ** min_length`` is at least its size), so that a reduced
word stands for about one word at every size.

An edit leaves one half of a word intact. So a word travels only four times,
once for each half and for each length of the shorter word of a pair, to the
words that share this reduced half; the neighbourhood is generated and joined
there and never shuffled. A pair is taken only in the half that its first
difference lies in, which makes it unique. Halves shared by more than
``GROUP`` words are dealt to pairs of blocks, so no task holds more.

Words are runs of ``[A-Za-z\\u00C0-\\u00FF]``, lower-cased A-Z only. In a
share of the runs (chosen by a checksum of document id and run) one letter is
taken out, which plants typing errors of known size.

Defined cases: a null or empty text has no words; a null ``doc_id`` counts as
an empty string; repeated rows count again; an empty table gives an empty
result; other columns, whatever their names, are not read. Texts are read in
slices that end outside a run, so only a single run must fit in a task.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored
from tidemark.llm.text import mix

MIN_LENGTH, MIN_COUNT, RATIO, TYPO = 7, 2, 10, 31
#: Words of one group (or block) that a task takes at once.
GROUP = 1 << 16

_LETTER = rb"(?:[a-z]|\xc3[\x80-\xbf])"
_OUTSIDE = re.compile(rb"[^a-z\x80-\xff]")
_SLICE = 1 << 22
_ENTRIES = 200_000
_P = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------- counting
def _slices(text: bytes) -> Iterator[bytes]:
    """Slices of a text that end at its end or at a byte outside every run."""
    at = 0
    while len(text) - at > _SLICE:
        cut = _OUTSIDE.search(text, at + _SLICE)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def _count(min_length: int, typo: int):
    run_of = re.compile(_LETTER + b"{%d,}" % min_length)

    def rows(found: Counter) -> pa.RecordBatch:
        kept = [(w, n) for w, n in found.items() if n]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.binary()).cast(pa.string()),
                                           pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for doc, value in zip(batch.column(0), batch.column(1), strict=True):
                if not value.is_valid:
                    continue
                start = crc32((doc.as_py() or "").encode() + b":")
                for text in _slices(value.as_py().encode().lower()):  # bytes: A-Z only
                    words = run_of.findall(text)
                    found.update(words)
                    for word in words:
                        h = crc32(word, start)
                        if h % typo == 0:
                            found[word] -= 1
                            letters = word.decode()
                            if len(letters) > min_length:
                                k = h % len(letters)
                                found[(letters[:k] + letters[k + 1:]).encode()] += 1
                    if len(found) > _ENTRIES:
                        yield rows(found)
                        found.clear()
        yield rows(found)

    return run


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, typo: int = TYPO) -> DataFrame:
    """``word, n`` of the words with at least ``min_length`` letters and ``min_count`` occurrences."""
    source = docs.select(F.col("doc_id").cast("string").alias("doc"), F.col("text").cast("string").alias("text"))
    return (source.mapInArrow(_count(min_length, typo), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


# ---------------------------------------------------------------------- pairs
def symbols_for(words: int, min_length: int) -> int:
    """The least number of symbols (4 at least) whose words of ``min_length`` outnumber the vocabulary."""
    n = 4
    while n < 255 and n ** min_length < words:
        n += 1
    return n


def _powers(n: int) -> np.ndarray:
    p = np.full(n, _P, np.uint64)
    p[:1] = 1
    return np.cumprod(p, dtype=np.uint64)


def _matrix(words: list[bytes], length: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length)


_COPY = "part long, size int, side int, word string, n long"


def _copies(symbols: int, min_length: int):
    """Each word once for each intact half and each length of a pair's shorter word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            latin = [w.as_py().encode("latin-1") for w in batch.column("word")]
            lengths = np.array([len(w) for w in latin], np.int64)
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                reduced = (_matrix([latin[i] for i in rows], length) % symbols).astype(np.uint64)
                mine = batch.take(pa.array(rows))
                for size in (length, length - 1):
                    if size < min_length:
                        continue
                    half = size // 2
                    for side, intact in enumerate((reduced[:, :half], reduced[:, half + length - size:])):
                        with np.errstate(over="ignore"):
                            part = mix((intact + np.uint64(1)) @ _powers(intact.shape[1]) + np.uint64(size * 2 + side) * np.uint64(0xD6E8FEB86659FD93))
                        n = len(rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(part.view(np.int64)), pa.array(np.full(n, size, np.int32)), pa.array(np.full(n, side, np.int32)),
                             mine.column("word"), mine.column("n")], names=["part", "size", "side", "word", "n"])

    return run


def _lookup(sought: np.ndarray, vocabulary: np.ndarray, step: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places ``(in sought, in vocabulary)`` of equal values, a bounded number at a time."""
    first, last = np.searchsorted(vocabulary, sought), np.searchsorted(vocabulary, sought, "right")
    hits = np.flatnonzero(last > first)
    ends = np.cumsum(last[hits] - first[hits])
    i = 0
    while i < len(hits):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + step, "right")))
        count = (last - first)[hits[i:j]]
        base = np.repeat(first[hits[i:j]] - np.cumsum(count) + count, count)
        yield np.repeat(hits[i:j], count), base + np.arange(count.sum())
        i = j


def _replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Place of the only difference of two words of one length, else -1."""
    differs = a != b
    return np.where(differs.sum(axis=1) == 1, differs.argmax(axis=1), -1)


def _deleted(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Place of the first letter whose deletion from ``longer`` gives ``shorter``, else -1."""
    size = shorter.shape[1]
    front = np.minimum.accumulate(longer[:, :size] == shorter, axis=1).sum(axis=1)
    back = np.minimum.accumulate((longer[:, 1:] == shorter)[:, ::-1], axis=1).sum(axis=1)
    return np.where(front + back >= size, front, -1)


def _class_pairs(size: int, side: int, symbols: int, short: tuple, long: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs one edit apart among words of ``size`` letters and between them and words of one more.

    ``short`` and ``long`` are (letters, part, row) of words with one intact half.
    """
    half = size // 2
    letters, part, row = short
    if not len(row):
        return
    inside = slice(half, None) if side == 0 else slice(0, half)
    opened = (letters[:, inside] % symbols).astype(np.uint64) + np.uint64(1)
    power = _powers(opened.shape[1] + 1)
    key = part + opened @ power[:-1]
    order = np.argsort(key)
    known = key[order]

    def same_length(sought: np.ndarray, of: np.ndarray, ordered: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i, j in _lookup(sought, known):
            u, v = of[i], order[j]
            if ordered:  # equal reduced words: each pair once
                u, v = u[u < v], v[u < v]
            at = _replaced(letters[u], letters[v])
            good = (at >= half) if side == 0 else (at >= 0) & (at < half)
            yield row[u[good]], row[v[good]]

    yield from same_length(key, np.arange(len(key)), True)
    for j in range(opened.shape[1]):  # a replacement by each greater symbol; the partner has the lesser one
        for symbol in range(2, symbols + 1):
            of = np.flatnonzero(opened[:, j] < symbol)
            yield from same_length(key[of] + (np.uint64(symbol) - opened[of, j]) * power[j], of, False)

    longer, long_part, long_row = long
    if not len(long_row):
        return
    inside = slice(half, None) if side == 0 else slice(0, half + 1)
    opened = (longer[:, inside] % symbols).astype(np.uint64) + np.uint64(1)
    width = opened.shape[1]
    before = np.zeros(len(long_row), np.uint64)
    after = opened[:, 1:] @ power[:width - 1]
    for j in range(width):
        of = np.flatnonzero(opened[:, j] != opened[:, j + 1]) if j + 1 < width else np.arange(len(long_row))
        for i, k in _lookup((long_part + before + after)[of], known):
            u, v = of[i], order[k]
            at = _deleted(longer[u], letters[v])
            good = (at > half) if side == 0 else (at >= 0) & (at <= half)
            yield long_row[u[good]], row[v[good]]
        if j + 1 < width:
            before = before + opened[:, j] * power[j]
            after = after - opened[:, j + 1] * power[j]


def _near(symbols: int):
    """Pairs of each run of whole groups, both ways."""

    def solve(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        group = rows["deal"].to_numpy()
        _, at, count = np.unique(group, return_inverse=True, return_counts=True)
        rows = rows.filter(pa.array(count[at] > 1))
        if not rows.num_rows:
            return
        group, part, size, side = (rows[c].to_numpy() for c in ("deal", "part", "size", "side"))
        latin = [w.as_py().encode("latin-1") for w in rows["word"]]
        lengths = np.array([len(w) for w in latin])
        part = mix(part.view(np.uint64) + group.view(np.uint64))
        for kind in np.unique(size * 2 + side).tolist():
            a_size, a_side = kind >> 1, kind & 1
            mine = np.flatnonzero(size * 2 + side == kind)
            classes = []
            for length in (a_size, a_size + 1):
                of = mine[lengths[mine] == length]
                classes.append((_matrix([latin[i] for i in of], length), part[of], of))
            with np.errstate(over="ignore"):
                for u, v in _class_pairs(a_size, a_side, symbols, *classes):
                    if len(u):
                        first, second = np.concatenate((u, v)), np.concatenate((v, u))
                        block = rows["block"].to_numpy()
                        # Words of one block also meet in every other pair of blocks it takes part in.
                        fresh = (block[first] != block[second]) | (rows["own"].to_numpy()[first])
                        a, b = rows.take(pa.array(first[fresh])), rows.take(pa.array(second[fresh]))
                        yield from pa.Table.from_arrays([a["word"], a["n"], b["word"], b["n"]],
                                                        names=["word", "n", "near", "near_n"]).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            deal = batch.column("deal").to_numpy()
            if held and sum(b.num_rows for b in held) >= GROUP:
                last = held[-1].column("deal")[-1].as_py()
                cut = int(np.searchsorted(deal, last, "right"))
                held.append(batch.slice(0, cut))
                if cut < len(deal):
                    yield from solve(pa.Table.from_batches(held).combine_chunks())
                    held = [batch.slice(cut)]
            else:
                held.append(batch)
        if held:
            yield from solve(pa.Table.from_batches(held).combine_chunks())

    return run


def near_words(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``word, n, near, near_n``: all ordered pairs of distinct words one inserted, deleted or replaced letter apart.

    ``words`` has distinct words of at least ``min_length`` letters up to
    U+00FF and their counts.
    """
    symbols = symbols_for(words.count(), min_length)
    copies = words.mapInArrow(_copies(symbols, min_length), _COPY)
    large = stored(copies.groupBy("part").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > GROUP), "large")
    if large.isEmpty():
        dealt = copies.select("*", F.col("part").alias("deal"), F.lit(0).alias("block"), F.lit(True).alias("own"))
    else:
        blocks = F.ceil(F.col("members") / (GROUP // 2)).cast("int")
        dealt = (copies.join(large, "part", "left")
                 .withColumn("blocks", F.coalesce(blocks, F.lit(1)))
                 .withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .select("part", "size", "side", "word", "n",
                         F.when(F.col("blocks") == 1, F.col("part")).otherwise(
                             F.xxhash64("part", F.least("block", "other"), F.greatest("block", "other"))).alias("deal"),
                         "block", (F.col("block") == F.col("other")).alias("own")))
    return (dealt.repartition("deal").sortWithinPartitions("deal")
            .mapInArrow(_near(symbols), "word string, n long, near string, near_n long"))


# -------------------------------------------------------------------- forms
def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of each chain of forms (counts rise tenfold a step, so chains are short)."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = stored(now.join(onward, "root", "left")
                     .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, typo: int = TYPO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the vocabulary.

    ``form`` is the near word of largest count (ties: the first by code
    points) if that is at least ``ratio`` times the word's own; ``root``
    follows the forms to the last.
    """
    words = stored(vocabulary(docs, min_length, min_count, typo), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = stored(near_words(words, min_length).groupBy("word").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("n_near"), best.alias("best"))
                  .withColumn("form", F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best.near")))
                  .select("word", "n_near", "form", F.when(F.col("form").isNotNull(), -F.col("best.less")).alias("form_n")), "near")
    roots = _roots(near.where(F.col("form").isNotNull()))
    return (words.join(near, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
