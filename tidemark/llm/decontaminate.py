"""Benchmark decontamination under edit distance.

A document is contaminated by an item if some stretch of it is within
``EDITS`` x item length edits of the item, both as lower-case words joined by
single spaces, in UTF-8 bytes.

1. Windows. An item is cut into more pieces than its allowed edits, so in any
   match the surplus pieces survive, on diagonals that differ by the allowed
   edits at most. Places where so many pieces agree give item-sized windows.
2. Embedding. Items and windows take the same random walk (CGK): a step copies
   the byte under the pointer, which then moves or stays as step and byte say.
   Few edits become few differences.
3. Search. Repeated samples of ``SAMPLES`` embedded places key tables of the
   items; their number follows from the target recall and the agreement that
   mutated items show.
4. The best edit distance of a retrieved item to any stretch about the window
   decides.

Items are taken in blocks of bounded size, one pass over the documents each.
Defined cases: null or empty texts and items match nothing; repeated rows are
searched one by one; an empty table on either side gives no match.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import lean
from pyspark.sql import types as T

from tidemark.llm import text as X

EDITS = 0.1
SAMPLES = 4
RECALL = 0.99
BLOCK_BYTES = 4 << 20
_SEED = 7
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case words, each followed by one space, and the rows' offsets."""
    words = X.Words(data, offsets)
    number = np.zeros(len(data) + 1, np.int64)
    number[words.starts] = 1
    place = np.cumsum(words.solid) - 1 + np.cumsum(number[:-1]) - 1
    out = np.full(int((words.ends - words.starts).sum()) + len(words.starts), 32, np.uint8)
    out[place[words.solid]] = _lower[data[words.solid]]
    sizes = X.per_row(words.solid, offsets) + words.counts
    return out, np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def plain(text: str | None) -> bytes:
    return b" ".join((text or "").encode().lower().split())


def embed(texts: np.ndarray, sizes: np.ndarray, steps: int) -> np.ndarray:
    """CGK walks of padded rows: ``steps`` bytes each, zero behind the end."""
    coin = X.mix(np.arange(steps * 256, dtype=np.uint64) + np.uint64(_SEED)).reshape(steps, 256) & np.uint64(1)
    coin = coin.astype(np.int64)
    out = np.zeros((steps, len(texts)), np.uint8)
    row, pointer, width = np.arange(len(texts)), np.zeros(len(texts), np.int64), texts.shape[1] - 1
    for t in range(steps):
        at = np.minimum(pointer, width)
        symbol = np.where(pointer < sizes, texts[row, at], 0)
        out[t] = symbol
        pointer += coin[t, symbol]
    return out.T


def best_distances(items: list[np.ndarray], stretches: list[np.ndarray], at_once: int = 256) -> list[int]:
    """Least edit distance of each item to any part of its stretch."""
    out = [0] * len(items)
    by_size = sorted(range(len(items)), key=lambda k: (len(items[k]), len(stretches[k])))
    for a in range(0, len(by_size), at_once):
        block = by_size[a:a + at_once]
        sizes = [len(items[k]) for k in block]
        symbols = np.full((len(block), max(sizes)), -1, np.int16)
        text = np.full((len(block), max(len(stretches[k]) for k in block)), -2, np.int16)  # never equal
        for n, k in enumerate(block):
            symbols[n, :sizes[n]], text[n, :len(stretches[k])] = items[k], stretches[k]
        row = np.zeros((len(block), text.shape[1] + 1), np.int32)
        step, done = np.arange(text.shape[1] + 1, dtype=np.int32), 0
        for i in range(max(sizes)):
            while sizes[done] == i:
                out[block[done]] = int(row[done].min())
                done += 1
            new = row + 1
            np.minimum(new[:, 1:], row[:, :-1] + (text != symbols[:, i, None]), out=new[:, 1:])
            new -= step
            row = np.minimum.accumulate(new, axis=1) + step
        for n in range(done, len(block)):
            out[block[n]] = int(row[n].min())
    return out


class Items:
    """Pieces and tables of one block of benchmark items."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        kept = [(i, np.frombuffer(t, np.uint8)) for i, text in items if (t := plain(text))]
        self.ids, self.texts = [i for i, _ in kept], [t for _, t in kept]
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        self.edits = (self.sizes * EDITS).astype(np.int64)
        if not kept:
            return
        # Pieces by width: value, item and place in the item.
        self.pieces: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        by_width: dict[int, list[tuple[int, int, int]]] = {}
        self.survivors = np.full(len(kept), 2, np.int64)
        for k, t in enumerate(self.texts):
            spare = lambda w, n=len(t), e=int(self.edits[k]): n // w - e
            width = next((w for w in (8, 5, 3, 2) if spare(w) >= 2), 1)
            if spare(width) >= 2:
                self.survivors[k] = spare(width)
                for at in range(0, len(t) - width + 1, width):
                    by_width.setdefault(width, []).append((int.from_bytes(t[at:at + width].tobytes(), "little"), k, at))
            else:  # one byte: the item itself, twice
                by_width.setdefault(1, []).extend([(int(t[0]), k, 0), (int(t[-1]), k, len(t) - 1)])
        for width, found in by_width.items():
            value, item, place = (np.array(c, kind) for c, kind in zip(zip(*sorted(found), strict=True), (np.uint64, np.int64, np.int64), strict=True))
            table = np.zeros(1 << 20, bool)
            table[self._slot(value)] = True
            self.pieces[width] = value, item, place, table
        self.walk = 3 * int(self.sizes.max())
        embedded = self._embedded(self.texts, self.sizes)
        self.repeats = self._repeats(embedded)
        rng = np.random.default_rng(_SEED)
        self.fractions = rng.random((self.repeats, SAMPLES))
        key = self.keys(embedded, self.sizes)
        number = np.repeat(np.arange(len(kept)), self.repeats)
        order = np.argsort(key.ravel(), kind="stable")
        self.table, self.table_item = key.ravel()[order], number[order]

    @staticmethod
    def _slot(value: np.ndarray) -> np.ndarray:
        return (value * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)

    def _embedded(self, texts: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(texts), int(sizes.max())), np.uint8)
        for k, t in enumerate(texts):
            padded[k, :len(t)] = t
        return embed(padded, sizes, self.walk)

    def _repeats(self, embedded: np.ndarray) -> int:
        """Tables for the target recall, from items with as many random edits as allowed."""
        rng = np.random.default_rng(_SEED)
        use = range(0, len(self.texts), -(-len(self.texts) // 256))  # calibration: at most 256 items
        changed = []
        for k in use:
            t = self.texts[k].tolist()
            for _ in range(int(self.edits[k])):
                at, kind = int(rng.integers(0, len(t))), int(rng.integers(0, 3))
                t[at:at + (kind != 1)] = [] if kind == 2 and len(t) > 1 else [int(rng.integers(97, 123))]
            changed.append(np.array(t[:int(self.sizes[k])], np.uint8))
        walks = self._embedded(changed, np.array([len(t) for t in changed]))
        agree = np.array([(walks[n, :3 * len(self.texts[k])] == embedded[k, :3 * len(self.texts[k])]).mean() for n, k in enumerate(use)])
        low = min(max(float(np.quantile(agree, 0.1)), 0.2), 1 - 1e-9) ** SAMPLES
        return max(8, math.ceil(math.log(1 - RECALL) / math.log(1 - low)))

    def keys(self, embedded: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Keys of the sampled places (fractions of the walk of a text's size)."""
        out = np.zeros((len(embedded), self.repeats), np.uint64)
        for s in range(SAMPLES):
            at = (self.fractions[None, :, s] * (3 * sizes[:, None])).astype(np.int64)
            out = out * np.uint64(257) + np.take_along_axis(embedded, at, 1)
        return X.mix(X.mix(out + X.mix(np.arange(self.repeats, dtype=np.uint64))[None, :]) + sizes.astype(np.uint64)[:, None])

    def windows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, start, size) of item-sized windows with enough agreeing pieces."""
        rows, items, starts = [], [], []
        padded = np.concatenate((data, np.zeros(8, np.uint8)))
        words = np.ndarray((len(data),), "<u8", padded.tobytes(), strides=(1,)).astype(np.uint64)
        for width, (value, item, place, table) in self.pieces.items():
            word = words & np.uint64((1 << 8 * width) - 1) if width < 8 else words
            at = np.flatnonzero(table[self._slot(word)])
            low, high = np.searchsorted(value, word[at], "left"), np.searchsorted(value, word[at], "right")
            n = high - low
            at, first = np.repeat(at, n), np.repeat(low, n)
            hit = first + np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
            rows.append(np.searchsorted(offsets, at, "right") - 1)
            items.append(item[hit])
            starts.append(at - place[hit])
        row, item, start = (np.concatenate(c) for c in (rows, items, starts))
        if not len(row):
            return row, start, row
        order = np.lexsort((start, item, row))
        row, item, start = row[order], item[order], start[order]
        # Hits whose run of enough hits, from this one on, stays on near diagonals.
        last = np.minimum(np.arange(len(row)) + self.survivors[item] - 1, len(row) - 1)
        first = (np.arange(len(row)) + self.survivors[item] - 1 < len(row)) & (row[last] == row) & (item[last] == item) & (start[last] - start <= self.edits[item])
        reach = np.zeros(len(row) + 1, np.int64)
        np.add.at(reach, np.flatnonzero(first), 1)
        np.add.at(reach, last[first] + 1, -1)
        enough = np.cumsum(reach)[:-1] > 0
        found = np.unique(np.stack((row[enough], start[enough], self.sizes[item[enough]])), axis=1)
        return found[0], found[1], found[2]

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> list[dict[int, int]]:
        """Per row: item number to its least edit distance, where allowed."""
        out: list[dict[int, int]] = [{} for _ in range(len(offsets) - 1)]
        if not self.ids or not len(data):
            return out
        row, start, size = self.windows(data, offsets)
        found = []
        for a in range(0, len(row), 4096):
            r, s, n = row[a:a + 4096], start[a:a + 4096], size[a:a + 4096]
            begin, end = offsets[r], offsets[r + 1]
            s = np.clip(s, begin, end)
            at = s[:, None] + np.arange(int(n.max()))
            inside = at < np.minimum(s + n, end)[:, None]
            texts = np.where(inside, data[np.minimum(at, len(data) - 1)], 0)
            keys = self.keys(embed(texts, inside.sum(axis=1), self.walk), n)
            low, high = np.searchsorted(self.table, keys, "left"), np.searchsorted(self.table, keys, "right")
            window, table = np.nonzero(high > low)
            n = (high - low)[window, table]
            first = low[window, table]
            item = self.table_item[np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            found.append(np.unique(np.stack((np.repeat(r[window], n), item, np.repeat(s[window], n))), axis=1))
        self._decide(data, offsets, np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64), out)
        return out

    def _decide(self, data: np.ndarray, offsets: np.ndarray, found: np.ndarray, out: list[dict[int, int]]) -> None:
        """Edit distances of (row, item, start) candidates; near starts share a stretch."""
        pairs: list[tuple[int, int, int, int]] = []
        for r, k, s in zip(*(c.tolist() for c in found), strict=True):
            allowed, size = int(self.edits[k]), int(self.sizes[k])
            begin, end = max(int(offsets[r]), s - allowed), min(int(offsets[r + 1]), s + size + allowed)
            if pairs and pairs[-1][:2] == (r, k) and begin - pairs[-1][2] <= size and begin <= pairs[-1][3]:
                pairs[-1] = (r, k, pairs[-1][2], max(end, pairs[-1][3]))
            else:
                pairs.append((r, k, begin, end))
        for r, k, begin, end in pairs:
            if data[begin:end].tobytes().find(self.texts[k].tobytes()) >= 0:
                out[r][k] = 0
        pairs = [p for p in pairs if p[1] not in out[p[0]]]
        for (r, k, _, _), e in zip(pairs, best_distances([self.texts[p[1]] for p in pairs], [data[p[2]:p[3]] for p in pairs]), strict=True):
            if e <= self.edits[k]:
                out[r][k] = min(e, out[r].get(k, e))


def _search(items: list[tuple[int | None, str | None]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Items(items)
        for batch in batches:
            raw, offsets = X.text_bytes(batch.column("text"))
            found: list[list[dict]] = []
            for i, j in X.slices(offsets):
                data, at = normalised(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                found += [[{"item_id": block.ids[k], "edits": e, "item_bytes": len(block.texts[k])} for k, e in sorted(m.items())] for m in block.matches(data, at)]
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("item_bytes", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, kind)], names=["row", "matches"])

    return run


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    """The benchmark's items in blocks of about ``BLOCK_BYTES`` at most."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES) or 1
    for k in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield [(r["item_id"], r["text"]) for r in part.collect()]


def _matched(docs: DataFrame, carry: list[str], items: list[tuple[int | None, str | None]]) -> DataFrame:
    source = docs.select(F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row"), F.col("text").cast("string").alias("text"))
    match = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("edits", T.IntegerType()), T.StructField("item_bytes", T.IntegerType())]))
    return source.mapInArrow(lean(_search(items)), T.StructType([source.schema["row"], T.StructField("matches", match)]))


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, edits, item_bytes`` of every document and item in it."""
    found = None
    for items in item_blocks(benchmark):
        part = _matched(docs, ["doc_id"], items).select("row.doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")
        found = part if found is None else found.union(part)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any benchmark item, with their own columns."""
    for items in item_blocks(benchmark):
        docs = _matched(docs, docs.columns, items).where(F.size("matches") == 0).select("row.*")
    return docs
