"""Suffix-array dedup of repeated byte strings across documents.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (in a
document with a smaller ``doc_id``, or earlier in the same one) is removed.

1. Anchors. Each window of ``LENGTH`` bytes names its least ``ANCHOR``-byte
   hash; neighbouring windows with the same anchor form a stretch. Equal
   windows have equal anchors, so an anchor that heads one stretch only, in
   all shards, has no repeats; and of equal stretches all but the earliest
   are removed whole. Shards exchange one hash for each distinct stretch.
2. Suffix arrays. What is left are stretches that share an anchor but differ.
   Their text is sorted per shard by Larsson-Sadakane refinement (ranks of
   doubling depth, unsorted groups only); Kasai's pass gives the common
   prefixes, and neighbours that share ``LENGTH`` bytes form classes.
3. Merging. A shard sends a sorted run of class fingerprints, cut at fixed
   splitters; runs meet by range and each is searched in the merged run.

Shards are the chunk rows of :mod:`tidemark.llm.chunks`. A fingerprint has 64
bits. Defined cases: null text is empty; null ``doc_id`` comes first; rows with
one ``doc_id`` follow each other in stored order; an empty table gives an
empty result. Memory is about 60 bytes per byte of the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import text as X
from tidemark.llm.chunks import NO_ID, bucket_bits, chunked, cuts, one_by_one, unpacked
from tidemark.llm.tables import discard, lean, lean_groups, pack_sorted, planes, stored, sweep, unpack_sorted, unplaned

LENGTH = 100
ANCHOR = 24
CACHE_BYTES = 1 << 19
#: Kinds of exchanged runs: stretches, anchors, window classes; and the flags
#: of the first window of each class in its shard.
STRETCH, ANCHORS, CLASS, FIRST = range(4)
_PLACE = np.uint64((1 << 28) - 1)


def stretches(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """First and last window, anchor hash and text hash of every stretch."""
    found: list[tuple[np.ndarray, ...]] = []
    for i, j in X.slices(offsets, CACHE_BYTES):
        base = offsets[i]
        spans = X.SpanHash(data[base:offsets[j]], longest=2 * LENGTH)  # a stretch is shorter
        grams = spans.rolling(ANCHOR)
        if not len(grams):
            continue
        key = grams & ~_PLACE | np.arange(len(grams), dtype=np.uint64)
        width, least = 1, key
        while 2 * width <= LENGTH - ANCHOR + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = LENGTH - ANCHOR + 1 - width
        least = np.minimum(least[:len(least) - rest], least[rest:]) if rest else least
        windows = np.zeros(len(least) + 1, np.int8)
        local = offsets[i:j + 1] - base
        starts, ends = local[:-1], local[1:] - LENGTH + 1
        fits = ends > starts
        np.add.at(windows, starts[fits], 1)
        np.add.at(windows, ends[fits], -1)
        at = np.flatnonzero(np.cumsum(windows)[:-1] > 0)
        if not len(at):
            continue
        anchor = (least[at] & _PLACE).astype(np.int64)
        new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)))
        # A document's first window opens a stretch even right behind another's last.
        new |= X.members(at, starts)
        head = np.flatnonzero(new)
        a, b = at[head], at[np.append(head[1:], len(at)) - 1]
        # Least hashes are small numbers; mixed again (one to one) they fill the key ranges evenly.
        found.append((a + base, b + base, X.mix(grams[anchor[head]]), spans(a, b + LENGTH)))
    columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.uint64)] * 2
    return dict(zip(("first", "last", "anchor", "text"), columns, strict=True))


def first_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the index of the first occurrence of each."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(keys) else np.zeros(0, bool)
    return ordered[new], order[new]


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes, and the 8-byte words by position."""
    n = len(text)
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    words = np.ndarray((n,), ">u8", padded.tobytes(), strides=(1,)).astype(np.uint64)
    # The last seven suffixes are shorter than a word; a shorter one comes first.
    turned = np.concatenate((np.arange(n)[:-8:-1], np.arange(max(n - 7, 0))))
    order = turned[np.argsort(words[turned], kind="stable")]
    sorted_words, room = words[order], np.minimum(n - order, 8)
    new = np.concatenate(([True], (sorted_words[1:] != sorted_words[:-1]) | (room[1:] != room[:-1])))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    h = 8
    while h < n:
        last = np.append(new[1:], True)
        places = np.flatnonzero(~(new & last))  # members of unsorted groups
        if not len(places):
            break
        at = order[places]
        behind = np.where(at + h < n, rank[np.minimum(at + h, n - 1)] + 1, 0)
        key = rank[at] << 32 | behind
        turn = np.argsort(key, kind="stable")
        order[places], key = at[turn], key[turn]
        new[places] = np.concatenate(([True], key[1:] != key[:-1]))
        rank[order[places]] = np.maximum.accumulate(np.where(new[places], places, 0))
        h *= 2
    return order, words


def common_prefixes(words: np.ndarray, order: np.ndarray, cap: int, lanes: int = 4096) -> np.ndarray:
    """Kasai's common prefixes of neighbours in ``order``, up to ``cap``.

    A suffix shares at least one byte less with its neighbour than the suffix
    one position before did. Many stretches of positions advance side by side.
    """
    n = len(order)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = np.where(place > 0, order[place - 1], -1)
    shared = np.zeros(n, np.int64)
    lanes = min(lanes, n)
    step = -(-n // lanes) if n else 0
    start, h = np.arange(lanes) * step, np.zeros(lanes, np.int64)
    for t in range(step):
        i = start + t
        on = i < n
        i = np.minimum(i, n - 1)
        j = before[i]
        on &= j >= 0
        room = np.minimum(cap, n - np.maximum(i, j))
        h = np.where(on, np.minimum(np.maximum(h - 1, 0), room), 0)
        go = np.flatnonzero(on & (h < room))
        while len(go):
            differ = words[i[go] + h[go]] ^ words[j[go] + h[go]]
            same = sum((differ < np.uint64(1 << 8 * k)).astype(np.int64) for k in range(8))
            h[go] = np.minimum(h[go] + same, room[go])
            go = go[(same == 8) & (h[go] < room[go])]
        shared[i[on]] = h[on]
    return shared[order]


def _runs(kind: int, batch: int, keys: np.ndarray, bits: int, *values: np.ndarray) -> Iterator[tuple]:
    """Sorted keys, and what goes with them, cut into buckets."""
    at = cuts(keys, bits)
    for bucket in np.flatnonzero(np.diff(at)).tolist():
        part = slice(at[bucket], at[bucket + 1])
        yield kind, bucket, batch, int(at[bucket + 1] - at[bucket]), pack_sorted(keys[part]), b"".join(
            len(p).to_bytes(4, "little") + p for p in (planes(v[part]) for v in values))


_RUN = "kind int, bucket int, batch long, n int, keys binary, extra binary"
_RUN_TYPES = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())


def _batch(rows: list[tuple], types: tuple, names: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                      names=[f.split()[0] for f in names.split(", ")])


def _extra(blob: bytes, *dtypes) -> list[np.ndarray]:
    out, at = [], 0
    for dtype in dtypes:
        n = int.from_bytes(blob[at:at + 4], "little")
        out.append(unplaned(blob[at + 4:at + 4 + n], dtype))
        at += 4 + n
    return out


def _ids(chunk: dict) -> np.ndarray:
    return np.array([NO_ID if d is None else d for d in chunk["doc_ids"]], np.int64)


def _owners(positions: np.ndarray, chunk: dict, offsets: np.ndarray) -> np.ndarray:
    return _ids(chunk)[np.searchsorted(offsets, positions, "right") - 1]


def _publish(bits: int):
    """Per shard: a run of distinct stretches and one of distinct anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in one_by_one(batches):
            data, offsets = unpacked(chunk)
            s = stretches(data, offsets)
            keys, at = first_of(s["text"])
            rows = list(_runs(STRETCH, chunk["batch"], keys, bits, _owners(s["first"][at], chunk, offsets)))
            order = np.lexsort((s["text"], s["anchor"]))
            anchor, text = s["anchor"][order], s["text"][order]
            head = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1]))) if len(anchor) else np.zeros(0, np.int64)
            tail = np.append(head[1:], len(anchor))[:len(head)] - 1
            # The order of stretch hashes only has to tell one from several.
            rows += _runs(ANCHORS, chunk["batch"], anchor[head], bits, text[head] >> np.uint64(16), (text[tail] >> np.uint64(16)) - (text[head] >> np.uint64(16)))
            yield _batch(rows, _RUN_TYPES, _RUN)

    return run


_BITS = "kind int, bucket int, batch long, n int, bits binary"
_BITS_TYPES = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary())


def _merge(table: pa.Table) -> pa.Table:
    """One range of keys: what each shard's run learns about its keys.

    Stretches and classes: whether the shard holds the earliest one; anchors:
    whether they head several stretches. Each run is looked up in the merged
    run by binary search.
    """
    rows = sorted(table.to_pylist(), key=lambda r: r["batch"])
    runs = [unpack_sorted(r["keys"]) for r in rows]
    merged = X.distinct(np.concatenate(runs))
    places = [np.searchsorted(merged, k) for k in runs]
    out = []
    if rows[0]["kind"] == ANCHORS:
        low, high = np.full(len(merged), (1 << 64) - 1, np.uint64), np.zeros(len(merged), np.uint64)
        for r, at in zip(rows, places, strict=True):
            lo, more = _extra(r["extra"], np.uint64, np.uint64)
            low[at], high[at] = np.minimum(low[at], lo), np.maximum(high[at], lo + more)
        found = [(low != high)[at] for at in places]
    else:
        owner, holder = np.full(len(merged), (1 << 63) - 1, np.int64), np.full(len(merged), -1, np.int64)
        for k, (r, at) in enumerate(zip(rows, places, strict=True)):  # ascending batch: ties stay with the first
            (doc,) = _extra(r["extra"], np.int64)
            better = (doc < owner[at]) | (holder[at] < 0)
            owner[at[better]], holder[at[better]] = doc[better], k
        found = [holder[at] == k for k, at in enumerate(places)]
    for r, flags in zip(rows, found, strict=True):
        out.append((r["kind"], r["bucket"], r["batch"], r["n"], np.packbits(flags).tobytes()))
    return pa.Table.from_batches([_batch(out, _BITS_TYPES, _BITS)])


def _answers(chunk: dict, kind: int) -> np.ndarray:
    parts = sorted((a["bucket"], a["n"], a["bits"]) for a in chunk["answers"] or () if a["kind"] == kind)
    return np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for _, n, b in parts]).astype(bool) if parts else np.zeros(0, bool)


def _candidates(s: dict[str, np.ndarray], chunk: dict) -> tuple[np.ndarray, np.ndarray]:
    """Stretches that are not the earliest copy, and those to be compared by window."""
    keys, at = first_of(s["text"])
    late = np.ones(len(s["text"]), bool)
    late[at[_answers(chunk, STRETCH)]] = False
    several = X.distinct(s["anchor"])[_answers(chunk, ANCHORS)]
    return late, ~late & X.members(s["anchor"], several)


def _window_flags(first: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    """Flags of the positions in any [first, last]; at most ``2 * LENGTH`` of them meet in one."""
    change = np.zeros(size + 1, np.int16)
    np.add.at(change, first, 1)
    np.add.at(change, last + 1, -1)
    return np.cumsum(change, dtype=np.int16, out=change)[:-1] > 0


def window_classes(data: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Those of the flagged windows that come first among their equals."""
    text_at = np.flatnonzero(_window_flags(np.flatnonzero(windows), np.flatnonzero(windows) + LENGTH - 1, len(data)))
    if not len(text_at):
        return np.zeros(0, np.int64)
    order, words = suffix_array(data[text_at])
    number = np.cumsum(common_prefixes(words, order, LENGTH) < LENGTH)
    position = text_at[order]
    use = windows[position]
    number, position = number[use], position[use]
    least = np.full(int(number.max(initial=0)) + 1, len(data), np.int64)
    np.minimum.at(least, number, position)
    return np.sort(least[least < len(data)])


def _sort_windows(bits: int):
    """Per shard: a run of window classes, and the flags of their first windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in one_by_one(batches):
            data, offsets = unpacked(chunk)
            s = stretches(data, offsets)
            _, compare = _candidates(s, chunk)
            windows = _window_flags(s["first"][compare], s["last"][compare], len(data))
            del s
            first = window_classes(data, windows)
            flags = np.zeros(len(data), bool)
            flags[first] = True
            keys, at = first_of(_fingerprints(data, first))
            rows = list(_runs(CLASS, chunk["batch"], keys, bits, _owners(first[at], chunk, offsets)))
            rows.append((FIRST, 0, chunk["batch"], int(windows.sum()), np.packbits(flags[windows]).tobytes(), b""))
            yield _batch(rows, _RUN_TYPES, _RUN)

    return run


def _fingerprints(data: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Hashes of the windows at ascending positions, a stretch of the text at a time."""
    out, i = np.empty(len(positions), np.uint64), 0
    while i < len(positions):
        base = int(positions[i])
        j = int(np.searchsorted(positions, base + CACHE_BYTES))
        at = positions[i:j] - base
        out[i:j] = X.SpanHash(data[base:base + int(at[-1]) + LENGTH], longest=LENGTH)(at, at + LENGTH)
        i = j
    return out


def removed_bytes(chunk: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Flags of the bytes of a shard to remove, from the answers it got."""
    s = stretches(data, offsets)
    late, compare = _candidates(s, chunk)
    windows = _window_flags(s["first"][compare], s["last"][compare], len(data))
    at = np.flatnonzero(windows)
    first = at[_answers(chunk, FIRST)]
    _, order = first_of(_fingerprints(data, first))
    windows[first[order[_answers(chunk, CLASS)]]] = False  # the earliest of all
    again = np.flatnonzero(windows)
    return _window_flags(np.concatenate((s["first"][late], again)), np.concatenate((s["last"][late], again)) + LENGTH - 1, len(data))


def _finish():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, chunk in enumerate(one_by_one([batch.select(["batch", "doc_ids", "lengths", "payload", "answers"])])):
                data, offsets = unpacked(chunk)
                gone = removed_bytes(chunk, data, offsets)
                start = gone.copy()
                start[1:] &= ~gone[:-1]
                edge = offsets[:-1][offsets[:-1] < len(data)]
                start[edge] = gone[edge]
                texts, digests = [], []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    kept = data[a:b][~gone[a:b]].tobytes()
                    texts.append(kept.decode("utf-8", "ignore"))
                    digests.append(hashlib.sha256(kept).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rows").slice(k, 1).flatten(), pa.array(chunk["doc_ids"], pa.int64()), pa.array(np.diff(offsets)),
                     pa.array(X.per_row(gone, offsets)), pa.array(X.per_row(start, offsets)), pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                    names=["row", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    return run


def remove_repeats(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``row`` (the carried columns), digests of what is kept, and ``kept_text``."""
    chunks = chunked(docs, carry)
    bits = bucket_bits(chunks, bytes_per_entry=39)
    merged = lambda runs: runs.groupBy("kind", "bucket").applyInArrow(lean_groups(_merge), _BITS)
    plain = chunks.select("batch", "doc_ids", "lengths", "payload")
    first = stored(merged(plain.mapInArrow(lean(_publish(bits)), _RUN)), "answers")
    answered = lambda a: a.groupBy("batch").agg(F.collect_list(F.struct("kind", "bucket", "n", "bits")).alias("answers"))
    runs = stored(plain.join(answered(first), "batch", "left").mapInArrow(lean(_sort_windows(bits)), _RUN), "windows")
    sweep(docs.sparkSession)  # the shuffles of the first exchange
    flags = runs.where(F.col("kind") == FIRST).select("kind", "bucket", "batch", "n", F.col("keys").alias("bits"))
    second = stored(merged(runs.where(F.col("kind") == CLASS)).union(flags), "answers")
    discard(runs)
    schema = T.StructType([T.StructField("row", chunks.schema["rows"].dataType.elementType), T.StructField("doc_id", T.LongType()),
                           *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")),
                           T.StructField("kept_sha256", T.StringType()), T.StructField("kept_text", T.StringType())])
    return (chunks.select("batch", "doc_ids", "lengths", "rows", "payload").join(answered(first.union(second)), "batch", "left")
            .mapInArrow(lean(_finish()), schema))


def dedup_documents(docs: DataFrame) -> DataFrame:
    """The documents with repeated strings cut out of ``text``; characters cut in two go.

    A null text stays null; ``n_chars``, where there is one, follows the text.
    """
    cleaned = remove_repeats(docs, docs.columns)
    text = F.when(F.col("row.text").isNotNull(), F.col("kept_text"))
    changed = {"text": text} | ({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return cleaned.select(*(changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
