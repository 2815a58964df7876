"""LM scoring by deleted interpolation.

A bigram model: the maximum-likelihood bigram, unigram and uniform estimates
are mixed, with weights for each bucket of the context's frequency (powers of
two). The weights come from expectation-maximisation on a deleted part of the
training documents, scored with counts from which that part is taken out.

Chunks of text publish sorted runs of their distinct unigram and bigram keys
with counts; ranges of the key space are summed, and each chunk gets the
counts of its own keys back. So no vocabulary is held whole anywhere, and a
hot word costs one entry per chunk. Bigram keys are as wide as the corpus
needs for a false match below one in 2**24.

Documents whose ``crc32(doc_id) mod 10`` is 0 are held out; remainder 9 is the
deleted part. Defined cases: a null text is empty (its end is scored); a null
``doc_id`` is held out; without training documents every estimate is uniform;
an empty table gives an empty result; repeated rows are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import text as X
from tidemark.llm.chunks import bucket_bits, chunked, cuts, one_by_one, unpacked
from tidemark.llm.tables import lean, lean_groups, pack_sorted, planes, stored, unpack_sorted, unplaned

HELD_OUT, TRAINING, DELETED = range(3)
UNIGRAM, BIGRAM = range(2)
BUCKETS = 65
ROUNDS, TOLERANCE = 25, 1e-4
#: Cells per factor of two in the table of held-out probabilities.
FINE = 16

_END, _START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_MIX_A, _MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def fold_of(doc_id: Column) -> Column:
    remainder = F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 10
    return F.when(remainder == 0, HELD_OUT).when(remainder == 9, DELETED).otherwise(TRAINING)


class Tokens:
    """Unigram and bigram keys of a chunk, one per token, and the token's row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int):
        values, contexts, rows = [], [], []
        for i, j in X.slices(offsets):
            words = X.Words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            n = len(words.starts) + j - i
            value, context = np.full(n, _END), np.full(n, _START)
            at = np.arange(len(words.starts)) + words.doc
            value[at] = words.hashes(X.LOWER)
            context[at + 1] = value[at]
            values.append(value)
            contexts.append(context)
            rows.append(np.repeat(np.arange(i, j), words.counts + 1))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        value, self.context, self.row = join(values, np.uint64), join(contexts, np.uint64), join(rows, np.int64)
        self.unigram = X.mix(value)
        drop = np.uint64(64 - width)
        self.bigram = X.mix(self.context * _MIX_A + value * _MIX_B) >> drop << drop
        self.opens = self.context == _START
        self.context = X.mix(self.context)


_RUN = "kind int, bucket int, batch long, fold int, n int, keys binary, counts binary"
_RUN_TYPES = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())


def _batch(rows: list[tuple], types: tuple, names: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                      names=[f.split()[0] for f in names.split(", ")])


def _publish(bits: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in one_by_one(batches):
            tokens, rows = Tokens(*unpacked(chunk), width), []
            for kind, all_keys in ((UNIGRAM, tokens.unigram), (BIGRAM, tokens.bigram)):
                ordered = np.sort(all_keys)
                head = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)
                keys, counts = ordered[head], np.diff(np.append(head, len(ordered)))
                at = cuts(keys, bits)
                for bucket in np.flatnonzero(np.diff(at)).tolist():
                    part = slice(at[bucket], at[bucket + 1])
                    rows.append((kind, bucket, chunk["batch"], chunk["fold"], int(at[bucket + 1] - at[bucket]), pack_sorted(keys[part]),
                                 planes(counts[part].astype(np.uint64)) if chunk["fold"] != HELD_OUT else b""))
            yield _batch(rows, _RUN_TYPES, _RUN)

    return run


#: Answers to runs; and with a null batch, the totals of a key range.
_ANSWER = "kind int, bucket int, batch long, n int, counts binary, deleted binary, types long, tokens long, deleted_tokens long"
_ANSWER_TYPES = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())


def _sum_range(table: pa.Table) -> pa.Table:
    """One range of keys: training counts of every run's keys."""
    rows = table.to_pylist()
    runs = [unpack_sorted(r["keys"]) for r in rows]
    merged = X.distinct(np.concatenate(runs))
    places = [np.searchsorted(merged, k) for k in runs]
    total, deleted = np.zeros(len(merged), np.uint64), np.zeros(len(merged), np.uint64)
    for r, at in zip(rows, places, strict=True):
        if r["fold"] != HELD_OUT:
            counts = unplaned(r["counts"], np.uint64)
            total[at] += counts
            if r["fold"] == DELETED:
                deleted[at] += counts
    out = [(rows[0]["kind"], rows[0]["bucket"], None, 0, None, None, int((total > 0).sum()), int(total.sum()), int(deleted.sum()))]
    for r, at in zip(rows, places, strict=True):
        out.append((r["kind"], r["bucket"], r["batch"], r["n"], planes(total[at]),
                    planes(deleted[at]) if r["fold"] == DELETED else None, None, None, None))
    return pa.Table.from_batches([_batch(out, _ANSWER_TYPES, _ANSWER)])


class Counts:
    """Counts of a chunk's tokens: ``bigram``, ``context`` and ``unigram`` of each token."""

    def __init__(self, chunk: dict, tokens: Tokens, starts: int, name: str):
        found = {}
        for kind in (UNIGRAM, BIGRAM):
            parts = sorted((a for a in chunk["answers"] or () if a["kind"] == kind), key=lambda a: a["bucket"])
            found[kind] = np.concatenate([unplaned(a[name], np.uint64) for a in parts]).astype(np.float64) if parts else np.zeros(0)
        keys = X.distinct(tokens.unigram)
        self.unigram = found[UNIGRAM][np.searchsorted(keys, tokens.unigram)]
        self.context = np.full(len(tokens.context), float(starts))
        self.context[~tokens.opens] = found[UNIGRAM][np.searchsorted(keys, tokens.context[~tokens.opens])]
        self.bigram = found[BIGRAM][np.searchsorted(X.distinct(tokens.bigram), tokens.bigram)]


def _estimates(bigram: np.ndarray, context: np.ndarray, unigram: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context bucket, bigram estimate, unigram estimate) of each token."""
    bucket = np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))) + 1, 0).astype(np.int64)
    return bucket, np.where(context > 0, bigram / np.maximum(context, 1), 0.0), unigram / max(n, 1)


_CELLS = "bucket int, cell2 int, cell1 int, weight long, sum2 double, sum1 double"


def _held_out_cells(width: int, starts: int, deleted_starts: int, n: int):
    """Deleted documents' tokens, summed by context bucket and fine cells of both estimates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = lambda p: np.where(p > 0, np.round(-np.log2(np.maximum(p, 1e-300)) * FINE), -1).astype(np.int64)
        for chunk in one_by_one(batches):
            tokens = Tokens(*unpacked(chunk), width)
            all_, out = Counts(chunk, tokens, starts, "counts"), Counts(chunk, tokens, deleted_starts, "deleted")
            bucket, p2, p1 = _estimates(all_.bigram - out.bigram, all_.context - out.context, all_.unigram - out.unigram, n)
            key = (bucket << 32 | (cell(p2) + 1) << 16 | cell(p1) + 1).astype(np.int64)
            keys, at = np.unique(key, return_inverse=True)
            sums = lambda v: np.bincount(at, weights=v, minlength=len(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array((keys >> 32).astype(np.int32)), pa.array((keys >> 16 & 0xFFFF).astype(np.int32)), pa.array((keys & 0xFFFF).astype(np.int32)),
                 pa.array(np.bincount(at, minlength=len(keys)).astype(np.int64)), pa.array(sums(p2)), pa.array(sums(p1))],
                names=["bucket", "cell2", "cell1", "weight", "sum2", "sum1"])

    return run


def mixture_weights(cells: DataFrame, uniform: float) -> np.ndarray:
    """EM weights (bigram, unigram, uniform) of each context bucket.

    Every bucket starts from equal weights and keeps one imagined token spread
    evenly, so no weight becomes zero. A round is one aggregation that returns
    a row for each bucket.
    """
    weights = np.full((BUCKETS, 3), 1 / 3)
    p = (F.col("sum2") / F.col("weight"), F.col("sum1") / F.col("weight"), F.lit(uniform))
    for _ in range(ROUNDS):
        share = [F.element_at(F.array(*(F.lit(float(w)) for w in weights[:, k])), F.col("bucket") + 1) * p[k] for k in range(3)]
        whole = share[0] + share[1] + share[2]
        sums = cells.groupBy("bucket").agg(*(F.sum(F.col("weight") * s / whole).alias(f"w{k}") for k, s in enumerate(share))).collect()
        new = np.full((BUCKETS, 3), 1 / 3)
        for r in sums:
            got = np.array([r["w0"], r["w1"], r["w2"]]) + 1 / 3
            new[r["bucket"]] = got / got.sum()
        moved, weights = np.abs(new - weights).max(), new
        if moved < TOLERANCE:
            break
    return weights


_SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _score(width: int, starts: int, n: int, v: int, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in one_by_one(batches):
            tokens, rows = Tokens(*unpacked(chunk), width), len(chunk["doc_ids"])
            c = Counts(chunk, tokens, starts, "counts")
            bucket, p2, p1 = _estimates(c.bigram, c.context, c.unigram, n)
            mixed = weights[bucket, 0] * p2 + weights[bucket, 1] * p1 + weights[bucket, 2] / (v + 1)
            base = np.log10((c.unigram + 0.1) / (n + 0.1 * (v + 1)))
            sums = lambda x: np.bincount(tokens.row, weights=x, minlength=rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk["doc_ids"], pa.int64()), pa.array([chunk["fold"] == HELD_OUT] * rows, pa.bool_()),
                 pa.array(np.bincount(tokens.row, minlength=rows).astype(np.int64)), pa.array(sums(c.unigram > 0).astype(np.int64)),
                 pa.array(np.full(rows, n, np.int64)), pa.array(sums(base)), pa.array(sums(np.log10(mixed)))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    chunks = chunked(docs, [], fold_of(F.col("doc_id")))
    size = chunks.agg(F.sum("n_bytes").alias("bytes"), F.sum(F.when(F.col("fold") != HELD_OUT, F.size("doc_ids"))).alias("starts"),
                      F.sum(F.when(F.col("fold") == DELETED, F.size("doc_ids"))).alias("deleted")).first()
    starts, deleted_starts = size["starts"] or 0, size["deleted"] or 0
    width = min(64, -(-(((size["bytes"] or 0) // 4 + 1).bit_length() + 24) // 8) * 8)
    bits = bucket_bits(chunks, bytes_per_entry=7, entries=1 << 20)
    plain = chunks.select("batch", "fold", "doc_ids", "lengths", "payload")
    answers = stored(plain.mapInArrow(lean(_publish(bits, width)), _RUN).groupBy("kind", "bucket").applyInArrow(lean_groups(_sum_range), _ANSWER), "counts")
    # Totals: one row for each key range.
    totals = (answers.where((F.col("kind") == UNIGRAM) & F.col("batch").isNull())
              .agg(F.sum("types").alias("v"), F.sum("tokens").alias("n"), F.sum("deleted_tokens").alias("d")).first())
    v, n, deleted = (totals[k] or 0 for k in ("v", "n", "d"))
    replies = (answers.where(F.col("batch").isNotNull()).groupBy("batch")
               .agg(F.collect_list(F.struct("kind", "bucket", "counts", "deleted")).alias("answers")))
    cells = (plain.where(F.col("fold") == DELETED).join(replies, "batch")
             .mapInArrow(lean(_held_out_cells(width, starts, deleted_starts, n - deleted)), _CELLS)
             .groupBy("bucket", "cell2", "cell1").agg(*(F.sum(c).alias(c) for c in ("weight", "sum2", "sum1"))))
    weights = mixture_weights(stored(cells, "cells"), 1 / (v + 1))
    return plain.join(replies, "batch", "left").mapInArrow(lean(_score(width, starts, n, v, weights)), _SCORES)
