"""Collocations by vertical partitioning of the corpus' suffix tree (after ERA).

The tree holds, for every word of the corpus, the suffix of at most
``max_words`` words that starts there. It is never built whole:

1. Words are counted. A word below ``min_count`` cannot be in a candidate, so
   suffixes end before it.
2. The tree is cut into subtrees by word prefixes of variable length: a prefix
   goes on until its first word of at most ``PREFIX`` occurrences, so none but a
   whole suffix of the hottest words has more. Prefixes are dealt to groups of
   about ``GROUP`` suffixes, the memory budget of one task; those that begin
   with the same hot words go to no more groups than the rarest of these needs.
3. Every chunk of text sends a group its distinct suffixes with counts. A group
   sorts them, which is its subtree in array form, and reads the count of each
   node from the totals of the leaves under it. Nodes above a prefix (words all
   hot) lie in several groups; their parts are summed at the end.

Words are numbered by the ranges of keys that count them; each chunk gets the
numbers of its own words back, so no vocabulary is held whole anywhere. Words
are told apart by 64-bit hashes of language and bytes: with v distinct words
two collide with probability v**2 / 2**65.

Scores are exact: an integer quotient of decimals. A candidate is dropped for
any longer one that holds it; it is enough to look at those one word longer,
because a phrase between the two occurs at least as often as the longer one.

Defined cases: a null text is empty, a null language is ``und``; a null
``doc_id`` is a document of its own; repeated rows count again; an empty table
gives an empty result; other columns, whatever their names, are not read. A
single text must fit in a task: about 60 bytes of memory per byte of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import text as X
from tidemark.llm.chunks import bucket_bits, chunked, cuts, one_by_one, unpacked
from tidemark.llm.tables import discard, pack_sorted, planes, stored, unpack_sorted, unplaned

MIN_COUNT, MAX_WORDS, COVER, TOP, SCALE = 30, 4, 80, 2000, 2_000_000
#: Suffixes of one group, and occurrences from which a word does not end a prefix.
GROUP, PREFIX = 1 << 19, 1 << 19
#: Phrases that one task ranks before the last ranking.
RANKED = 100_000
#: Low bits of a word's code: 0, or for hot words the power of 4 by which it passes ``PREFIX`` at most.
HEAT = 3

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _BREAK.copy()
_GAP[list(b" \t")] = True
_WORD = r"[^\x20\x09.,;:!?\x0A-\x0D]+"
_W = ["w1", "w2", "w3", "w4"]


class PieceWords:
    """Words of a chunk: key, language, piece, and the place of their bytes."""

    def __init__(self, chunk: dict):
        self.data, offsets = unpacked(chunk)
        names = [row["lang"].encode() for row in chunk["rows"]]
        self.langs = sorted(set(names))
        lang_of = np.array([self.langs.index(n) for n in names], np.int64)
        salt = np.array([X.SpanHash(np.frombuffer(n, np.uint8))(np.array([0]), np.array([len(n)]))[0] for n in self.langs], np.uint64)
        keys, langs, pieces, starts, ends, last = [], [], [], [], [], 0
        for i, j in X.slices(offsets):
            data = self.data[offsets[i]:offsets[j]]
            n, cut = len(data), offsets[i:j + 1] - offsets[i]
            gap = _GAP[data]
            first, final = np.ones(n, bool), np.ones(n, bool)
            first[1:], final[:-1] = gap[:-1], gap[1:]
            edge = cut[1:-1][cut[1:-1] < n]
            first[edge] = True
            final[edge[edge > 0] - 1] = True
            start, end = np.flatnonzero(first & ~gap), np.flatnonzero(final & ~gap) + 1
            doc = np.searchsorted(cut, start, "right") - 1
            lang = lang_of[i + doc]
            # Breaks before a word, and documents, number the pieces.
            piece = np.cumsum(_BREAK[data])[start] + doc + last if n else np.zeros(0, np.int64)
            last = int(piece[-1]) + 2 if len(piece) else last
            keys.append(X.mix(X.SpanHash(data, X.LOWER)(start, end) ^ X.mix(salt[lang] + np.uint64(1))))
            langs.append(lang)
            pieces.append(piece)
            starts.append(start + offsets[i])
            ends.append(end + offsets[i])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.key, self.lang, self.piece = join(keys, np.uint64), join(langs, np.int64), join(pieces, np.int64)
        self.start, self.end = join(starts, np.int64), join(ends, np.int64)


def _gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    size = end - start
    at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
    return data[at].tobytes().lower()


_RUN = "bucket int, batch long, n long, keys binary, counts binary, langs array<string>, lang binary, sizes binary, words binary"


def _publish(bits: int):
    """Distinct words of a chunk with counts, by ranges of their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=1)
        for chunk in one_by_one(batches):
            words = PieceWords(chunk)
            keys, first, counts = np.unique(words.key, return_index=True, return_counts=True)
            at, rows = cuts(keys, bits), []
            langs = [n.decode() for n in words.langs]
            for bucket in np.flatnonzero(np.diff(at)).tolist():
                part = slice(at[bucket], at[bucket + 1])
                of = first[part]
                rows.append((bucket, chunk["batch"], len(of), pack_sorted(keys[part]), planes(counts[part].astype(np.uint64)), langs,
                             planes(words.lang[of].astype(np.uint32)), planes((words.end - words.start)[of].astype(np.uint32)),
                             zip_.compress(_gather(words.data, words.start[of], words.end[of]))))
            for row in rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.string()),
                                                            pa.binary(), pa.binary(), pa.binary()), strict=True)],
                    names=[f.split()[0] for f in _RUN.split(", ")])

    return run


_ANSWER = "bucket int, batch long, code long, n long, codes binary, lang string, word string"
_ANSWER_TYPES = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.string())


def _number(buckets: int, min_count: int, prefix: int):
    """One range of keys: codes of every run's words (0: rare), and a row for each word that is not rare.

    A code is the word's number, and in the last ``HEAT`` bits how hot it is.
    """

    def run(table: pa.Table) -> pa.Table:
        rows = [table.slice(i, 1) for i in range(table.num_rows)]
        get = lambda row, name: row[name][0].as_py()
        keys = [unpack_sorted(get(r, "keys")) for r in rows]
        merged = X.distinct(np.concatenate(keys))
        places = [np.searchsorted(merged, k) for k in keys]
        total = np.zeros(len(merged), np.uint64)
        for r, at in zip(rows, places, strict=True):
            total[at] += unplaned(get(r, "counts"), np.uint64)
        bucket = get(rows[0], "bucket")
        common = total >= min_count
        number = (np.cumsum(common) - 1) * buckets + bucket + 1
        if number[-1] >= 1 << 32 - HEAT:
            raise OverflowError("more common words than a 29-bit number can name; raise min_count")
        heat = np.ceil(np.log2(np.maximum(total / prefix, 1)) / 2).astype(np.int64)
        code = np.where(common, number << HEAT | np.minimum(heat, (1 << HEAT) - 1), 0).astype(np.uint32)
        unnamed, out = common.copy(), []
        for r, at in zip(rows, places, strict=True):
            out.append((bucket, get(r, "batch"), None, get(r, "n"), planes(code[at]), None, None))
            mine = np.flatnonzero(unnamed[at])
            if len(mine):
                unnamed[at] = False
                langs, lang = get(r, "langs"), unplaned(get(r, "lang"), np.uint32)
                ends = np.cumsum(unplaned(get(r, "sizes"), np.uint32).astype(np.int64))
                text = zstandard.ZstdDecompressor().decompress(get(r, "words"))
                begins = np.concatenate(([0], ends[:-1]))
                for i in mine.tolist():
                    out.append((bucket, None, int(code[at[i]]), int(total[at[i]]), None, langs[lang[i]], text[begins[i]:ends[i]].decode()))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _ANSWER_TYPES, strict=True)],
                                    names=[f.split()[0] for f in _ANSWER.split(", ")])

    return run


_SUFFIXES = "part int, high binary, low binary, counts binary"


def _suffixes(groups: int, max_words: int):
    """Distinct suffixes of a chunk (words as codes, two in each 64-bit half) with counts, by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in one_by_one(batches):
            words = PieceWords(chunk)
            keys, at = np.unique(words.key, return_inverse=True)
            answers = sorted(chunk["answers"] or (), key=lambda a: a["bucket"])
            codes = np.concatenate([unplaned(a["codes"], np.uint32) for a in answers]) if answers else np.zeros(0, np.uint32)
            code, piece = codes[at].astype(np.uint64) if len(codes) else np.zeros(0, np.uint64), words.piece
            del words, keys, at
            n = len(code)
            word, valid = [code], code > 0
            for k in range(1, 4):
                following = np.zeros(n, np.uint64)
                if k < max_words and n > k:
                    valid = valid.copy()
                    valid[n - k:] = False
                    valid[:n - k] &= (piece[k:] == piece[:n - k]) & (code[k:] > 0)
                    following[:n - k] = np.where(valid[:n - k], code[k:], 0)
                word.append(following)
            long = np.flatnonzero(word[1])
            high, low = word[0][long] << np.uint64(32) | word[1][long], word[2][long] << np.uint64(32) | word[3][long]
            order = np.lexsort((low, high))
            high, low = high[order], low[order]
            if not len(high):
                continue
            head = np.flatnonzero(np.concatenate(([True], (high[1:] != high[:-1]) | (low[1:] != low[:-1]))))
            counts = np.diff(np.append(head, len(high))).astype(np.uint64)
            high, low = high[head], low[head]
            part = _group(high, low, groups)
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(groups + 1))
            for g in np.flatnonzero(np.diff(edges)).tolist():
                of = order[edges[g]:edges[g + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g], pa.int32()), *(pa.array([b], pa.binary()) for b in (pack_sorted(high[of]), planes(low[of]), planes(counts[of])))],
                    names=["part", "high", "low", "counts"])

    return run


def _heat(high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
    """Least heat of the first 1, 2, 3 and 4 words; 0 where one of them is not hot."""
    mask, out = np.uint64((1 << HEAT) - 1), []
    for half, shift in ((high, 32), (high, 0), (low, 32), (low, 0)):
        heat = half >> np.uint64(shift) & mask
        out.append(np.minimum(heat, out[-1]) if out else heat)
    return out


def _group(high: np.ndarray, low: np.ndarray, groups: int) -> np.ndarray:
    """Group of each suffix: by its prefix up to the first word that is not hot."""
    heat = _heat(high, low)
    top, two, none = np.uint64(0xFFFFFFFF00000000), np.uint64(2), np.uint64(0)
    first = X.mix(np.where(heat[0] > 0, high, high & top))
    third, fourth = X.mix(low & top), X.mix(low)
    # Behind two or three hot words the next one picks among as many groups as their rarest can fill.
    first = first + np.where(heat[1] > 0, third % (np.uint64(1) << two * heat[1]), none)
    first = first + np.where(heat[2] > 0, fourth % (np.uint64(1) << two * heat[2]), none)
    return (first % np.uint64(groups)).astype(np.int64)


_PHRASES = "words int, w1 long, w2 long, w3 long, w4 long, f long"


def _subtree(min_count: int):
    """Counts of a group's nodes: those of ``min_count`` and more, and the parts of nodes that other groups share."""

    def run(table: pa.Table) -> pa.Table:
        columns = {name: [] for name in ("high", "low", "counts")}
        for name, parts in columns.items():
            for blob in table[name]:
                parts.append((unpack_sorted if name == "high" else lambda b: unplaned(b, np.uint64))(blob.as_py()))
        high, low, counts = (np.concatenate(p) for p in columns.values())
        order = np.lexsort((low, high))
        high, low, counts = high[order], low[order], counts[order].astype(np.int64)
        heat, top = _heat(high, low), np.uint64(0xFFFFFFFF00000000)
        out = []
        for depth, left, right in ((2, high, np.zeros(1, np.uint64)), (3, high, low & top), (4, high, low)):
            new = np.ones(len(high), bool)
            new[1:] = left[1:] != left[:-1]
            if depth > 2:
                new[1:] |= right[1:] != right[:-1]
            head = np.flatnonzero(new)
            total = np.add.reduceat(counts, head)
            there = np.ones(len(head), bool) if depth == 2 else ((low[head] >> np.uint64(32 if depth == 3 else 0)) & np.uint64(0xFFFFFFFF)) > 0
            shared = heat[depth - 1][head] > 0 if depth < 4 else np.zeros(len(head), bool)
            keep = there & ((total >= min_count) | shared)
            at = head[keep]
            split = lambda half, shift: (half[at] >> np.uint64(shift) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            zero = np.zeros(len(at), np.int64)
            out.append(pa.table({"words": pa.array(np.full(len(at), depth, np.int32)), "w1": split(high, 32), "w2": split(high, 0),
                                 "w3": split(low, 32) if depth > 2 else zero, "w4": split(low, 0) if depth > 3 else zero, "f": total[keep]}))
        return pa.concat_tables(out)

    return run


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, prefix: int = PREFIX, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """Counts ``words, w1..w4, f`` of all phrases of 1 to ``max_words`` (4 at most) words with ``f >= min_count``, and ``code, lang, word``."""
    source = docs.select("doc_id", "text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    chunks = chunked(source, ["lang"])
    bits = bucket_bits(chunks, bytes_per_entry=60)
    plain = chunks.select("batch", "doc_ids", "lengths", "rows", "payload")
    answers = stored(plain.mapInArrow(_publish(bits), _RUN).groupBy("bucket").applyInArrow(_number(1 << bits, min_count, prefix), _ANSWER), "codes")
    names = answers.where(F.col("batch").isNull()).select("code", "lang", "word", F.col("n").alias("f"))
    common = names.agg(F.sum("f")).first()[0] or 0
    groups = max(1, -(-int(common) // group))
    replies = answers.where(F.col("batch").isNotNull()).groupBy("batch").agg(F.collect_list(F.struct("bucket", "codes")).alias("answers"))
    parts = plain.join(replies, "batch").mapInArrow(_suffixes(groups, max_words), _SUFFIXES)
    nodes = parts.groupBy("part").applyInArrow(_subtree(min_count), _PHRASES)
    single = names.select(F.lit(1).alias("words"), F.col("code").alias("w1"), *(F.lit(0).cast("long").alias(w) for w in _W[1:]), "f")
    counts = stored(nodes.groupBy("words", *_W).agg(F.sum("f").alias("f")).where(F.col("f") >= min_count).unionByName(single), "phrases")
    discard(chunks)
    return counts, names.select("code", "lang", "word")


def collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, cover: int = COVER, prefix: int = PREFIX, group: int = GROUP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of 2 to 4 words of every language."""
    counts, names = phrase_counts(docs, min_count, MAX_WORDS, prefix, group)
    zero = F.lit(0).cast("long")
    longer = counts.where(F.col("words") >= 2)

    # A phrase is dropped for one that is a word longer, holds it and occurs nearly as often.
    ends = [F.when(F.col("words") == 3, zero).otherwise(F.col("w3")).alias("w3")]
    inner = longer.where(F.col("words") >= 3)
    heads = inner.select("w1", "w2", *ends, "f")
    tails = inner.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("w4").alias("w3"), "f")
    held = heads.unionByName(tails).groupBy("w1", "w2", "w3").agg(F.max("f").alias("held")).withColumn("w4", zero)
    kept = longer.join(held, _W, "left").where(F.col("held").isNull() | (100 * F.col("held").cast("decimal(20,0)") < cover * F.col("f").cast("decimal(20,0)"))).drop("held")

    def cut(k: int):
        left = [F.col(w) if i < k else zero for i, w in enumerate(_W[:3])]
        right = [F.col(_W[i + k]) if i + k < 4 else zero for i in range(3)]
        return F.when(F.col("words") > k, F.struct(F.lit(k).alias("k"), *(c.alias(f"l{i}") for i, c in enumerate(left)), *(c.alias(f"r{i}") for i, c in enumerate(right))))

    cuts_ = kept.select("*", F.explode(F.filter(F.array(*(cut(k) for k in (1, 2, 3))), lambda c: c.isNotNull())).alias("cut")).select("words", *_W, "f", "cut.*")
    part = counts.where(F.col("words") <= 3)
    for side in "lr":
        keyed = part.select(*(F.col(w).alias(f"{side}{i}") for i, w in enumerate(_W[:3])), F.col("f").alias(side))
        cuts_ = cuts_.join(keyed, [f"{side}{i}" for i in range(3)])
    score = F.expr(f"CAST(f AS DECIMAL(20,0)) * {SCALE} DIV (CAST(l AS DECIMAL(20,0)) + r)")
    scored = (cuts_.groupBy("words", *_W, "f").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("least"))
              .select("words", *_W, F.col("f").alias("a"), "least.score", "least.l", "least.r"))

    # Words are looked up for those that can be among the first only; ties stay in.
    langs = scored.join(names.select(F.col("code").alias("w1"), "lang"), "w1")
    # A language's first are the first of its parts' first, so no task ranks all its candidates.
    parts = max(16, counts.count() // RANKED)
    leaders = langs.withColumn("part", F.pmod(F.xxhash64(*_W), F.lit(parts)))
    for keys in (["lang", "part"], ["lang"]):
        place = F.rank().over(Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("a").desc()))
        leaders = leaders.withColumn("place", place).where(F.col("place") <= top).drop("place")
    leaders = leaders.drop("part")
    spelled = (leaders.select("*", F.posexplode(F.slice(F.array(*_W), F.lit(1), F.col("words"))).alias("pos", "code"))
               .join(names.select("code", "word"), "code")
               .groupBy("lang", *_W, "a", "l", "r", "score").agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("spelled"))
               .withColumn("phrase", F.array_join(F.col("spelled.word"), " ")))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    n = docs.groupBy(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")).agg(F.sum(F.regexp_count("text", F.lit(_WORD))).cast("long").alias("n"))
    n = stored(n, "words")
    return (spelled.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).join(n, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
