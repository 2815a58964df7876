"""Token-id output in bit planes.

Documents are tokenised in ascending ``doc_id`` order; the ids of a part form
blocks of fixed size. A block is transposed into bit planes (all lowest bits,
all second bits ...), and every plane is compressed with zstandard. Two
tables make a file set: ``blocks`` (payload, plane ends, and the documents
that each block touches) and ``index`` (block to global id position). They are
Parquet tables, so any file system that Spark writes to will do.

Defined cases: a null text is empty and holds the end id only; a null
``doc_id`` comes first; rows that share a ``doc_id`` are all written, ordered
by a hash of their text; an empty table gives empty tables; a control string
in a text becomes its own id, as in the library; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text as X

BLOCK = 1 << 16
END_ID = 0
#: Pieces in the memo, and the bytes of the longest one.
MEMO = 500_000
LONGEST_MEMO = 256
#: Text that is cut at once, and pieces that go to the library at once.
UNIT_BYTES = 2 << 20
GROUP_BYTES = 4096
NO_TOKEN = 0xFFFFFFFF

_GAP, _UNSURE, _LETTER, _SIGN = 1, 2, 4, 8
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = _SIGN
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[[*range(9, 14), 32]] = _GAP
_KIND[28:32] = _UNSURE  # white space to some

BLOCKS = ("part int, block int, first long, n_ids int, width int, doc_from long, doc_ids array<long>, "
          "lengths array<int>, plane_ends array<int>, payload binary")


def pack_block(ids: np.ndarray) -> tuple[int, list[int], bytes]:
    """(number of planes, end of each plane in the payload, payload) of one block."""
    width = max(1, int(ids.max(initial=0)).bit_length())
    squeeze, ends, out = zstandard.ZstdCompressor(level=1), [], []
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    for k in range(width):
        if k % 8 == 0:
            octet = np.ascontiguousarray(octets[:, k // 8])
        out.append(squeeze.compress(np.packbits((octet >> np.uint8(k % 8)) & np.uint8(1)).tobytes()))
        ends.append((ends[-1] if ends else 0) + len(out[-1]))
    return width, ends, b"".join(out)


def unpack_block(n: int, ends: list[int], payload: bytes) -> np.ndarray:
    """The ids of one block, from its planes."""
    octets = np.zeros((4, n), np.uint8)
    expand, at = zstandard.ZstdDecompressor(), 0
    for k, end in enumerate(ends):
        bits = np.unpackbits(np.frombuffer(expand.decompress(payload[at:end]), np.uint8), count=n)
        octets[k // 8] |= bits << np.uint8(k % 8)
        at = end
    return np.ascontiguousarray(octets.T).view("<u4").reshape(-1)


def _letters(data: np.ndarray) -> np.ndarray:
    """Flags of the bytes of Latin letters: A-Z, a-z, U+00C0 to U+024F without the signs U+00D7 and U+00F7."""
    flags = (_KIND[data] & _LETTER).astype(bool)
    lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC9))
    if len(lead):
        first, second = data[lead], data[lead + 1]
        fits = (second & 0xC0 == 0x80) & ~((first == 0xC3) & ((second == 0x97) | (second == 0xB7))) & ~((first == 0xC9) & (second > 0x8F))
        flags[lead[fits]] = flags[lead[fits] + 1] = True
    return flags


def _solid(data: np.ndarray) -> np.ndarray:
    """Flags of the bytes of characters that are no white space by any reading."""
    flags = ~(_KIND[data] & (_GAP | _UNSURE)).astype(bool)
    lead = np.flatnonzero((data == 0xC2) | (data >= 0xE1) & (data <= 0xE3))
    if len(lead):
        a, b, c = data[lead], *(data[np.minimum(lead + k, len(data) - 1)] for k in (1, 2))
        two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
        three = ((a == 0xE1) & ((b == 0x9A) & (c == 0x80) | (b == 0xA0) & (c == 0x8E))
                 | (a == 0xE2) & ((b == 0x80) & ((c <= 0x8F) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F))
                 | (a == 0xE3) & (b == 0x80) & (c == 0x80))
        for blank, size in ((two, 2), (three, 3)):
            for k in range(size):
                flags[np.minimum(lead[blank] + k, len(data) - 1)] = False
    return flags


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Flags of the bytes before which texts (``offsets``) may be cut: see :class:`PieceEncoder`."""
    kind, letter, solid = _KIND[data], _letters(data), _solid(data)
    gap, sign, space, quote = (kind & _GAP).astype(bool), (kind & _SIGN).astype(bool), data == 32, data == 39
    begin = offsets[:-1][offsets[:-1] < len(data)]
    ahead = solid.copy()  # whether the next byte of the same text is solid
    ahead[begin] = False
    ahead[:-1], ahead[-1] = ahead[1:], False
    alone = gap & ~space & ahead
    cut = gap & ahead
    cut[1:] |= alone[:-1] | gap[1:] & solid[:-1] | letter[:-1] & sign[1:] | (sign & ~quote)[:-1] & letter[1:]
    cut[begin] = True
    return cut


class PieceEncoder:
    """A byte-level tokenizer's ids of whole texts, with a bounded memo of pieces.

    The pre-tokenizer scans from left to right and never looks back, so a text may
    be cut where a pre-token ends whatever the rest is, and where the left part
    alone would end alike:

    - between a visible character and white space,
    - before the last white space in front of a visible character, and behind
      it unless it is a space (a space belongs to what follows),
    - between a Latin letter and an ASCII sign or digit, both ways, but not
      between an apostrophe and a letter (``'s`` is one pre-token).

    Many texts are cut at once and each distinct piece goes through the library
    once. A piece of Latin letters is one pre-token and goes to the library's
    merges directly, many side by side: between them stands a byte that
    no merge takes. Texts that hold a control string (an added token) stay whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()  # of batches
        self.merges = Tokenizer(self.tokenizer.model)  # without pre-tokenizer and added tokens
        self.memo: dict[bytes, bytes] = {}
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # The symbols of all bytes that begin or continue a Latin letter, of the space, and of control characters.
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.symbols = np.zeros(256, "<u4")
        for char in map(chr, range(0x250)):
            for byte, symbol in zip(char.encode(), level.pre_tokenize_str(char)[0][0], strict=True):
                self.symbols[byte] = ord(symbol)
        merged = set().union(*(t for t in self.tokenizer.get_vocab() if len(t) > 1))
        free = [byte for byte in range(32) if (symbol := chr(self.symbols[byte])) not in merged and self.tokenizer.model.token_to_id(symbol) is not None]
        self.between = free[0] if free else None

    def _merged(self, words: list[bytes]) -> Iterator[bytes]:
        """Ids of pieces of Latin letters, with or without a space in front."""
        mark = NO_TOKEN if self.between is None else self.tokenizer.model.token_to_id(chr(self.symbols[self.between]))
        joint = b"" if self.between is None else bytes([self.between])
        offsets = np.concatenate(([0], np.cumsum([len(w) + 1 for w in words])))
        for i, j in X.slices(offsets, 1 if self.between is None else GROUP_BYTES):
            text = self.symbols[np.frombuffer(joint.join(words[i:j]), np.uint8)].tobytes().decode("utf-32-le")
            ids = np.array([*self.merges.encode_batch_fast([text], add_special_tokens=False)[0].ids, mark], "<u4")
            raw, at = ids.tobytes(), 0
            for end in (4 * np.flatnonzero(ids == mark)).tolist():
                yield raw[at:end]
                at = end + 4

    def _encoded(self, pieces: list[bytes]) -> Iterator[bytes]:
        """Ids of any pieces."""
        for i, j in X.slices(np.concatenate(([0], np.cumsum([len(p) for p in pieces]))), GROUP_BYTES):
            for e in self.tokenizer.encode_batch_fast([p.decode() for p in pieces[i:j]], add_special_tokens=False):
                yield np.array(e.ids, "<u4").tobytes()

    def _learned(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of new pieces."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        offsets = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
        letter = _letters(data)
        fits = letter.copy()
        fits[offsets[:-1]] |= data[offsets[:-1]] == 32
        whole = (X.per_row(~fits, offsets) == 0) & (X.per_row(letter, offsets) > 0)
        words = [p for p, w in zip(pieces, whole.tolist(), strict=True) if w]
        others = [p for p, w in zip(pieces, whole.tolist(), strict=True) if not w]
        return dict(zip(words, self._merged(words), strict=True)) | dict(zip(others, self._encoded(others), strict=True))

    def _ids_of(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces, from the memo or learned."""
        found = list(map(self.memo.get, pieces))
        new = [p for p, ids in zip(pieces, found, strict=True) if ids is None]
        if new:
            learned = self._learned(new)
            found = [learned[p] if ids is None else ids for p, ids in zip(pieces, found, strict=True)]
            if len(self.memo) + len(new) > MEMO:
                self.memo, learned = {}, dict(islice(zip(pieces, found, strict=True), MEMO))  # frequent pieces are among them
            self.memo |= {p: ids for p, ids in learned.items() if len(p) <= LONGEST_MEMO}
        return found

    def many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty), one after the other, and the texts' offsets in them."""
        data, offsets = X.text_bytes(texts)
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        cut, raw = _cuts(data, offsets), data.tobytes()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, "right"))  # the text ends at offsets[row]
                cut[offsets[row - 1] + 1:offsets[row]] = False
                at = raw.find(token, int(offsets[row]))
        starts = np.flatnonzero(cut)
        spans = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(raw)])
        spans = spans.dictionary_encode()
        ids = pa.array(self._ids_of(spans.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        _, ends, out = ids.take(spans.indices).buffers()
        ends = np.frombuffer(ends, np.int64, len(starts) + 1) // 4
        return np.frombuffer(out, "<u4", ends[-1]), ends[np.searchsorted(starts, offsets)]

    def __call__(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.many(pa.array([text]))[0].tobytes()


@lru_cache(maxsize=1)
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder for each worker process, so that tasks share its memo."""
    return PieceEncoder(path)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], pa.Array]]:
    """Document ids and texts, about ``UNIT_BYTES`` of text at a time (one text at least)."""
    held: list[pa.RecordBatch] = []
    size = 0

    def unit() -> tuple[list[int | None], pa.Array]:
        return [i for b in held for i in b.column("doc_id").to_pylist()], pa.concat_arrays([b.column("text") for b in held])

    for batch in batches:
        _, offsets = X.text_bytes(batch.column("text"))
        for i, j in X.slices(offsets, UNIT_BYTES):
            n = int(offsets[j] - offsets[i])
            if held and size + n > UNIT_BYTES:
                yield unit()
                held, size = [], 0
            held.append(batch.slice(i, j - i))
            size += n
    if held:
        yield unit()


def _writer(tokenizer_path: str, block: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = piece_encoder(tokenizer_path), TaskContext.get().partitionId()
        end = np.array([END_ID], "<u4")
        held: list[np.ndarray] = []  # ids of the open block
        docs: list[int | None] = []
        lengths: list[int] = []
        n, number, first, ordinal, doc_from = 0, 0, 0, 0, 0

        def close() -> pa.RecordBatch:
            width, ends, payload = pack_block(np.concatenate(held))
            row = {"part": part, "block": number, "first": first, "n_ids": n, "width": width, "doc_from": doc_from,
                   "doc_ids": docs, "lengths": lengths, "plane_ends": ends, "payload": payload}
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()),
                     pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], names=list(row))

        for doc_ids, texts in _units(batches):
            found, offsets = encoder.many(texts)
            for doc_id, i, j in zip(doc_ids, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                ids = np.append(found[i:j], end)
                while len(ids):
                    take = ids[:block - n]
                    if not n:
                        doc_from = ordinal
                    held.append(take)
                    docs.append(doc_id)
                    lengths.append(len(take))
                    n, ids = n + len(take), ids[len(take):]
                    if n == block:
                        yield close()
                        number, first, n, held, docs, lengths = number + 1, first + n, 0, [], [], []
                ordinal += 1
        if n:
            yield close()

    return write


def write_ids(docs: DataFrame, tokenizer_path: str, path: str, block: int = BLOCK) -> None:
    """Write ``blocks`` and ``index`` under ``path``, in ascending ``doc_id`` order."""
    spark = docs.sparkSession
    ordered = (docs.select("doc_id", F.col("text").cast("string").alias("text"))
               .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text")))
    ordered.mapInArrow(_writer(tokenizer_path, block), BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # One row per part: as many as the range partitions.
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    starts, total = [], 0
    for row in sizes:
        starts.append((row["part"], total))
        total += row["n"]
    offsets = spark.createDataFrame(starts, "part int, part_start long")
    (blocks.select("part", "block", "first", "n_ids").join(F.broadcast(offsets), "part")
     .select("part", "block", (F.col("part_start") + F.col("first")).alias("start"), "n_ids")
     .write.parquet(f"{path}/index"))


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC-32 polynomial (reflected bits)."""
    product = 0
    for k in range(32):
        if b >> (31 - k) & 1:
            product ^= a
        a = (a >> 1) ^ (0xEDB88320 if a & 1 else 0)
    return product


def crc_joined(crc: int, following: int, length: int) -> int:
    """CRC-32 of two joined byte strings, the second of ``length`` bytes."""
    power, square, n = 1 << 31, 1 << 30, 8 * length
    while n:
        if n & 1:
            power = _times(power, square)
        square, n = _times(square, square), n >> 1
    return _times(crc, power) ^ following


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Block rows with the global position of their first id."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    index = spark.read.schema("part int, block int, start long, n_ids int").parquet(f"{path}/index")
    starts = index.where("block = 0").select("part", F.col("start").alias("part_start"))
    # One row per part.
    return blocks.join(F.broadcast(starts), "part").withColumn("start", F.col("part_start") + F.col("first"))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and document: position, ids and checksum of the document's ids in the block."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            raw, at = unpack_block(r["n_ids"], r["plane_ends"], r["payload"]).astype("<u4").tobytes(), 0
            for k, (doc_id, n) in enumerate(zip(r["doc_ids"], r["lengths"], strict=True)):
                rows.append((r["part"], r["doc_from"] + k, doc_id, r["start"] + at, n, zlib.crc32(raw[4 * at:4 * (at + n)])))
                at += n
        names = ("part", "ordinal", "doc_id", "start", "n", "crc")
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        cols = list(zip(*rows, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=list(names))


def _join_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        starts, counts, crcs = [], [], []
        for segments in batch.column("segments").to_pylist():
            segments.sort(key=lambda s: s["start"])
            crc = segments[0]["crc"]
            for s in segments[1:]:
                crc = crc_joined(crc, s["crc"], 4 * s["n"])
            starts.append(segments[0]["start"])
            counts.append(sum(s["n"] for s in segments))
            crcs.append(crc)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(v, pa.int64()) for v in (starts, counts, crcs))],
            names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    segments = read_blocks(spark, path).mapInArrow(
        _segments, "part int, ordinal long, doc_id long, start long, n long, crc long")
    return (segments.groupBy("part", "ordinal")
            .agg(F.first("doc_id").alias("doc_id"), F.collect_list(F.struct("start", "n", "crc")).alias("segments"))
            .select("doc_id", "segments")
            .mapInArrow(_join_segments, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            ids = unpack_block(r["n_ids"], r["plane_ends"], r["payload"]).astype(np.int64)
            n = np.array(r["lengths"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["doc_ids"][k] for k in np.repeat(np.arange(len(n)), n)], pa.int64()),
                 pa.array(r["start"] + np.arange(len(ids))), pa.array(ids)], names=["doc_id", "position", "id"])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, position, id`` of every stored id."""
    return read_blocks(spark, path).mapInArrow(_expand, "doc_id long, position long, id long")
