"""BPE encoding as a streaming transducer with bounded lookahead, and decoding.

A token boundary depends on the text behind it only through chains of merges
of falling rank. :func:`sufficient_lookahead` computes from the merge list the
longest such chain in bytes. So the transducer keeps a short buffer, encodes
it, and emits every token that ends at least that far before the buffer's end:
those tokens are final whatever follows.

A word's end settles all its tokens. So words that fit into the buffer need no
lookahead, and :class:`Lanes` merges many of them side by side: in each step
every word makes its merge of lowest rank. Longer words stream. Texts are read
in blocks cut at white space; the distinct new words of a block are encoded
together and kept in a memo of two generations, so frequent words stay.

Decoding feeds the tokens' bytes to an incremental byte-to-text machine that
holds at most one unfinished character.

Memory: beside the text itself a block of ``BLOCK_CHARS`` and the memo, for
words and texts of any length.

Defined cases: null and empty texts have no tokens; white space is dropped;
repeated rows are encoded one by one; an empty table gives an empty result;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import lean

BLOCK = 64
#: Entries of each of the memo's two generations, and the longest piece in it.
MEMO = 90_000
LONGEST_MEMO = 64
#: Characters of a block of text, and tokens or characters of a piece that goes to the digests in parts.
BLOCK_CHARS = 1 << 20
LONG = 4096
WORD_END = "</w>"

#: The white space that the normaliser folds, and the
#: pre-tokenizer's pattern (from the tokenizer's file).
_BLANK = re.compile("[\t-\r \x85\xa0  -     　]+")

_CUT = re.compile("[ \t\n\r]")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    """Symbols behind a token boundary that settle it, for any text.

    Whether (a, b) merges at a place depends on b, and on b's right edge not
    having been taken by a merge of lower rank: of b itself or of the last
    part of b before b was formed. ``taken[t]`` is the reach of the merges
    seen so far with t on the left, ``edge[t]`` that of t's last parts.
    """
    taken: dict[str, int] = {}
    edge: dict[str, int] = {}
    length = lambda t: len(t.removesuffix(WORD_END))
    for a, b in merges:
        reach = max(edge.get(b, 0), taken.get(b, 0))
        edge[a + b] = max(edge.get(a + b, 0), reach)
        taken[a] = max(taken.get(a, 0), length(b) + reach)
    return max(taken.values(), default=0)


class Transducer:
    """Encodes a stream of symbols, emitting tokens once they are final."""

    def __init__(self, merges: list[tuple[str, str]], block: int = BLOCK):
        self.ranks = {pair: k for k, pair in enumerate(merges)}
        self.lookahead = sufficient_lookahead(merges)
        self.block = block

    def merged(self, symbols: list[str]) -> list[str]:
        """Tokens of a short symbol sequence: lowest rank first, left to right."""
        rank, none = self.ranks.get, len(self.ranks)
        parts = list(symbols)
        costs = [rank(pair, none) for pair in zip(parts, parts[1:])]
        while costs:
            best = min(costs)
            if best == none:
                break
            k = costs.index(best)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del costs[k]
            if k < len(costs):
                costs[k] = rank((parts[k], parts[k + 1]), none)
            if k:
                costs[k - 1] = rank((parts[k - 1], parts[k]), none)
        return parts

    def encode(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens of one word; at most ``block + lookahead + 1`` symbols and one token are held."""
        held: list[str] = []
        for symbol in symbols:
            held.append(symbol)
            if len(held) > self.block + self.lookahead:
                done, limit = 0, len(held) - self.lookahead
                for token in self.merged(held):
                    size = len(token.removesuffix(WORD_END))
                    if done + size > limit:
                        break
                    done += size
                    yield token
                held = held[done:]
        yield from self.merged(held)


class Lanes:
    """Merges of many short words at once, one word a lane."""

    NEVER = np.int32(1 << 30)

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], alphabet: list[str]):
        self.plain = np.array([vocab[c] for c in alphabet], np.int64)
        self.final = np.array([vocab[c + WORD_END] for c in alphabet], np.int64)
        pairs = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.rank_of = pairs[order], order.astype(np.int32)
        self.result = np.array([vocab[a + b] for a, b in merges], np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.rank_of[at], self.NEVER)

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word (not empty), lowest rank first, left to right."""
        out: list[list[int]] = [[]] * len(words)
        lengths = np.array([len(w) for w in words])
        for length in np.unique(lengths).tolist():
            row = np.flatnonzero(lengths == length)
            raw = np.frombuffer(b"".join([words[i] for i in row]), np.uint8).reshape(-1, length)
            tokens = np.concatenate((self.plain[raw[:, :-1]], self.final[raw[:, -1:]]), axis=1)
            ranks = self._ranks(tokens[:, :-1], tokens[:, 1:])
            while len(row):
                width = tokens.shape[1]
                k = ranks.argmin(axis=1) if width > 1 else np.zeros(len(row), np.int64)
                best = ranks[np.arange(len(row)), k] if width > 1 else np.full(len(row), self.NEVER)
                done = best == self.NEVER
                for i, ids in zip(row[done].tolist(), tokens[done].tolist(), strict=True):
                    out[i] = ids
                row, tokens, ranks, k, best = row[~done], tokens[~done], ranks[~done], k[~done], best[~done]
                if not len(row):
                    break
                lane, at = np.arange(len(row)), k[:, None]
                tokens[lane, k] = self.result[best]
                tokens = np.where(np.arange(width - 1) > at, tokens[:, 1:], tokens[:, :-1])
                ranks = np.where(np.arange(width - 2) >= at, ranks[:, 1:], ranks[:, :-1])
                for near in (k - 1, k):  # the two pairs that hold the new token
                    has = np.flatnonzero((near >= 0) & (near < width - 2))
                    ranks[has, near[has]] = self._ranks(tokens[has, near[has]], tokens[has, near[has] + 1])
        return out


class Decoder:
    """Bytes of tokens to text, one token at a time."""

    def __init__(self, table: dict[int, bytes]):
        self.table, self.machine = table, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, token: int) -> str:
        return self.machine.decode(self.table[token])

    def close(self) -> str:
        return self.machine.decode(b"", True)


@dataclass
class Memo:
    """Decimal ids and decoded tokens by piece."""

    ids: dict[str | int, bytes] = field(default_factory=dict)
    decoded: dict[str | int, bytes] = field(default_factory=dict)

    def forget(self, pieces: Iterable[str | int]) -> None:
        for p in pieces:
            self.ids.pop(p, None)
            self.decoded.pop(p, None)


class WordTokenizer:
    """A tokenizer file with BPE and word ends: text to ids and back.

    ``surface`` decodes as the file declares (no decoder: the tokens, joined
    by spaces); :meth:`plain` restores the text from the byte alphabet.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.transducer = Transducer([tuple(m) for m in spec["model"]["merges"]])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.alphabet = byte_alphabet()
        self.surface_of = {i: t.encode() for t, i in {**self.vocab, **self.special}.items()}
        back = {c: b for b, c in enumerate(self.alphabet)}
        self.bytes_of = {i: bytes(back[c] for c in t.removesuffix(WORD_END)) + b" " * t.endswith(WORD_END) for t, i in self.vocab.items()}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        size = max(self.surface_of) + 1
        self.decimal = [b"%d" % i for i in range(size)]
        self.shown_as = [self.surface_of.get(i, b"") for i in range(size)]
        self.lanes = Lanes(self.vocab, list(self.transducer.ranks), self.alphabet)
        self.widest = self.transducer.block + self.transducer.lookahead
        self.young, self.old = Memo(), Memo()

    def _symbols(self, word: str) -> Iterator[str]:
        """Byte symbols of a pre-token, the last one with the word end."""
        raw = word.encode()
        for b in raw[:-1]:
            yield self.alphabet[b]
        yield self.alphabet[raw[-1]] + WORD_END

    def _shown(self, ids: list[int]) -> tuple[bytes, bytes]:
        """Decimal ids, and the decoded tokens, each joined by spaces."""
        return b" ".join(map(self.decimal.__getitem__, ids)), b" ".join(map(self.shown_as.__getitem__, ids))

    def _stream(self, words: Iterable[str]) -> Iterator[list[int]]:
        """Ids of words of any length, at most ``LONG`` at a time."""
        held: list[int] = []
        for word in words:
            for token in self.transducer.encode(self._symbols(word)):
                held.append(self.vocab[token])
                if len(held) == LONG:
                    yield held
                    held = []
        yield held

    def _learn(self, pieces: list[str]) -> set[str | int]:
        """Add new pieces (runs without white space) and their words; a run of letters is one pre-token.

        Returns those that are too long to be kept.
        """
        mixed = {p: self.words.findall(p) for p in pieces if not p.isalpha()}
        ids, decoded = self.young.ids, self.young.decoded
        words = list({*filter(str.isalpha, pieces), *chain.from_iterable(mixed.values())} - ids.keys())
        raw = [w.encode() for w in words]
        wide = [k for k, r in enumerate(raw) if len(r) > self.widest]
        for k in wide:
            raw[k] = b"-"  # goes by the stream below
        tokens = self.lanes.encode(raw)
        for k in wide:
            tokens[k] = [i for part in self._stream([words[k]]) for i in part]
        decimal, shown_as = self.decimal.__getitem__, self.shown_as.__getitem__
        for word, t in zip(words, tokens, strict=True):
            if len(t) == 1:
                ids[word], decoded[word] = decimal(t[0]), shown_as(t[0])
            else:
                ids[word], decoded[word] = b" ".join(map(decimal, t)), b" ".join(map(shown_as, t))
        for p, ws in mixed.items():
            ids[p], decoded[p] = b" ".join([ids[w] for w in ws]), b" ".join([decoded[w] for w in ws])
        return {p for p in chain(words, mixed) if len(p) > LONGEST_MEMO}

    def _normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def _pieces(self, text: str) -> list[str]:
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [p for p in _BLANK.split(text) if p]
        return text.split()

    def _blocks(self, text: str) -> Iterator[list[str | int]]:
        """Pieces and special ids of blocks of a text, which end at white space."""
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > BLOCK_CHARS and (cut := _CUT.search(text, at + BLOCK_CHARS)):
                end = cut.end()
            block, at = text[at:end], end
            out: list[str | int] = []
            for k, part in enumerate(self.split_special.split(block) if "<|" in block else [block]):
                out += [self.special[part]] if k % 2 else self._pieces(self._normal(part))
            yield out

    def _remember(self, pieces: set[str | int]) -> set[str | int]:
        """Bring what the pieces become into the young memo; pieces over ``LONG`` stay out.

        Returns the pieces to forget after use.
        """
        if len(self.young.ids) > MEMO:
            self.old, self.young = self.young, Memo()
        new = pieces - self.young.ids.keys()
        for p in new & self.old.ids.keys():
            self.young.ids[p], self.young.decoded[p] = self.old.ids[p], self.old.decoded[p]
        new -= self.young.ids.keys()
        special = {p for p in new if isinstance(p, int)}
        for p in special:
            self.young.ids[p], self.young.decoded[p] = self._shown([p])
        new -= special
        return self._learn([p for p in new if len(p) <= LONG])

    def _parts(self, block: list[str | int]) -> Iterator[tuple[bytes, bytes]]:
        """Ids and decoded tokens of a block of remembered pieces; of pieces over ``LONG`` in parts."""
        known = self.young
        try:
            ids = list(map(known.ids.__getitem__, block))
        except KeyError:
            ids = []
        if ids and all(ids):
            yield b" ".join(ids), b" ".join(map(known.decoded.__getitem__, block))
            return
        for p in block:
            if p in known.ids:
                yield known.ids[p], known.decoded[p]
            else:
                yield from map(self._shown, self._stream(m.group() for m in self.words.finditer(p)))

    def digests(self, texts: Iterable[str]) -> Iterator[tuple[int, str, str]]:
        """(number of tokens, hash of the ids, hash of the decoded text) of each text."""
        waiting: list[list[str | int] | None] = []  # blocks; None ends a text
        held, open_ = 0, Digest()

        def flush() -> Iterator[tuple[int, str, str]]:
            nonlocal open_
            passing = self._remember(set().union(*filter(None, waiting)))
            for block in waiting:
                if block is None:
                    yield open_.result()
                    open_ = Digest()
                else:
                    for ids, decoded in self._parts(block):
                        open_.add(ids, decoded)
            waiting.clear()
            self.young.forget(passing)

        for text in texts:
            for block in self._blocks(text):
                waiting.append(block)
                held += len(block)
                if held > BLOCK_CHARS // 8:
                    yield from flush()
                    held = 0
            waiting.append(None)
            held += 1
        yield from flush()

    def digest(self, text: str) -> tuple[int, str, str]:
        return next(self.digests([text]))

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for block in self._blocks(text):
            passing = self._remember(set(block))
            for ids, _ in self._parts(block):
                out += map(int, ids.split())
            self.young.forget(passing)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by spaces, as a file without a decoder says."""
        feed = Decoder(self.surface_of).feed
        return " ".join([feed(i) for i in ids])

    def plain(self, ids: Iterable[int]) -> str:
        """The normalised text, words separated by single spaces."""
        decoder = Decoder(self.bytes_of)
        return ("".join(map(decoder.feed, ids)) + decoder.close()).rstrip(" ")


class Digest:
    """Hashes of ids and decoded tokens that come piece by piece."""

    def __init__(self):
        self.ids, self.decoded, self.n, self.gap = hashlib.sha256(), hashlib.sha256(), 0, b""

    def add(self, ids: bytes, decoded: bytes) -> None:
        if ids:
            self.ids.update(self.gap + ids)
            self.decoded.update(self.gap + decoded)
            self.n, self.gap = self.n + ids.count(b" ") + 1, b" "

    def result(self) -> tuple[int, str, str]:
        return self.n, self.ids.hexdigest(), self.decoded.hexdigest()


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each worker process, so that tasks share its memo."""
    return WordTokenizer(path)


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        for batch in batches:
            found = list(tokenizer.digests(t.as_py() or "" for t in batch.column("text")))
            n, ids, decoded = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def token_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lean(_digests(tokenizer_path)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
