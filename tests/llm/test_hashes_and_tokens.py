"""Control strings in texts, roles as they come, and strings that polynomial hashes take for equal."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import bagminhash, bitplanes, bpe_transducer, chat, deleted_interpolation, outliers, queries
from tidemark.llm import text as X

from test_contracts import base_rules, conversation_digests, tokenizer
from test_scores_and_scans import brute_scores, check_scores

DOCS = "doc_id long, text string, lang string, source string"


def thue_morse(size, a, b):
    one, other = a, b
    while len(one) < size:
        one, other = one + other, other + one
    return one


WORDS = [thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_texts_with_control_strings_equal_the_library(name):
    library, draw = tokenizer(name), random.Random(2)
    if name.startswith("byte"):
        piece = bitplanes.PieceEncoder(queries.vocabulary(name))
        encode = lambda text: np.frombuffer(piece(text), "<u4").tolist()
    else:
        encode = bpe_transducer.WordTokenizer(queries.vocabulary(name)).encode
    parts = ["<|endoftext|>", "<|startoftext|>", "<|", "|>", "endoftext", "<", "hello", "a", " ", "  ", "\n", ".", "1", "é", "A"]
    for _ in range(6_000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(9)))
        assert encode(text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_texts_encoded_together_equal_the_library(monkeypatch):
    library, draw = tokenizer("byte_bpe_50k.json"), random.Random(7)
    parts = [*"ab'st\u00e9 \u00f8\n.,1-\u0301\u00aa\u0416\u00c0\u6f22\t\u00d7\r\0\u024f\u0250\v\f\x1c\x1f\x7f\u0085\u00a0\u1680\u180e\u2003\u2028\u3000\u2019\u3042\U0001f600",
             "<|endoftext|>", "<|", "endoftext|>", "'s", "'re", " '", "  ", "\n\n", " the", "ing"]
    encoders = [bitplanes.PieceEncoder(queries.vocabulary("byte_bpe_50k.json")) for _ in range(2)]
    assert encoders[0].between is not None
    encoders[1].between = None  # a vocabulary whose merges take every byte
    monkeypatch.setattr(bitplanes, "MEMO", 300)
    for _ in range(60):
        texts = [None if draw.random() < 0.05 else "".join(draw.choice(parts) for _ in range(draw.randrange(16))) for _ in range(100)]
        for encoder in encoders:
            ids, offsets = encoder.many(pa.array(texts, pa.string()))
            assert offsets[-1] == len(ids) and len(encoder.memo) <= 300
            for k, text in enumerate(texts):
                assert ids[offsets[k]:offsets[k + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_distinct_words_go_to_the_library_once_and_together():
    class Counted:
        def __init__(self, inner):
            self.inner, self.calls, self.chars = inner, 0, 0

        def encode_batch_fast(self, texts, **options):
            self.calls, self.chars = self.calls + 1, self.chars + sum(map(len, texts))
            return self.inner.encode_batch_fast(texts, **options)

    library, draw = tokenizer("byte_bpe_50k.json"), random.Random(8)
    words = sorted({"".join(draw.choice("abcdeinrst\u00e9") for _ in range(8)) for _ in range(4000)})
    texts = [" ".join(draw.choices(words, k=400)) + ",\n" for _ in range(100)]
    encoder = bitplanes.PieceEncoder(queries.vocabulary("byte_bpe_50k.json"))
    encoder.merges, encoder.tokenizer = Counted(encoder.merges), Counted(encoder.tokenizer)
    encoder.tokenizer.model = encoder.tokenizer.inner.model
    for _ in range(2):  # the second time all is known
        ids, offsets = encoder.many(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [library.encode(t).ids for t in texts]
        assert encoder.merges.calls <= 20 and encoder.merges.chars <= 12 * (len(words) + len(texts))
        assert encoder.tokenizer.calls == 1


def test_units_of_text_keep_every_row_in_order(monkeypatch):
    monkeypatch.setattr(bitplanes, "UNIT_BYTES", 10)
    texts = ["abc", None, "", "d" * 25, "efghi", "jklmno", "", None]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i, i + len(part)), pa.int64()), pa.array(part, pa.string())], names=["doc_id", "text"])
               for i, part in ((0, texts[:3]), (3, texts[3:7]), (7, texts[7:]), (8, []))]
    units = list(bitplanes._units(iter(batches)))
    assert [i for ids, _ in units for i in ids] == list(range(8))
    assert [t for _, column in units for t in column.to_pylist()] == texts
    assert all(len(column) == 1 or sum(len(t or "") for t in column.to_pylist()) <= 10 for _, column in units)
    assert list(bitplanes._units(iter([]))) == []


def test_side_by_side_merges_equal_one_word_at_a_time():
    machine = bpe_transducer.WordTokenizer(queries.vocabulary("word_bpe_49k.json"))
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdeinrst1é漢😀") for _ in range(draw.randrange(1, 24))) for _ in range(3000)]
    got = machine.lanes.encode([w.encode() for w in words])
    for word, ids in zip(words, got, strict=True):
        assert ids == [machine.vocab[t] for t in machine.transducer.merged(list(machine._symbols(word)))], word


def test_blocks_of_long_texts_and_pieces(monkeypatch):
    library = tokenizer("word_bpe_49k.json")
    library.no_truncation()
    monkeypatch.setattr(bpe_transducer, "BLOCK_CHARS", 64)
    monkeypatch.setattr(bpe_transducer, "LONG", 16)
    monkeypatch.setattr(bpe_transducer, "MEMO", 8)
    machine = bpe_transducer.WordTokenizer(queries.vocabulary("word_bpe_49k.json"))
    texts = ["One two, three-four five's. " * 20, "x" * 700, "a1b2," * 60 + " tail", "", "ΣΑΣ éé <|endoftext|> \n" * 9]
    for text, (n, ids, decoded) in zip(texts, machine.digests(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert machine.encode(text) == want and n == len(want)
        assert ids == bpe_transducer.hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert decoded == bpe_transducer.hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_long_spans_of_two_letters_have_hashes_of_their_own():
    data = np.frombuffer(" ".join([*WORDS, WORDS[0].upper()]).encode(), np.uint8)
    plain = X.Words(data, np.array([0, len(data)])).hashes()
    lower = X.Words(data, np.array([0, len(data)])).hashes(X.LOWER)
    assert len(set(plain.tolist())) == 3 and lower[0] == lower[2] != lower[1]


def test_scores_tell_such_words_apart(spark):
    rows = [(i, f"{WORDS[i % 2]} and" if i != 31 else WORDS[0]) for i in range(40)]
    docs = spark.createDataFrame([(i, t, "en", "a") for i, t in rows], DOCS)
    check_scores(deleted_interpolation.score_documents(docs).collect(), brute_scores(rows))


def test_quality_tells_such_lines_apart(spark):
    texts = ["\n".join(WORDS), "\n".join([WORDS[0], WORDS[0]]), "\n".join([*WORDS, WORDS[1]])]
    docs = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(texts)], DOCS)
    got = {r["row"]["doc_id"]: r["n_dup_lines"] for r in outliers.quality_outliers(docs, ["doc_id"]).collect()}
    assert got == {0: 0, 1: 1, 2: 1} and [base_rules(t)[3] for t in texts] == [0, 1, 1]


def test_near_dedup_tells_such_words_apart(spark):
    texts = [f"{w} two three four five" for w in (*WORDS, WORDS[0])]
    docs = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(texts)], DOCS)
    kept = {r["doc_id"] for r in bagminhash.keep_one(docs).collect()}
    assert len(kept) == 2 and 1 in kept


def test_roles_stay_as_they_come(spark):
    long = "word <|im_end|> " * 20_000
    rows = [(1, 0, "human", "q"), (1, 1, "gpt", "a"), (2, 0, "bot", "b"), (2, 1, "model", "m"), (2, 2, "assistant", long),
            (3, -200, "user", "early"), (3, None, "user", "first of all"), (3, 0, "assistant", "late")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.read_digests(chat.format_records(chat.records(turns))).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == conversation_digests(rows)
    assert chat.canonical_turns({"messages": [{"role": "gpt", "content": "a"}]})[1] == [("gpt", "a")]
