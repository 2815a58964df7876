"""Chat formatting by schema fingerprints.

The sorted nested field paths of a record are hashed; the hash selects a
declarative layout, which turns prompt, instruction and message records into
canonical (role, text) turns. Turns are written as

    <|im_start|>role\\ntext<|im_end|>\\n

and a control string inside a role or text is escaped reversibly: ``<|`` with
any backslashes between gets one more. The loss mask lists the spans of the
assistant texts, in code points.

A long conversation is cut into segments of ``SEGMENT`` turn numbers, written
one row each and read back in order, so no conversation is held whole.

Defined cases: null text or role is empty; turns with equal numbers are
ordered by role and text; a null turn number comes first; a null ``conv_id`` is
a conversation of its own; a record of an unknown layout keeps its row, with a
null layout and no turns; an empty table gives an empty result; other columns,
whatever their names, are not read. A conversation's digest is one running hash,
so its segments pass through one task, one at a time.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, STOP = "<|im_start|>", "<|im_end|>"
SEGMENT = 64
TRAINED = "assistant"
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

_guard, _unguard = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")


def escape(text: str) -> str:
    return _guard.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _unguard.sub(r"<\1|", text)


def _role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def _unrole(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def field_paths(value: object, at: str = "") -> set[str]:
    """Nested field paths of a record; list elements add ``[]``."""
    if isinstance(value, dict):
        return set().union(*(field_paths(v, f"{at}.{k}" if at else k) for k, v in value.items())) or {at}
    if isinstance(value, list):
        return set().union(*(field_paths(v, f"{at}[]") for v in value)) or {f"{at}[]"}
    return {at}


def fingerprint(paths: set[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode(), digest_size=8).hexdigest()


@dataclass(frozen=True)
class Layout:
    """How one record layout becomes turns.

    ``before`` and ``after`` give (role, fields) turns whose non-empty fields
    are joined by an empty line; ``each`` names (list, role field, text field);
    ``renames`` says that the roles are those of ``ROLES``.
    """

    name: str
    paths: tuple[str, ...]
    before: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: tuple[str, str, str] | None = None
    after: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: tuple[str, ...] = field(default=())
    renames: bool = False

    def turns(self, record: dict) -> Iterator[tuple[str, str]]:
        for role, fields in self.before:
            if not set(fields) <= set(self.optional) or any(f in record for f in fields):
                yield role, "\n\n".join(t for f in fields if (t := _text(record.get(f))))
        if self.each:
            items, role, content = self.each
            for item in record.get(items) or []:
                said = _text(item.get(role))
                yield (ROLES.get(said, said) if self.renames else said), _text(item.get(content))
        for role, fields in self.after:
            yield role, "\n\n".join(t for f in fields if (t := _text(record.get(f))))


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _pair(prompt: str, answer: str) -> Layout:
    return Layout(f"{prompt}_{answer}", (prompt, answer), before=(("system", ("system",)), ("user", (prompt,))),
                  after=(("assistant", (answer,)),), optional=("system",))


LAYOUTS = (
    Layout("messages", ("messages[].role", "messages[].content"), before=(("system", ("system",)),),
           each=("messages", "role", "content"), optional=("system",)),
    Layout("conversations", ("conversations[].from", "conversations[].value"), before=(("system", ("system",)),),
           each=("conversations", "from", "value"), optional=("system",), renames=True),
    _pair("prompt", "completion"),
    _pair("prompt", "response"),
    _pair("question", "answer"),
    Layout("instruction", ("instruction", "input", "output"), before=(("system", ("system",)), ("user", ("instruction", "input"))),
           after=(("assistant", ("output",)),), optional=("system",)),
    Layout("instruction_output", ("instruction", "output"), before=(("system", ("system",)), ("user", ("instruction",))),
           after=(("assistant", ("output",)),), optional=("system",)),
)


def _variants(layout: Layout) -> Iterator[set[str]]:
    yield set(layout.paths)
    for name in layout.optional:
        yield {*layout.paths, name}


BY_FINGERPRINT = {fingerprint(v): layout for layout in LAYOUTS for v in _variants(layout)}


def canonical_turns(record: object) -> tuple[str | None, list[tuple[str, str]]]:
    """(layout name, turns) of a record; (None, []) if no layout fits."""
    layout = BY_FINGERPRINT.get(fingerprint(field_paths(record)))
    return (layout.name, list(layout.turns(record))) if layout else (None, [])


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[int]]:
    """Formatted text and the loss mask as start, end, start, end ..."""
    out, mask, at = [], [], 0
    for role, text in turns:
        opening, body = f"{START}{_role(role)}\n", escape(text)
        if role == TRAINED:
            mask += [at + len(opening), at + len(opening) + len(body)]
        out.append(f"{opening}{body}{STOP}\n")
        at += len(out[-1])
    return "".join(out), mask


def parse_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """The turns of a formatted text."""
    at = 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        stop = formatted.index(STOP, line + 1)
        yield _unrole(formatted[at + len(START):line]), unescape(formatted[line + 1:stop])
        at = stop + len(STOP) + 1


def records(turns: DataFrame) -> DataFrame:
    """``conv_id, segment, record`` (JSON) of rows by turn.

    A two-turn exchange becomes a prompt record, all others message records,
    as sources deliver them.
    """
    said = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("content"))
    grouped = (turns.groupBy("conv_id", F.coalesce(F.floor(F.col("turn") / SEGMENT), F.lit(-(1 << 62))).cast("long").alias("segment"))
               .agg(F.sort_array(F.collect_list(said)).alias("said")))
    roles, text = F.col("said.role"), F.col("said.content")
    messages = F.to_json(F.struct(F.transform("said", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("messages")))
    prompt = F.to_json(F.struct(text[0].alias("prompt"), F.get(text, F.lit(1)).alias("completion")))
    system = F.to_json(F.struct(text[0].alias("system"), F.get(text, F.lit(1)).alias("prompt"), F.get(text, F.lit(2)).alias("completion")))
    return grouped.select("conv_id", "segment",
                          F.when(roles == F.array(F.lit("user"), F.lit("assistant")), prompt)
                          .when(roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant")), system)
                          .otherwise(messages).alias("record"))


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        layouts, texts, masks = [], [], []
        for record in batch.column("record").to_pylist():
            name, turns = canonical_turns(json.loads(record) if record else None)
            text, mask = format_turns(turns)
            layouts.append(name)
            texts.append(text)
            masks.append(mask)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("segment"), pa.array(layouts, pa.string()), pa.array(texts, pa.string()),
             pa.array(masks, pa.list_(pa.int64()))], names=["conv_id", "segment", "layout", "formatted", "loss_mask"])


def format_records(rows: DataFrame) -> DataFrame:
    """``conv_id, segment, layout, formatted, loss_mask`` of JSON records."""
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), "segment", "record").mapInArrow(
        _format, "conv_id long, segment long, layout string, formatted string, loss_mask array<long>")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by conversation and segment; one conversation is open at a time."""
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    now, state = object(), None

    def close() -> tuple:
        return now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

    for batch in batches:
        done = []
        for conv, text, mask in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_mask")), strict=True):
            if state is None or conv != now:
                if state is not None:
                    done.append(close())
                now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, said in parse_turns(text):
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
            for a, b in zip(mask[::2], mask[1::2], strict=True):
                said = unescape(text[a:b])
                state[2] += len(said)
                state[3].update(said.encode())
            state[4] += len(text)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=list(names))
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(close(), types, strict=True)], names=list(names))


def read_digests(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, parsed back from the formatted text."""
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return ordered.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
