"""Chat formatting by event-sourced reconstruction.

A log of events (conv_id, msg, seq, kind, role, text) is partitioned by conversation and
sorted by message and sequence. Folding it gives the final messages: 'message' opens one
with a text, 'delta' appends, 'edit' replaces the text, 'regenerate' discards it for what
follows, 'delete' drops the message. Each final message becomes one rendered segment

    <|im_start|>role NEWLINE text <|im_end|> NEWLINE

with the code points of assistant texts under the loss mask. Control strings in texts are
escaped reversibly: a backslash goes before the bar of '<|', or of '<', backslashes, '|'.

All steps stream over sorted partitions and hold one message at a time. Folding, rendering
and parsing are dealt by message; only the digests of a conversation are sequential. Deltas
before any message open one; what follows a delete opens it again with its role; unknown kinds raise.
Null text is empty, a null role is '', all rows with a null conversation id are one
conversation, as are all with a null msg within one one message number (the first); events
equal in (msg, seq) are ordered by kind, role and text, and repeated 'message' rows are
repeated turns. Ids of any size stay exact. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meetloom.llm.common import SLICE_BYTES, small_batches

START, END = "<|im_start|>", "<|im_end|>"
EVENTS = "conv_id long, msg long, seq long, kind string, role string, text string"
SEGMENTS = "conv_id long, msg long, nth long, segment string, loss_start long, loss_end long"
TURNS = "conv_id long, msg long, nth long, turn string, loss_at long, loss_chars long, chars long"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
BATCH = 1_000


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(role: str, text: str) -> tuple[str, int, int]:
    """The segment, and the loss mask's code points in it (empty unless the assistant speaks)."""
    head, body = f"{START}{escape_role(role)}\n", escape(text)
    at = len(head)
    return f"{head}{body}{END}\n", at, at + len(body) if role == "assistant" else at


def parse(segment: str) -> tuple[str, str]:
    """Role and text back from a segment."""
    if not segment.startswith(START) or not segment.endswith(f"{END}\n") or segment.count(START) != 1 or segment.count(END) != 1:
        raise ValueError("not one rendered turn")
    role, _, body = segment[len(START) : -len(END) - 1].partition("\n")
    return unescape_role(role), unescape(body)


def fold(events: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted (conv_id, msg, seq, kind, role, text) to final (conv_id, msg, role, text)."""
    key, role, parts = None, None, None
    for conv, msg, _, kind, who, text in events:
        if (conv, msg) != key or kind == "message":
            if parts is not None:
                yield *key, role, "".join(parts)
            key, role, parts = (conv, msg), None, None
        if kind not in ("message", "delta", "edit", "regenerate", "delete"):
            raise ValueError(f"unknown kind of event: {kind}")
        if kind == "delete":
            parts = None
            continue
        if who is not None:
            role = who
        if kind != "delta" or parts is None:
            parts = []
        parts.append(text or "")
    if parts is not None:
        yield *key, role, "".join(parts)


def messages_as_events(rows: DataFrame) -> DataFrame:
    """A table of whole turns (conv_id, turn, role, text) as a log of 'message' events."""
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("msg"), F.lit(0).cast("long").alias("seq"), F.lit("message").alias("kind"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows as tuples of Python values, exact ids included, a bounded run of rows at a time."""
    for b in batches:
        step = max(1, b.num_rows * SLICE_BYTES // max(1, b.nbytes))
        for at in range(0, b.num_rows, step):
            yield from zip(*(c.to_pylist() for c in b.slice(at, step).columns), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, text_at: int | None = None) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches of at most BATCH rows and about SLICE_BYTES of the named text column."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[text_at]) if text_at is not None else 0
        if len(held) >= BATCH or size >= SLICE_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


_LONG, _TEXT = pa.int64(), pa.string()
_SEGMENTS = pa.schema([("conv_id", _LONG), ("msg", _LONG), ("nth", _LONG), ("segment", _TEXT), ("loss_start", _LONG), ("loss_end", _LONG)])
_TURNS = pa.schema([("conv_id", _LONG), ("msg", _LONG), ("nth", _LONG), ("turn", _TEXT), ("loss_at", _LONG), ("loss_chars", _LONG), ("chars", _LONG)])
_DIGESTS = pa.schema([("conv_id", _LONG), ("n_turns", _LONG), ("turns_sha256", _TEXT), ("loss_chars", _LONG), ("loss_sha256", _TEXT), ("formatted_chars", _LONG)])


def format_conversations(events: DataFrame) -> DataFrame:
    """conv_id, msg, nth, segment, loss_start, loss_end: final messages rendered; a conversation's order is msg (null first), nth.
    The log is dealt by message, so the texts of a long conversation are folded and rendered by many tasks."""
    small_batches(events.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rendered() -> Iterator[tuple]:
            key, nth = None, 0
            for conv, msg, role, text in fold(_rows(batches)):
                nth = nth + 1 if (conv, msg) == key else 0
                key = (conv, msg)
                yield conv, msg, nth, *render(role or "", text)

        yield from _batches(rendered(), _SEGMENTS, 3)

    order = ["conv_id", "msg", "seq", "kind", "role", "text"]
    return events.select(*order).repartition("conv_id", "msg").sortWithinPartitions(*order).mapInArrow(run, SEGMENTS)


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of each conversation from nothing but its rendered segments and masks. Segments are parsed where they lie; only the
    digests, which are sequential, take a conversation's turns in order through one task, one turn at a time."""
    small_batches(segments.sparkSession)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns() -> Iterator[tuple]:
            for conv, msg, nth, segment, start, end in _rows(batches):
                role, text = parse(segment)
                masked = unescape(segment[start:end])
                turn = f"{role}\n{text}\n"
                at = len(role) + 1
                if masked and turn[at : at + len(masked)] != masked:
                    raise ValueError(f"the loss mask of conversation {conv} is not on its turn's text")
                yield conv, msg, nth, turn, at, len(masked), len(segment)

        yield from _batches(turns(), _TURNS, 3)

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[tuple]:
            for conv, turns in groupby(_rows(batches), key=itemgetter(0)):
                whole, loss, n, loss_n, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                for _, _, _, turn, at, masked, size in turns:
                    whole.update(turn.encode())
                    loss.update(turn[at : at + masked].encode())
                    n, loss_n, chars = n + 1, loss_n + masked, chars + size
                yield conv, n, whole.hexdigest(), loss_n, loss.hexdigest(), chars

        yield from _batches(digests(), _DIGESTS)

    turns = segments.select(*_SEGMENTS.names).mapInArrow(parsed, TURNS)
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "msg", "nth").mapInArrow(digested, DIGESTS)
