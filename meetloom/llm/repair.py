"""Conversation structure repair by error-correcting Earley parsing.

The grammar of roles is right-linear (TALK below): an optional system turn, then user and assistant in turn. Beside
its own productions, a role may be read from a row of another role (rerole) or from none (insert), and a row may be
passed over (delete). Each has a cost. A chart column holds the items (production, dot) reached after so many rows, each with
the least (cost, audit) that leads there; the audit is the string of the edits' initials, and of equal costs the least in ASCII wins.
When a conversation's rows are read, the best completed item of the last column is the repair.

Two audits that lead to one column both end in that row's edit, so neither begins the other, and their order is that of
their parents and then of what the row added. So items carry a rank instead of whole strings, and a conversation of any length
is parsed in one pass: edits on which all items agree are told and forgotten. Rows of a conversation are read in order by one task, which holds
only the rows that are still open; finding repeated rows, which needs all of them, is an aggregate and a join.

Null conversations are one conversation. Null roles and texts are a space, so such a row is blank. Rows of one turn are
read by role and text, a null turn first. Equal rows are a row and its duplicates. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetloom.llm.common import SLICE_BYTES, small_batches

#: Productions: a symbol to sequences of a role's initial and the symbol that follows. TALK is `(s?(ua)+)?` of the initials.
TALK: dict[str, list[tuple[str, ...]]] = {"talk": [("s", "ask"), ("u", "answer"), ()], "ask": [("u", "answer")], "answer": [("a", "more")], "more": [("u", "answer"), ()]}
START = "talk"
#: Roles that may be inserted or taken instead of a row's own.
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: From any state of TALK any other can be imitated by two insertions, and a system turn's start by a deletion. So what costs more than the
#: best item by more than this is never part of a cheapest repair, whatever follows.
SLACK = 2 * INSERT + DELETE
#: Edits are settled when so many rows are open.
OPEN_ROWS = 256
#: Faults, the first that holds counts.
SOUND, BLANK, DUPLICATE, CUT = "", "blank", "duplicate", "truncated"


class Item(NamedTuple):
    """The best way to one chart item: its cost, its place among the column's audits, and its edits since the last settled row."""

    cost: int
    rank: int
    edits: tuple | None  # (edits before, edit, role) as a chain


class Row(NamedTuple):
    turn: int | None
    role: str
    text: str
    fault: str


class Chart:
    """An Earley chart of one conversation, column by column."""

    def __init__(self, grammar: dict[str, list[tuple[str, ...]]] = TALK, start: str = START):
        self.grammar = grammar
        self.items: dict[tuple[str, int, int], Item] = {}
        self.open: list[Row] = []
        self._column({(start, -1, 0): (0, (0, ""), None)})

    def _column(self, reached: dict[tuple[str, int, int], tuple[int, tuple[int, str], tuple | None]]) -> None:
        """Predictions and insertions within a column until nothing gets better; then audits become ranks. A key (symbol, -1, 0) asks for a prediction."""
        best: dict[tuple[str, int, int], tuple[int, tuple[int, str], tuple | None]] = {}
        agenda = list(reached.items())
        while agenda:
            key, way = agenda.pop()
            if key in best and best[key][:2] <= way[:2]:
                continue
            best[key] = way
            symbol, rule, dot = key
            cost, (rank, token), edits = way
            if rule < 0:
                agenda += [((symbol, i, 0), way) for i in range(len(self.grammar[symbol]))]
            elif dot < len(body := self.grammar[symbol][rule]):
                if body[dot] in self.grammar:
                    agenda.append(((body[dot], -1, 0), way))
                elif body[dot] in ROLES:
                    agenda.append(((symbol, rule, dot + 1), (cost + INSERT, (rank, token + "I"), (edits, "I", ROLES[body[dot]]))))
        least = min(w[0] for w in best.values())
        best = {k: w for k, w in best.items() if w[0] <= least + SLACK}
        order = {audit: i for i, audit in enumerate(sorted({w[1] for w in best.values()}))}
        self.items = {k: Item(cost, order[audit], edits) for k, (cost, audit, edits) in best.items()}

    def read(self, row: Row) -> None:
        """The next column: every waiting item keeps, reroles or passes over the row."""
        reached: dict[tuple[str, int, int], tuple[int, tuple[int, str], tuple | None]] = {}

        def reach(key: tuple[str, int, int], cost: int, item: Item, edit: str, role: str | None) -> None:
            way = (cost, (item.rank, edit), (item.edits, edit, role))
            if key not in reached or way[:2] < reached[key][:2]:
                reached[key] = way

        bound = row.fault in (BLANK, DUPLICATE)
        extra = TRUNCATED if row.fault == CUT else 0
        for (symbol, rule, dot), item in self.items.items():
            if rule < 0:
                continue
            body = self.grammar[symbol][rule]
            want = body[dot] if dot < len(body) else None
            if want in self.grammar:  # what it predicts waits itself
                continue
            reach((symbol, rule, dot), item.cost + DELETE, item, "D", None)
            if want is None or bound:
                continue
            if row.role[:1] == want:
                reach((symbol, rule, dot + 1), item.cost + extra, item, "K", row.role)
            if want in ROLES:
                reach((symbol, rule, dot + 1), item.cost + REROLE + extra, item, "R", ROLES[want])
        self.open.append(row)
        self._column(reached)

    def _chain(self, edits: tuple | None) -> list[tuple[str, str | None]]:
        out = []
        while edits is not None:
            edits, edit, role = edits
            out.append((edit, role))
        return out[::-1]

    def settled(self, done: bool = False) -> list[tuple[str, str | None, Row | None]]:
        """(edit, role, row) of the edits that all items share, or, when done, of the best completed item. They are forgotten."""
        if done:
            complete = [i for (symbol, rule, dot), i in self.items.items() if rule >= 0 and dot == len(self.grammar[symbol][rule])]
            chains = [self._chain(min(complete).edits)]
        else:
            chains = [self._chain(i.edits) for i in self.items.values()]
        n = 0
        for step in zip(*chains, strict=False):
            if any(s != step[0] for s in step):
                break
            n += 1
        out, used = [], 0
        for edit, role in chains[0][:n]:
            row = None if edit == "I" else self.open[used]
            used += edit != "I"
            out.append((edit, role, row))
        self.open = self.open[used:]
        if not done:
            kept: dict[int, tuple | None] = {}
            for key, item in self.items.items():
                if id(item.edits) not in kept:
                    rest = None
                    for edit, role in self._chain(item.edits)[n:]:
                        rest = (rest, edit, role)
                    kept[id(item.edits)] = rest
            self.items = {key: item._replace(edits=kept[id(item.edits)]) for key, item in self.items.items()}
        return out


def repair(rows: Iterator[Row]) -> Iterator[tuple[str, str | None, Row | None]]:
    """(edit, role after it, row or None for an insertion) of the cheapest repair, in order."""
    chart = Chart()
    for row in rows:
        chart.read(row)
        if len(chart.open) >= OPEN_ROWS and not len(chart.open) % OPEN_ROWS:
            yield from chart.settled()
    yield from chart.settled(done=True)


NOT_SPACE = r"[^\x20\x09-\x0D]"


def _spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" ")).alias(column)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows (conv_id, turn, role, text) with `copies`: by crc32 of `conv_id:turn` mod 20, 0 drops a row (copies 0), 1 empties its
    text, 2 takes its [.!?] away, 3 repeats it, 4 makes it the user's. Nulls are one space."""
    code = F.crc32(F.concat_ws(":", _spaced("conv_id"), _spaced("turn")).cast("binary")) % 20
    text = F.when(code == 1, "").when(code == 2, F.regexp_replace(_spaced("text"), "[.!?]", "")).otherwise(_spaced("text"))
    copies = F.when(code == 0, 0).when(code == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", F.when(code == 4, "user").otherwise(_spaced("role")).alias("role"), text.alias("text"), copies.alias("copies"))


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies, fault of rows that may be repeated (copies; 0: only the conversation is named). Equal rows of
    a turn are one with more copies, and the first of equal rows in a conversation is found by an aggregate that combines before it shuffles."""
    rows = rows.select("conv_id", "turn", _spaced("role"), _spaced("text"), "copies").groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = rows.withColumn("print", F.md5(F.concat_ws(":", F.octet_length("role"), "role", "text").cast("binary")))
    seen = rows.where("copies > 0").groupBy("conv_id", "print").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1")
    seen = seen.select(F.col("conv_id").alias("seen_in"), F.col("print").alias("seen_print"), "first")
    blank, cut = ~F.col("text").rlike(NOT_SPACE), ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    again = F.col("first").isNotNull() & (F.struct("turn") > F.col("first"))
    fault: Column = F.when(blank, BLANK).when(again, DUPLICATE).when(cut, CUT).otherwise(SOUND)
    joined = rows.join(seen, F.col("conv_id").eqNullSafe(F.col("seen_in")) & (F.col("print") == F.col("seen_print")), "left")
    return joined.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


_REPORT = pa.schema([("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
_EDITS = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("fault", pa.string())])


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[Row]]]:
    """(conv_id, its rows, copies after the first as duplicates)."""

    def each() -> Iterator[tuple]:
        for b in batches:
            step = max(1, b.num_rows * SLICE_BYTES // max(1, b.nbytes))
            for at in range(0, b.num_rows, step):
                yield from zip(*(c.to_pylist() for c in b.slice(at, step).columns), strict=True)

    def rows(group: Iterator[tuple]) -> Iterator[Row]:
        for _, turn, role, text, copies, fault in group:
            for i in range(copies):
                yield Row(turn, role, text, fault if not i or fault == BLANK else DUPLICATE)

    for conv, group in groupby(each(), key=itemgetter(0)):
        yield conv, rows(group)


def _batches(rows: Iterator[tuple], schema: pa.Schema, text_at: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], f.type) for i, f in enumerate(schema)], schema=schema)

    for r in rows:
        held.append(r)
        size += len(r[text_at] or "") + 128
        if size >= SLICE_BYTES:
            yield told()
            held, size = [], 0
    yield told()


def in_order(rows: DataFrame) -> DataFrame:
    """A conversation's rows in one task, by turn (null first), role and text."""
    small_batches(rows.sparkSession)
    return rows.select("conv_id", "turn", "role", "text", "copies", "fault").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """conv_id, at, edit, turn, role, text, fault: every edit of the cheapest repairs of rows with faults, in order; the rows with edits K, R and I
    are the repaired conversation (role and text as they are after the edit), D are those passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edits() -> Iterator[tuple]:
            for conv, group in _conversations(batches):
                for at, (edit, role, row) in enumerate(repair(group)):
                    yield conv, at, edit, row.turn if row else None, role or row.role, row.text if row else "", row.fault if row else SOUND

        yield from _batches(edits(), _EDITS, 5)

    return in_order(rows).mapInArrow(run, "conv_id long, at long, edit string, turn long, role string, text string, fault string")


class Tally:
    """Counts of a conversation's rows as they pass by, and the digest of its repair."""

    def __init__(self):
        self.counts, self.illegal, self.cost, self.before = dict.fromkeys((BLANK, DUPLICATE, CUT, SOUND), 0), 0, 0, None
        self.first = self.last = None
        self.turns, self.audit, self.digest, self.lines = 0, [], hashlib.sha256(), 0

    def watched(self, rows: Iterator[Row]) -> Iterator[Row]:
        for row in rows:
            self.counts[row.fault] += 1
            initial = row.role[:1]
            if self.before is not None and self.before + initial not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = initial
            if row.turn is not None and row.turn != self.last:
                self.first, self.last, self.turns = row.turn if self.first is None else self.first, row.turn, self.turns + 1
            yield row

    def edited(self, edits: Iterator[tuple[str, str | None, Row | None]]) -> None:
        for edit, role, row in edits:
            self.audit.append(edit)
            self.cost += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit] + (TRUNCATED if edit in "KR" and row.fault == CUT else 0)
            if edit != "D":
                self.digest.update((("\n" if self.lines else "") + f"{role}:{row.text if row else ''}").encode())
                self.lines += 1

    def told(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return gaps, *(self.counts[f] for f in (BLANK, DUPLICATE, CUT)), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()


def repair_report(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation of rows with faults, in the
    same pass as its parse: `role:text` of the repaired rows, joined by newlines, is digested edit by edit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def reports() -> Iterator[tuple]:
            for conv, group in _conversations(batches):
                tally = Tally()
                tally.edited(repair(tally.watched(group)))
                yield conv, *tally.told()

        yield from _batches(reports(), _REPORT, 7)

    schema = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return in_order(rows).mapInArrow(run, schema)
