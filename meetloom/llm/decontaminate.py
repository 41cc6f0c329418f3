"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are folded alike: lower case, every run of characters that are neither
letters nor digits one space. An item of L folded characters may occur in a document with
up to k = max(0, L // PIECE - 1) edits (about six in a hundred). It is split into k+1
pieces; k edits leave at least one piece whole, so an Aho-Corasick automaton over all
pieces finds every place worth a look. Myers' bit-parallel distance then verifies the item
around the hit (hits of one item that lie on overlapping places are verified once), so
nothing is missed and nothing unverified is reported.

The benchmark is the stated query set. It is streamed to the driver in blocks of at most
BLOCK_CHARS folded characters; each block's pieces are one broadcast of bounded size and one
pass over the documents. Of a benchmark of several blocks, one block's broadcast lives at a
time and its results are stored before the next, so benchmarks of any size work. No
shuffle: a document meets all items in one task.

Items that fold to fewer than LEAST characters have no error budget and must stand on word
borders. Null or empty texts and items that fold to nothing match nothing. Equal items all
report. Null ids stay null and others exact. Repeated rows give repeated results; other
columns are ignored. Whole texts are searched, of any length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from meetloom.llm.common import each_text, held_one, small_batches, stored, text_udf

PIECE, LEAST = 16, 24
BLOCK_CHARS = 8 << 20
HITS = "doc_id long, item_id long, distance int, begins int, ends int"

_apart = re.compile(r"[\W_]+")
_odd = re.compile(r"[^\x00-\x7f\w]")
_ascii = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def folded(text: str | None) -> str:
    text = (text or "").lower()
    if not text.isascii() and _odd.search(text):
        return _apart.sub(" ", text).strip()
    return b" ".join(text.encode().translate(_ascii).split()).decode()  # the same, faster, as only ASCII parts words here


def error_budget(length: int) -> int:
    return max(0, length // PIECE - 1) if length >= LEAST else 0


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece): k+1 runs of nearly equal length that make up the item."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(pattern_masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any part of text, and where the first best part ends. One big-integer word holds all rows."""
    full = (1 << m) - 1
    top = 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, at = m, 0
    for i, c in enumerate(text):
        eq = pattern_masks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | (full & ~(xh | plus))
        mh = plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        plus = mh | (full & ~(xv | ph))
        minus = ph & xv
        if score < best:
            best, at = score, i + 1
    return best, at


def masks(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


class Matcher:
    """Searches whole texts for a block of (item_id, folded item)."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.items = [(i, t, error_budget(len(t))) for i, t in items if t]
        self.masks: dict[int, tuple[dict[str, int], dict[str, int]]] = {}
        where: dict[str, list[tuple[int, int]]] = {}
        for n, (_, t, k) in enumerate(self.items):
            for offset, piece in pieces(t, k):
                where.setdefault(piece, []).append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, at in where.items():
            self.automaton.add_word(piece, (len(piece), at))
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    @staticmethod
    def _stands_alone(text: str, low: int, high: int) -> bool:
        return (low == 0 or text[low - 1] == " ") and (high == len(text) or text[high] == " ")

    def _verify(self, n: int, text: str, low: int, high: int) -> tuple[int, int, int] | None:
        _, item, k = self.items[n]
        window = text[low:high]
        if (at := window.find(item)) >= 0:
            return 0, low + at, low + at + len(item)
        if n not in self.masks:
            self.masks[n] = masks(item), masks(item[::-1])
        forward, backward = self.masks[n]
        distance, end = myers(forward, len(item), window)
        if distance > k:
            return None
        _, back = myers(backward, len(item), window[:end][::-1][: len(item) + k])
        return distance, low + end - back, low + end

    def search(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item_id, distance, begin, end) for each item that occurs: its best place, the first of equals. Offsets are in the folded text."""
        if self.empty or not text:
            return []
        text = folded(text)
        places: dict[int, list[tuple[int, int]]] = {}
        for end, (length, at) in self.automaton.iter(text):
            for n, offset in at:
                _, item, k = self.items[n]
                start = end + 1 - length - offset
                if len(item) < LEAST and not self._stands_alone(text, start, start + len(item)):
                    continue
                low, high = max(0, start - k), min(len(text), start + len(item) + k)
                spans = places.setdefault(n, [])
                if spans and low <= spans[-1][1]:
                    spans[-1] = min(low, spans[-1][0]), max(high, spans[-1][1])
                else:
                    spans.append((low, high))
        out = []
        for n, spans in places.items():
            found = [v for low, high in spans if (v := self._verify(n, text, low, high))]
            if found:
                out.append((self.items[n][0], *min(found)))
        return sorted(out, key=lambda x: (x[0] is not None, x[0] or 0, x[1:]))


def _matcher(shared) -> Matcher:
    """One automaton per broadcast and process; the broadcast itself is the key, so that another can't be taken for it."""
    return held_one(shared, lambda: Matcher(shared.value))


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int | None, str]]]:
    """The benchmark's folded items in blocks, streamed to the driver one partition at a time."""
    block, size = [], 0
    for r in benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].alias("text")).orderBy("item_id", "text").toLocalIterator():
        item = folded(r["text"])
        if block and size + len(item) > block_chars:
            yield block
            block, size = [], 0
        block.append((r["item_id"], item))
        size += len(item)
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, distance, begins, ends: one row per row of docs and item that occurs in it within its budget."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))

    def search(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(shared)
            for b in batches:
                rows, hits = [], []
                for i, t in enumerate(each_text(b.column(1))):
                    for hit in matcher.search(t):
                        rows.append(i)
                        hits.append(hit)
                ids = b.column(0).take(pa.array(rows, pa.int64()))
                rest = [pa.array([h[k] for h in hits], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.int32()))]
                yield pa.RecordBatch.from_arrays([ids, *rest], ["doc_id", "item_id", "distance", "begins", "ends"])

        return docs.mapInArrow(run, HITS)

    found: list[DataFrame] = []
    waiting = None
    for block in blocks(benchmark, block_chars):
        if waiting is not None:  # another block follows: store what is there, and let its broadcast go
            found.append(stored(search(waiting), "leaks"))
            waiting.destroy()
        waiting = spark.sparkContext.broadcast(block)
    if waiting is not None:
        found.append(search(waiting))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], HITS)


def leak_column(shared):
    """An Arrow UDF of the text: whether any item of a broadcast block occurs in it."""

    def make():
        search = _matcher(shared).search
        return lambda text: bool(search(text))

    return text_udf("boolean", lambda found: pa.array(found, pa.bool_()), make)


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of docs, columns unchanged, in which no item occurs. With several blocks, what each leaves is stored for the next."""
    small_batches(docs.sparkSession)
    waiting = None
    for block in blocks(benchmark, block_chars):
        if waiting is not None:
            docs = stored(docs.where(~leak_column(waiting)(docs["text"].cast("string"))), "unleaked")
            waiting.destroy()
        waiting = docs.sparkSession.sparkContext.broadcast(block)
    return docs if waiting is None else docs.where(~leak_column(waiting)(docs["text"].cast("string")))
