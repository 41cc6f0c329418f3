"""Spelling variants: words one edit apart, found by Aho-Corasick automata of their halves.

One edit leaves one half of a word whole. So a word that is near another holds, at its
start, the other's first half or, at its end, the other's second half. Automaton shards hold
both halves of every word, and all words are scanned: a hit counts if its segment lies at the
offset that its half must have and the lengths differ by at most one; then the distance is verified.

Words meet only where they can: first halves have two code points at least and second halves too, so
a word goes to the shards of its first two and of its last two code points. A shard holds at
most SHARD_WORDS patterns (more are dealt by hash to several, and scanned words go to each) and streams the words it
scans, so its memory doesn't grow with them. Each pair is told once a direction: at its second half only if the first halves differ.

Words are counted in the tasks that read the texts, so only distinct words of a batch are shuffled.
Null text has no words; a null id counts as an empty one; repeated rows count as often as they occur;
other columns are ignored. Empty tables give none. Whole texts are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meetloom.llm.common import each_text, saved, small_batches

#: Words are runs of these; only A-Z are lower-cased, so the upper-case letters beyond stay.
RUN = re.compile("[a-zÀ-ÿ]+")
#: One occurrence in so many is damaged by a missing letter; the least length and count of a word; how much more frequent a form is.
DAMAGED, LEAST_LENGTH, LEAST_COUNT, TIMES = 97, 5, 3, 2
#: Code points at either end that two near words have in common; patterns of an automaton; distinct words held while counting; parts that are verified one by one.
END, SHARD_WORDS, HELD_WORDS, FEW = 2, 50_000, 400_000, 6

_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])
_PAIRS = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def damages(doc_id, runs: list[str], damaged: int = DAMAGED) -> Iterator[tuple[str, str]]:
    """(run, what is left of it) for each distinct run of a document that loses a letter."""
    key = crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
    distinct = list(set(runs))
    hashes = np.fromiter(map(crc32, map(str.encode, distinct), repeat(key)), np.uint32, len(distinct))
    for i in np.flatnonzero(hashes % damaged == 0).tolist():
        run = distinct[i]
        at = int(hashes[i]) % len(run)
        yield run, run[:at] + run[at + 1 :]


def runs_of(text: str | None) -> list[str]:
    return RUN.findall((text or "").encode("utf-8", "replace").lower().decode())


def count_words(docs: DataFrame, damaged: int = DAMAGED, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: the distinct words of all texts."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def told() -> pa.RecordBatch:
            kept = [(w, n) for w, n in held.items() if n and len(w) >= least_length]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], schema=_COUNTS)

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), each_text(b.column(1)), strict=True):
                runs = runs_of(text)
                held.update(runs)
                if lost := list(damages(doc_id, runs, damaged)):
                    times = Counter(runs) if len(lost) > 8 else {run: runs.count(run) for run, _ in lost}
                    for run, left in lost:
                        held[run] -= times[run]
                        held[left] += times[run]
                if len(held) > HELD_WORDS:
                    yield told()
                    held.clear()
        yield told()

    counted = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


def one_apart(a: str, b: str) -> bool:
    """True for two different words that one inserted, deleted or replaced code point makes equal."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


class Parts:
    """Parts of one length with their words. One edit leaves a part's first or second half whole as well, so many parts are held by
    their halves, each half with the parts that remain, and so on; few are verified one by one."""

    __slots__ = ("items", "heads", "tails", "cut", "rest")

    def __init__(self):
        self.items, self.heads = [], None

    def near(self, part: str) -> Iterator[tuple[str, str, int]]:
        """(held part, word, n) of the held parts that are one edit from this one."""
        if self.heads is None:
            if len(self.items) <= FEW or len(self.items[0][0]) < 2:
                for found in self.items:
                    if one_apart(found[0], part):
                        yield found
                return
            size = len(self.items[0][0])
            self.cut, self.rest, self.heads, self.tails = size // 2, size - size // 2, {}, {}
            for other, word, n in self.items:
                self.heads.setdefault(other[: self.cut], Parts()).items.append((other[self.cut :], word, n))
                self.tails.setdefault(other[self.cut :], Parts()).items.append((other[: self.cut], word, n))
            self.items = None
        head, size = part[: self.cut], len(part) - self.rest
        if held := self.heads.get(head):
            for tail, word, n in held.near(part[self.cut :]):
                yield head + tail, word, n
        if size >= 0 and (held := self.tails.get(part[size:])):
            for other, word, n in held.near(part[:size]):
                if other != head:
                    yield other + part[size:], word, n


class Halves:
    """An automaton of the first (side 0) or second (side 1) halves of words; a half leads to the other parts by the words' lengths."""

    def __init__(self, side: int):
        self.side, self.held, self.automaton = side, {}, None

    def add(self, word: str, n: int) -> None:
        cut = len(word) // 2
        half, rest = (word[cut:], word[:cut]) if self.side else (word[:cut], word[cut:])
        by_length = self.held.setdefault(half, {})
        if len(word) not in by_length:
            by_length[len(word)] = Parts()
        by_length[len(word)].items.append((rest, word, n))

    def near(self, word: str) -> Iterator[tuple[str, int]]:
        """Pattern words one edit from this one. What the first halves tell is not told by the second ones again."""
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for half, by_length in self.held.items():
                self.automaton.add_word(half, (len(half), by_length))
            self.held = {}
            if len(self.automaton):
                self.automaton.make_automaton()
        if not len(self.automaton):
            return
        size = len(word)
        for end, (length, by_length) in self.automaton.iter(word):
            if end != (size if self.side else length) - 1:
                continue
            rest = word[: size - length] if self.side else word[length:]
            for other in (size - 1, size, size + 1):
                if other in by_length:
                    for part, pattern, n in by_length[other].near(rest):
                        if not (self.side and word.startswith(part)):
                            yield pattern, n


def _scanned(rows: Iterator[tuple]) -> Iterator[tuple[str, list[tuple[str, int]]]]:
    """Rows (shard, side, word, n; patterns have n, scanned words null and come later) to each scanned word's near patterns."""
    held, key = Halves(0), None
    for shard, side, word, n in rows:
        if (shard, side) != key:
            held, key = Halves(side), (shard, side)
        if n is not None:
            held.add(word, n)
        elif found := list(held.near(word)):
            yield word, found


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], f.type) for i, f in enumerate(schema)], schema=schema)

    for r in rows:
        held.append(r)
        if len(held) >= 10_000:
            yield told()
            held = []
    yield told()


def _dealt(words: DataFrame, shard_words: int) -> DataFrame:
    """Patterns and scanned words (n null) by shard, patterns first. Ends are short, so the table of their counts is small."""
    first, last = F.substring("word", 1, END), F.substring("word", -END, END)
    ends = words.select("word", "n", F.posexplode(F.array(first, last)).alias("side", "end"))
    parts = ends.groupBy("side", "end").agg(F.ceil(F.count(F.lit(1)) / shard_words).alias("parts"))
    known = ends.join(F.broadcast(parts), ["side", "end"])
    patterns = known.select("side", "end", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int").alias("part"), "word", "n")
    scanned = known.select("side", "end", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))).alias("part"), "word", F.lit(None).cast("long").alias("n"))
    rows = patterns.unionByName(scanned).select(F.concat_ws(" ", "part", "end").alias("shard"), "side", "word", "n")
    return rows.repartition("shard", "side").sortWithinPartitions("shard", "side", F.col("n").desc_nulls_last(), "word")


def near_pairs(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, near, near_n: every ordered pair of words (word, n) that are one edit apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(((word, near, n) for word, found in _scanned(_rows(batches)) for near, n in found), _PAIRS)

    return _dealt(words.select("word", "n"), shard_words).mapInArrow(run, "word string, near string, near_n long")


def near_summaries(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, n_near, form_n, form: how many words are near, and the most frequent of them (ties: the smallest); pairs stay in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def best() -> Iterator[tuple]:
            for word, found in _scanned(_rows(batches)):
                near, n = min(found, key=lambda x: (-x[1], x[0]))
                yield word, len(found), n, near

        yield from _batches(best(), _FOUND)

    found = _dealt(words.select("word", "n"), shard_words).mapInArrow(run, "word string, n_near long, form_n long, form string")
    top = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form"))).alias("top")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top).select("word", "n_near", (-F.col("top.less")).alias("form_n"), "top.form")


def roots(forms: DataFrame) -> DataFrame:
    """word, root for rows (word, form) whose forms lead to no loop: pointers are doubled, so a chain of k forms takes log2 k joins."""
    now = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        stepped = saved(stepped)
        now = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return now


def group_variants(words: DataFrame, times: int = TIMES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, n, n_near, form, form_n, root for words (word, n). A form's count is at least `times` the word's, so forms lead to ever
    more frequent words and end in a root."""
    spark = words.sparkSession
    words = saved(words.select("word", "n"))
    near = near_summaries(words, shard_words)
    enough = F.col("form_n") >= times * F.col("n")
    told = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"))
    told = saved(told)
    small_batches(spark)
    ends = roots(told.where("form is not null"))
    return told.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The words of all documents (doc_id, text) with their near words' count, form and root."""
    return group_variants(count_words(docs))
