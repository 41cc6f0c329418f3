"""Repeated passages by phrase automata: confirm recurring passages, compile Aho-Corasick automata of them in shards, locate every occurrence.

A window is WINDOW consecutive words. It recurs if the same words start anywhere else. Windows are
too many to compare one by one, so each names its seed: the phrase of SEED words in it that has the least hash (the last of
equal ones). Equal windows have equal seeds at equal offsets, so a window whose seed occurs once is unique. Runs of windows
with one seed are a stretch.

1. Seeds are counted over all texts; those that occur once are done with.
2. Stretches of the other seeds are grouped by seed and digest (128 bits of hashes of their words); a stretch that lies in two places is a passage.
3. Confirmation: of seeds that also have stretches of one place, one place of each distinct stretch is read, and the stretches are compared window by
   window, words with words; runs of recurring windows are passages. A seed with more than HOT_STRETCHES of them is dealt by
   window instead, so that no task gets all of one seed.
4. Documents are dealt to shards of about SHARD_BYTES. A shard is told where its documents have passages, reads their words there (passages that
   join on are one), compiles the distinct ones, words as numbers, to one automaton, and streams its documents through it: the automaton
   locates every occurrence. Covered words are removed.

Texts are shuffled once, by shard, and read in steps 3 and 4.

Null text has no words; a null id is an id; repeated rows are documents of their own, so all their windows recur; texts under
WINDOW words lose nothing; other columns are ignored. Empty tables give no rows. Whole texts are read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetloom.llm.common import SLICE_BYTES, saved, small_batches, stored, text_slices, text_udf

WINDOW, SEED = 35, 6
#: Bytes of texts of a shard; distinct stretches of a seed that one task compares.
SHARD_BYTES, HOT_STRETCHES = 4 << 20, 2_000

_ODD, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_INVERSE = pow(_ODD, -1, 1 << 64)


def words_of(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+, unchanged (bytes.split cuts at just those six)."""
    return text.encode("utf-8", "replace").split() if text else []


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def stretches(hashes: np.ndarray, window: int = WINDOW, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """seed, digest, start, windows of the runs of windows that share a seed's place; a run spans windows + window - 1 words."""
    none = np.zeros(0, np.uint64)
    if len(hashes) < window:
        return none, none, none, none
    phrases = np.zeros(len(hashes) - seed + 1, np.uint64)
    for i in range(seed):
        phrases = phrases * np.uint64(_ODD) + hashes[i : len(hashes) - seed + 1 + i]
    phrases = _mixed(phrases)

    def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(phrases[b] <= phrases[a], b, a)

    span, at, size = window - seed + 1, np.arange(len(phrases)), 1
    while size * 2 <= span:
        at, size = least(at[: len(at) - size], at[size:]), size * 2
    if size < span:
        at = least(at[: len(at) - (span - size)], at[span - size :])
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    n = np.diff(np.concatenate((first, [len(at)])))
    return phrases[at[first]], digests(hashes, first, first + n + window - 1), first, n


def digests(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit digests of the runs [begin, end) of words."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mixed(hashes) * _powers(_ODD, len(hashes)))))
    return _mixed((sums[end] - sums[begin]) * _powers(_INVERSE, len(hashes) + 1)[begin] + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _with_row(docs: DataFrame, shards: int) -> DataFrame:
    """shard, row, doc_id, text: row is a number of id and text, which need not be unique."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("row", F.xxhash64("doc_id", "text"))
    return docs.select(shard_of("row", shards), "row", "doc_id", "text")


def packed(text: str) -> Column:
    """The column's texts, each compressed by itself."""

    def make():
        pack = zstandard.ZstdCompressor(level=3).compress
        return lambda t: None if t is None else pack(t.encode("utf-8", "replace"))

    return text_udf("binary", lambda found: pa.array(found, pa.binary()), make)(text)


def shard_of(row: str, shards: int) -> Column:
    return F.pmod(row, F.lit(shards)).cast("int").alias("shard")


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, int, list]]:
    """(batch, index of the first, texts) of bounded runs of a batch's texts."""
    for b in batches:
        for at, some in text_slices(b.column(column)):
            yield b, at, some


def seed_rows(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """seed of each stretch of each document."""
    schema = pa.schema([("seed", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, some in _texts(batches, 0):
            found = [stretches(word_hashes(words_of(t)), window, seed)[0] for t in some]
            yield pa.RecordBatch.from_arrays([_signed(np.concatenate([np.zeros(0, np.uint64), *found]))], schema=schema)

    return docs.select("text").mapInArrow(run, "seed long")


def stretch_rows(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """row, seed, digest, start, n of each stretch of each document."""
    schema = pa.schema([(c, pa.int64()) for c in ("row", "seed", "digest", "start", "n")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, at, some in _texts(batches, 1):
            found = [stretches(word_hashes(words_of(t)), window, seed) for t in some]
            rows = np.repeat(b.column(0).slice(at, len(some)).to_numpy(zero_copy_only=False), [len(f[0]) for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), *[_signed(np.concatenate([np.zeros(0, np.uint64), *[f[i] for f in found]])) for i in range(4)]], schema=schema)

    return docs.select("row", "text").mapInArrow(run, "row long, seed long, digest long, start long, n long")


_READ = pa.schema([("cell", pa.int64()), ("seed", pa.int64()), ("digest", pa.int64()), ("places", pa.int64()), ("at", pa.int64()), ("hot", pa.bool_()), ("words", pa.string())])
READ = "cell long, seed long, digest long, places long, at long, hot boolean, words string"


def _told(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _batched(rows: Iterator[tuple], schema: pa.Schema, text_at: int | None = None) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += (0 if text_at is None else len(r[text_at])) + 64
        if size >= SLICE_BYTES:
            yield _told(held, schema)
            held, size = [], 0
    yield _told(held, schema)


def _rows_of(table: pa.Table) -> Iterator[tuple]:
    for b in table.to_batches():
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _documents(texts: pa.Table) -> Iterator[tuple[int, int | None, bytes]]:
    """row, doc_id, text of a shard, whose texts come packed; one is unpacked at a time."""
    unpack = zstandard.ZstdDecompressor().decompress
    for b in texts.to_batches():
        for row, doc_id, text in zip(b.column("row").to_pylist(), b.column("doc_id").to_pylist(), b.column("packed"), strict=True):
            yield row, doc_id, unpack(text.as_py()) if text.is_valid else b""


def _places(texts: pa.Table, wanted: dict[int, list[tuple]], window: int) -> Iterator[tuple[list[tuple], list[bytes]]]:
    """(wanted places, words) of the documents that have any; places are (row, start, n windows, digest, ...). Equal documents serve once. If
    different documents share a row's number, which of them is meant shows by the digest."""
    rows = Counter(dict.fromkeys(wanted, 0))
    rows.update(r for r in texts.column("row").to_pylist() if r in wanted)
    served: set[tuple[int, bytes]] = set()
    for row, _, text in _documents(texts):
        if row not in wanted:
            continue
        places = wanted[row]
        words = text.split()
        if rows[row] > 1:
            print_ = (row, hashlib.sha256(text).digest())
            if print_ in served:
                continue
            served.add(print_)
            places = [p for p in places if _digest(words[p[1] : p[1] + p[2] + window - 1]) == p[3]]
        yield places, words


def _digest(words: list[bytes]) -> int:
    return int(digests(word_hashes(words), np.array([0]), np.array([len(words)])).view(np.int64)[0])


def _by_row(places: pa.Table) -> dict[int, list[tuple]]:
    out: dict[int, list[tuple]] = {}
    for r in _rows_of(places):
        out.setdefault(r[0], []).append(r)
    return out


def read_stretches(dealt: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """cell, seed, digest, places, at, hot, words of the wanted stretches (shard, row, start, n, digest, seed, places, hot), read where they
    lie. A stretch of a hot seed comes as its windows, each of which (at: its index) is a cell."""

    def read(key, texts: pa.Table, places: pa.Table) -> pa.Table:
        def rows() -> Iterator[tuple]:
            for asked, words in _places(texts, _by_row(places.drop_columns("shard")), window):
                for _, start, n, digest, seed, times, hot in asked:
                    there = words[start : start + n + window - 1]
                    if not hot:
                        yield seed, seed, digest, times, 0, False, b" ".join(there).decode()
                        continue
                    first = np.arange(n)
                    for i, cell in enumerate(digests(word_hashes(there), first, first + window).view(np.int64).tolist()):
                        yield cell, seed, digest, times, i, True, b" ".join(there[i : i + window]).decode()

        return pa.Table.from_batches(_batched(rows(), _READ, 6), _READ)

    places = wanted.select("shard", "row", "start", "n", "digest", "seed", "places", "hot")
    return dealt.groupBy("shard").cogroup(places.groupBy("shard")).applyInArrow(read, READ)


def passages_of(stretches_of_seed: list[tuple[int, int, str]], window: int = WINDOW) -> Iterator[tuple[int, int, int]]:
    """(digest, first window, windows) of the runs of recurring windows in those of the distinct stretches (digest, places, words) of
    one seed that lie in one place."""
    split = [(digest, places, words.encode().split()) for digest, places, words in stretches_of_seed]
    times: dict[bytes, int] = {}
    for _, places, words in split:
        for i in range(len(words) - window + 1):
            w = b" ".join(words[i : i + window])
            times[w] = times.get(w, 0) + places
    for digest, places, words in split:
        if places == 1:
            recurs = [times[b" ".join(words[i : i + window])] > 1 for i in range(len(words) - window + 1)]
            for yes, run in groupby(range(len(recurs)), key=recurs.__getitem__):
                if yes:
                    at = list(run)
                    yield digest, at[0], len(at)


def confirm(found: DataFrame, window: int) -> DataFrame:
    """seed, digest, first, windows of the passages in read stretches. Windows of hot seeds are summed up by Spark, before and after the shuffle."""
    schema = pa.schema([(c, pa.int64()) for c in ("seed", "digest", "first", "windows")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            each = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
            for seed, group in groupby(each, key=itemgetter(0)):
                for digest, first, n in passages_of([r[1:] for r in group], window):
                    yield seed, digest, first, n

        yield from _batched(rows(), schema)

    usual = found.where("not hot").select("seed", "digest", "places", "words").repartition("seed").sortWithinPartitions("seed").mapInArrow(run, "seed long, digest long, first long, windows long")
    hot = found.where("hot")
    recurring = hot.groupBy("cell", "words").agg(F.sum("places").alias("times")).where("times > 1").select("cell", "words")
    single = hot.where("places = 1").join(recurring, ["cell", "words"], "left_semi").select("seed", "digest", F.col("at").alias("first"), F.lit(1).cast("long").alias("windows"))
    return usual.unionByName(single)


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans [start, end) that meet or overlap as one, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


class Phrases:
    """An Aho-Corasick automaton of passages whose letters are words."""

    def __init__(self, passages: Iterable[tuple[bytes, ...]]):
        self.numbers: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for passage in passages:
            key = tuple([self.numbers.setdefault(w, len(self.numbers) + 1) for w in passage])
            self.automaton.add_word(key, len(key))
        if len(self.automaton):
            self.automaton.make_automaton()

    def spans(self, words: list[bytes]) -> list[tuple[int, int]]:
        """Where passages lie in the words: [start, end) of the words that they cover, in order and apart."""
        if not len(self.automaton):
            return []
        number = self.numbers.get
        out: list[tuple[int, int]] = []
        for end, length in self.automaton.iter(tuple([number(w, 0) for w in words])):
            start = end + 1 - length
            while out and out[-1][0] >= start:
                out.pop()
            if out and out[-1][1] >= start:
                start = out.pop()[0]
            out.append((start, end + 1))
        return out


_CUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string())])


def without_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, shard_bytes: int = SHARD_BYTES, hot: int = HOT_STRETCHES) -> DataFrame:
    """doc_id, n_words, spans, kept of each document (doc_id, text): the removed runs of words, and the other words joined by one space."""
    small_batches(docs.sparkSession)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-size // shard_bytes))
    docs = _with_row(docs, shards)
    dealt = docs.select("shard", "row", "doc_id", packed("text").alias("packed"))
    # Saved, so that the join with it is a stage of its own, whose hot seeds AQE splits.
    recurring = saved(seed_rows(docs, window, seed).groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("seed"))
    held = stored(stretch_rows(docs, window, seed).join(recurring, "seed"), "stretches")
    distinct = held.groupBy("seed", "digest").agg(F.count(F.lit(1)).alias("places"), F.min(F.struct("row", "start", "n", shard_of("row", shards))).alias("at"))
    per_seed = distinct.groupBy("seed").agg((F.count(F.lit(1)) > hot).alias("hot"), F.count(F.lit(1)).alias("n"), F.min("places").alias("least")).where("n > 1 and least = 1").select("seed", "hot")
    wanted = distinct.join(per_seed, "seed").select("seed", "digest", "places", "hot", "at.*")
    found = stored(read_stretches(dealt, wanted, window), "read")
    whole = distinct.where("places > 1").select("seed", "digest", F.lit(0).cast("long").alias("first"), F.col("at.n").alias("windows"))
    passages = whole.unionByName(confirm(found, window))
    patterns = held.join(passages, ["seed", "digest"]).select(shard_of("row", shards), "row", "start", "n", "digest", "first", "windows")

    def cut(key, texts: pa.Table, places: pa.Table) -> pa.Table:
        def passages_here() -> Iterator[tuple[bytes, ...]]:
            for told, words in _places(texts, _by_row(places.drop_columns("shard")), window):
                for begin, end in merged((start + first, start + first + n) for _, start, _, _, first, n in told):
                    yield tuple(words[begin : end + window - 1])

        phrases = Phrases(set(passages_here()))

        def rows() -> Iterator[tuple]:
            for _, doc_id, text in _documents(texts):
                words = text.split()
                spans, kept, last = phrases.spans(words), [], 0
                for start, end in spans:
                    kept += words[last:start]
                    last = end
                yield doc_id, len(words), [{"start": a, "end": z} for a, z in spans], b" ".join(kept + words[last:]).decode()

        return pa.Table.from_batches(_batched(rows(), _CUT, 3), _CUT)

    schema = "doc_id long, n_words long, spans array<struct<start: long, end: long>>, kept string"
    return dealt.groupBy("shard").cogroup(patterns.groupBy("shard")).applyInArrow(cut, schema)


def repeat_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each document."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return without_repeats(docs).select("doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
