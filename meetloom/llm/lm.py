"""Language-model scoring with a hashed maximum-entropy model.

Tokens are the words [^\\x20\\x09-\\x0D]+ with A-Z lower-cased, and one end for each text. The
corpus counts of all training tokens are a distributed table that grows with the corpus.
The most frequent words are symbols of their own; any other word is a symbol by a hash of
its ending. Within such a group, a word's probability is q e^weight / Z: q is (count + 1) /
(the group's counts + 1 each + 1 for what was never seen), the weight is that of the feature
(whole word before, whole word), 0 where it has none, and Z the sum over the group. So the
model is a distribution over all words.

P(symbol | two symbols before) = P(class | ..) * P(symbol | class, ..), both softmaxes over
the hashed features: bias, last symbol, skip (the symbol before it), and the pair. Weights
are learned by rounds of distributed gradient updates: the events (context, symbol, count)
of all training texts are one aggregated table, pre-aggregated by task; each part of it
computes the model's expectations on its contexts, the differences are summed up by runs of
features in a second step, and the driver, which gets one packed sum of the model's size,
takes a damped diagonal Newton step on every weight, with an L2 penalty. Model, events and
gradients are bounded by SYMBOLS and BUCKETS, whatever the corpus' size.

Word pairs have a feature if both words are FREQUENT and the pair has a share of PAIRS of all
tokens, so there are at most 1/PAIRS of them. They are counted over the whole corpus in the
pass that counts the events. As no feature of a word before touches another's, each part
of them, dealt by the word before, runs its damped Newton steps by itself.

Scoring runs in sparse numpy batches: a batch's distinct contexts gather their weight rows
once. Words as frequent as FREQUENT (at most 1/FREQUENT of them, a bounded broadcast) are
looked up in the task; only rarer ones are joined with the counts by a shuffle. A worker
holds one index of those words, and one running sum of gradients or of events.

Null text counts as empty (one token, the end). A null id counts as ''. Without training
text, counts are 0 and scores follow from that. Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meetloom.llm.common import held_one, lower_words, saved, small_batches, stored, text_slices, training_part

SYMBOLS, TAILS, CLASSES = 256, 64, 16
#: RATE is the share of a diagonal Newton step; PENALTY is that of squared weights.
BUCKETS, ROUNDS, RATE, PENALTY = 1 << 14, 10, 0.5, 5.0
#: A part of the events per so many of them, between the least and the most parts; runs of features that are summed up together.
FREQUENT, PART_EVENTS, PARTS, RUNS = 4e-6, 500_000, (8, 256), 16
#: The least share of a pair with a weight, the rounds and the L2 penalty of these weights.
PAIRS, PAIR_ROUNDS, PAIR_PENALTY = 2e-6, 80, 0.5
#: Codes of events are below EVENTS. Pairs are coded beyond, as the word before << KEY_BITS, plus the group, or TAILS plus the word.
EVENTS, KEY_BITS = SYMBOLS**3, 20
END = b""  # the end's key among the counts; no word is empty
KEPT_TOKENS, KEPT_EVENTS, KEPT_CODES = 200_000, 2_000_000, 1_000_000


def tail_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % TAILS


def context_features(context: np.ndarray) -> np.ndarray:
    """(n, 4) weight rows of contexts coded as (two before) * SYMBOLS + (one before)."""
    two, one = context // SYMBOLS, context % SYMBOLS
    pair = (context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    own = 1 + 2 * SYMBOLS
    return np.stack([np.zeros_like(one), 1 + one, 1 + SYMBOLS + two, own + (pair % np.uint64(BUCKETS - own)).astype(np.int64)], 1)


@dataclass
class MaxEnt:
    """Symbols are ordered so that each class is a run of SYMBOLS // CLASSES of them. A head word's id is its symbol; the end's is 0."""

    head: dict[bytes, int]
    by_class: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, CLASSES), np.float32))
    by_symbol: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, SYMBOLS), np.float32))

    def log_parts(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Natural logs: (n, CLASSES) of the classes, (n, SYMBOLS) of the symbols within their classes."""
        f = context_features(context)
        c, s = self.by_class[f[:, 0]], self.by_symbol[f[:, 0]]
        for i in range(1, f.shape[1]):
            c, s = c + self.by_class[f[:, i]], s + self.by_symbol[f[:, i]]
        return _log_softmax(c), _log_softmax(s.reshape(len(s), CLASSES, -1)).reshape(len(s), -1)

    def log10_table(self, context: np.ndarray) -> np.ndarray:
        c, s = self.log_parts(context)
        return ((np.repeat(c, SYMBOLS // CLASSES, 1) + s) / math.log(10)).astype(np.float32)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(-1, keepdims=True)
    return x - np.log(np.exp(x).sum(-1, keepdims=True))


def _chunks(texts: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(index of the first, words of each) for runs of texts of bounded size."""
    for at, some in text_slices(texts):
        yield at, list(map(lower_words, some))


def count_tokens(texts: DataFrame) -> DataFrame:
    """token, n over all texts ('' is the end), computed once. Tasks pre-aggregate before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8", "replace") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], ["token", "n"])

        for batch in batches:
            for _, words in _chunks(batch.column(0)):
                for ws in words:
                    held.update(ws)
                held[END] += len(words)
                if len(held) > KEPT_TOKENS:
                    yield out()
                    held.clear()
        yield out()

    return stored(texts.select("text").mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n")), "token-counts")


def tail_totals(counts: DataFrame, head: dict[bytes, int]) -> list[int]:
    """Per group of endings: the sum of (count + 1) over its words, and 1 for the unseen."""
    shared = counts.sparkSession.sparkContext.broadcast(set(head))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(TAILS, np.int64)
        for b in batches:
            for t, n in zip(b["token"].tolist(), b["n"].tolist(), strict=True):
                if (w := t.encode()) not in shared.value:
                    total[tail_of(w)] += n + 1
        yield pd.DataFrame({"tail": np.arange(TAILS), "total": total})

    out = [1] * TAILS
    for r in counts.mapInPandas(run, "tail long, total long").groupBy("tail").agg(F.sum("total").alias("total")).collect():
        out[r["tail"]] += r["total"]
    return out


def _contexts(y: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each token's two symbols before it, coded; y are the symbols of texts of these lengths, ends included, and the end's symbol is 0."""
    one, two = np.zeros_like(y), np.zeros_like(y)
    one[1:], two[2:] = y[:-1], y[:-2]
    two[(np.cumsum(length) - length)] = 0
    return two * SYMBOLS + one


@dataclass
class Words:
    """The frequent words as one index: place[word] leads to its count and symbol."""

    head: dict[bytes, int]
    words: list[bytes]
    n: np.ndarray
    place: dict[bytes, int] = field(default_factory=dict)

    def indexed(self) -> Words:
        """Built once a worker."""
        if not hasattr(self, "symbol"):
            self.place = {w: i for i, w in enumerate(self.words)}
            self.log_n = np.log10(self.n + 1.0)
            self.symbol = np.array([*map(self.symbol_of, self.words), 0], np.int64)  # one more for words that are not here
        return self

    def symbol_of(self, word: bytes) -> int:
        return self.head[word] if word in self.head else SYMBOLS - TAILS + tail_of(word)


def _coded(known: Words, words: list[list[bytes]]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of some texts, ends included; their places (-1: not frequent), their symbols, the texts' lengths."""
    flat = [w for ws in words for w in (*ws, END)]
    at = np.fromiter(map(known.place.get, flat, repeat(-1)), np.int64, len(flat))
    y, lacks = known.symbol[at], np.flatnonzero(at < 0)
    y[lacks] = [known.symbol_of(flat[k]) for k in lacks.tolist()]
    return flat, at, y, np.array([len(ws) + 1 for ws in words], np.int64)


def _pairs(known: Words, at: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where grouped words follow a frequent word (a text's first word follows an end): their indices, the pairs' codes with the group, and with the word (without one: that of the group)."""
    before = np.concatenate([[known.place.get(END, -1)], at[:-1]])
    here = np.flatnonzero((y >= SYMBOLS - TAILS) & (before >= 0))
    code, group = EVENTS + (before[here] << KEY_BITS), y[here] - (SYMBOLS - TAILS)
    return here, code + group, code + np.where(at[here] >= 0, TAILS + at[here], group)


def count_events(texts: DataFrame, shared: Broadcast[Words], total: int) -> tuple[DataFrame, DataFrame]:
    """(context, symbol, n with contexts whole in their partitions; code, n of the pairs and of their groups that reach PAIRS), over all texts, computed once. Tasks pre-aggregate before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.indexed()
        held = np.empty(0, np.int64), np.empty(0, np.int64)
        waiting: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*map(pa.array, held)], ["code", "n"])

        for batch in batches:
            for _, words in _chunks(batch.column(0)):
                _, at, y, length = _coded(known, words)
                _, group, word = _pairs(known, at, y)
                waiting += [_contexts(y, length) * SYMBOLS + y, group, word[word != group]]
                if sum(map(len, waiting)) > KEPT_CODES:
                    held = merged(held, np.unique(np.concatenate(waiting), return_counts=True))
                    waiting.clear()
                if len(held[0]) > KEPT_EVENTS:
                    yield out()
                    held = held[0][:0], held[1][:0]
        if waiting:
            held = merged(held, np.unique(np.concatenate(waiting), return_counts=True))
        yield out()

    counted = texts.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counted = stored(counted.where((F.col("code") < EVENTS) | (F.col("n") >= PAIRS * total)), "lm-events")
    events = counted.where(F.col("code") < EVENTS).select(F.expr(f"code div {SYMBOLS}").alias("context"), (F.col("code") % SYMBOLS).alias("symbol"), "n")
    parts = min(PARTS[1], max(PARTS[0], events.count() // PART_EVENTS))
    return saved(events.repartition(parts, "context")), counted.where(F.col("code") >= EVENTS)


def fit_pairs(code: np.ndarray, n: np.ndarray, known: Words, tails: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, log10 values) of these pairs and groups, with all that share a word before: the weight of a pair, -log10 Z of a group."""
    order = np.argsort(code)
    code, n = code[order], n[order].astype(np.float64)
    key = (code - EVENTS) & ((1 << KEY_BITS) - 1)
    whole, word = key < TAILS, key[key >= TAILS] - TAILS
    groups, pairs = code[whole], code[~whole]
    group = known.symbol[word] - (SYMBOLS - TAILS)
    mine = np.searchsorted(groups, pairs - key[~whole] + group)  # a pair's group has its count at least, so it is here
    c, of_group, q = n[~whole], n[whole][mine], (known.n[word] + 1) / tails[group]
    weight = np.zeros(len(pairs))
    for _ in range(PAIR_ROUNDS):
        z = 1 + np.bincount(mine, q * np.expm1(weight), len(groups))
        expected = of_group * q * np.exp(weight) / z[mine]
        weight += RATE * (c - expected - PAIR_PENALTY * weight) / (np.maximum(c, expected) + PAIR_PENALTY)
    z = 1 + np.bincount(mine, q * np.expm1(weight), len(groups))
    met = np.unique(mine)
    return np.concatenate([pairs, groups[met]]), np.concatenate([weight / math.log(10), -np.log10(z[met])])


def pair_values(pairs: DataFrame, shared: Broadcast[Words], tails: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes and their log10 values, at most 2/PAIRS of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[b.column(i).to_numpy(zero_copy_only=False) for i in range(2)] for b in batches]
        if parts:
            code, value = fit_pairs(*(np.concatenate([p[i] for p in parts]) for i in range(2)), shared.value.indexed(), tails)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(value.astype(np.float32))], ["code", "value"])

    got = pairs.repartition(F.expr(f"shiftright(code - {EVENTS}, {KEY_BITS})")).mapInArrow(run, "code long, value float").toPandas().sort_values("code")
    return got["code"].to_numpy(np.int64), got["value"].to_numpy(np.float32)


def looked_up(codes: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of the wanted codes; 0 where there is none."""
    if not len(codes):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
    return np.where(codes[at] == wanted, values[at], 0)


def merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two (sorted codes, counts) as one."""
    code = np.concatenate([a[0], b[0]])
    order = np.argsort(code, kind="stable")
    code, n = code[order], np.concatenate([a[1], b[1]]).astype(np.int64)[order]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.empty(0, np.int64)
    return code[first], np.add.reduceat(n, first) if len(first) else n


def _by_feature(f: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of d for each distinct feature, over all columns of f."""
    flat, row = f.ravel(), np.repeat(np.arange(len(f)), f.shape[1])
    order = np.argsort(flat, kind="stable")
    features, start = np.unique(flat[order], return_index=True)
    return features, np.add.reduceat(d[row[order]], start, axis=0)


def gradient(model: MaxEnt, context: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slope, seen): observed less expected, and observed, sums over these events by feature, CLASSES + SYMBOLS columns."""
    order = np.argsort(context, kind="stable")
    context, symbol, n = context[order], symbol[order], n[order]
    contexts, first = np.unique(context, return_index=True)
    first = np.append(first, len(context))
    slope, seen = (np.zeros((BUCKETS, CLASSES + SYMBOLS), np.float32) for _ in range(2))  # running sums: no block's rows are kept
    for low in range(0, len(contexts), 512):
        here = contexts[low : low + 512]
        mine = slice(first[low], first[min(low + 512, len(contexts))])
        got = np.zeros((len(here), SYMBOLS))
        got[np.searchsorted(here, context[mine]), symbol[mine]] = n[mine]  # an event is one row
        in_class = got.reshape(len(here), CLASSES, -1).sum(2)
        c, s = model.log_parts(here)
        both = np.concatenate([in_class, got], 1)
        apart = both - np.concatenate([np.exp(c) * in_class.sum(1, keepdims=True), np.exp(s) * np.repeat(in_class, SYMBOLS // CLASSES, 1)], 1)
        f = context_features(here)
        for total, part in ((slope, apart), (seen, both)):
            rows, sums = _by_feature(f, part)
            total[rows] += sums
    return slope, seen


def packed(values: np.ndarray, mass: np.ndarray) -> bytes:
    """Sums by feature as one message: the rows that have a mass, per event of the feature and in half precision, which is ample for a gradient."""
    rows = np.flatnonzero(mass)
    small = (values[rows] / (mass[rows, None] + 1)).astype(np.float16)
    return zstandard.compress(b"".join([np.int32(len(rows)).tobytes(), rows.astype(np.int32).tobytes(), mass[rows].astype(np.float32).tobytes(), np.ascontiguousarray(small).tobytes()]))


def add_packed(raw: bytes, total: np.ndarray, mass: np.ndarray | None = None) -> None:
    raw = zstandard.decompress(raw)
    n = int(np.frombuffer(raw, np.int32, 1)[0])
    f, m = np.frombuffer(raw, np.int32, n, 4), np.frombuffer(raw, np.float32, n, 4 + 4 * n)
    total[f] += np.frombuffer(raw, np.float16, -1, 4 + 8 * n).reshape(n, CLASSES + SYMBOLS).astype(np.float32) * (m[:, None] + 1)
    if mass is not None:
        mass[f] += m


def train(events: DataFrame, model: MaxEnt, rounds: int = ROUNDS) -> MaxEnt:
    """Rounds of distributed gradient updates: the model is broadcast, each part sends its gradient (in the first round, the observed
    counts that scale the steps too) packed in RUNS runs of features, each run is summed up by one task, and the driver receives the sums."""
    spark = events.sparkSession
    width, runs = CLASSES + SYMBOLS, np.array_split(np.arange(BUCKETS), RUNS)
    kind = "run int, slope binary, seen binary"
    seen = np.zeros((BUCKETS, width), np.float32)
    for k in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def part(batches: Iterator[pa.RecordBatch], shared=shared, first=k == 0) -> Iterator[pa.RecordBatch]:
            parts = [[b.column(i).to_numpy(zero_copy_only=False) for i in range(3)] for b in batches]
            if parts:
                slope, got = gradient(shared.value, *(np.concatenate([p[i] for p in parts]) for i in range(3)))
                mass = got[:, :CLASSES].sum(1)
                for i, rows in enumerate(runs):
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *(pa.array([x], pa.binary()) for x in (packed(slope[rows], mass[rows]), packed(got[rows], mass[rows]) if first else None))], ["run", "slope", "seen"])

        def summed(batches: Iterator[pa.RecordBatch], first=k == 0) -> Iterator[pa.RecordBatch]:
            totals: dict[int, list[np.ndarray]] = {}
            for b in batches:
                for i, raw, got in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if i not in totals:
                        totals[i] = [np.zeros((len(runs[i]), width), np.float32) for _ in range(1 + first)] + [np.zeros(len(runs[i]), np.float32)]
                    add_packed(raw, totals[i][0], totals[i][-1])
                    if first:
                        add_packed(got, totals[i][1])
            for i, (*sums, mass) in totals.items():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *(pa.array([packed(s, mass)], pa.binary()) for s in sums), *([] if first else [pa.array([None], pa.binary())])], ["run", "slope", "seen"])

        slope = np.zeros_like(seen)
        for r in events.mapInArrow(part, kind).repartition(RUNS, "run").mapInArrow(summed, kind).collect():  # two models in half precision at most
            add_packed(r["slope"], slope[runs[r["run"]][0] :])
            if r["seen"]:
                add_packed(r["seen"], seen[runs[r["run"]][0] :])
        for weight, cols in ((model.by_class, slice(None, CLASSES)), (model.by_symbol, slice(CLASSES, None))):
            g, s = slope[:, cols], seen[:, cols]
            weight += RATE * (g - PENALTY * weight) / (np.maximum(s, s - g) + PENALTY)  # the larger of observed and expected
        shared.destroy()  # its sums are here; unpersist would leave a file a round on the driver
    return model


def score_documents(docs: DataFrame, parts: int = 7, held_out: int = 2, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per row of docs, logs to base 10."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    training = docs.where(training_part(F.col("doc_id"), parts, held_out)).select("text")
    counts = count_tokens(training)
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    frequent = counts.where(F.col("n") >= FREQUENT * total).orderBy(F.desc("n"), F.col("token").cast("binary")).toPandas()  # at most 1/FREQUENT rows
    words = [w.encode() for w in frequent["token"]]
    top = [w for w in words if w != END][: SYMBOLS - TAILS - 1]
    model = MaxEnt({END: 0, **{w: i + 1 for i, w in enumerate(top)}})
    tails = np.array(tail_totals(counts, model.head), np.float64)
    vocabulary = spark.sparkContext.broadcast(Words(model.head, words, frequent["n"].to_numpy(np.int64)))
    codes, values = np.empty(0, np.int64), np.empty(0, np.float32)
    if total:
        events, pairs = count_events(training, vocabulary, total)
        model = train(events, model, rounds)
        codes, values = pair_values(pairs, vocabulary, tails)
    log_n = math.log10(total + distinct + 1)
    shared = spark.sparkContext.broadcast((model, np.log10(tails), codes, values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (m, log_tails, codes, values) = vocabulary.value.indexed(), shared.value
        table, filled = held_one(shared, lambda: (np.empty((SYMBOLS * SYMBOLS, SYMBOLS), np.float32), np.zeros(SYMBOLS * SYMBOLS, bool)))
        row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
        for batch in batches:
            ids = batch.column(0)
            for at, texts in _chunks(batch.column(1)):
                n = len(texts)
                flat, at_word, y, length = _coded(known, texts)
                text, met = np.repeat(np.arange(n), length), at_word >= 0
                lost: list[dict[bytes, int]] = [{} for _ in texts]
                for k in np.flatnonzero(~met).tolist():
                    if w := flat[k]:
                        of_text = lost[text[k]]
                        of_text[w] = of_text.get(w, 0) + 1
                context = _contexts(y, length)
                new = np.unique(context[~filled[context]])
                for low in range(0, len(new), 512):
                    table[new[low : low + 512]] = m.log10_table(new[low : low + 512])
                filled[new] = True
                grouped = y >= SYMBOLS - TAILS
                logs, own = np.zeros(len(y)), np.zeros(len(y))
                logs[met] = known.log_n[at_word[met]]
                own[grouped] = logs[grouped] - log_tails[y[grouped] - (SYMBOLS - TAILS)]
                here, group, word = _pairs(known, at_word, y)
                own[here] += looked_up(codes, values, group) + np.where(word != group, looked_up(codes, values, word), 0)
                score, base = np.bincount(text, table[context, y] + own, n), np.bincount(text, logs, n)
                kind = pa.list_(pa.struct([("token", pa.string()), ("n", pa.int64())]))
                rare = [[{"token": w.decode("utf-8", "replace"), "n": k} for w, k in r.items()] for r in lost]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), ids.slice(at, n), pa.array(length), pa.array(np.bincount(text, met, n).astype(np.int64)), pa.array(base), pa.array(score), pa.array(rare, kind)],
                    ["row", "doc_id", "n_tokens", "known", "base", "score", "rare"],
                )
                row += n

    rows = stored(docs.mapInArrow(run, "row long, doc_id long, n_tokens long, known long, base double, score double, rare array<struct<token:string,n:bigint>>"), "lm-rows")
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.token", F.col("r.n").alias("k"))
    found = rare.join(counts, "token").groupBy("row").agg(F.sum(F.col("k") * F.log10(F.col("n") + 1)).alias("more"), F.sum("k").alias("met"))
    out = rows.drop("rare").join(found, "row", "left").withColumns({"more": F.coalesce("more", F.lit(0.0)), "met": F.coalesce("met", F.lit(0))})
    return out.select(
        "doc_id", (~training_part(F.col("doc_id"), parts, held_out)).alias("held_out"), "n_tokens", (F.col("known") + F.col("met")).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.col("more") - F.col("n_tokens") * log_n).alias("base_score"), (F.col("score") + F.col("more")).alias("score"),
    )
