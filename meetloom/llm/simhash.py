"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within RADIUS bits of each other share a variant that lies within half
the radius of both. So every distinct fingerprint emits all variants of its half-radius
ball; variants are shuffled, equal ones meet, and the fingerprints that meet are verified.

A ball has 2,081 variants, too many to ship one by one. A variant is shipped as its
leading bits (the shuffle key) with the fingerprint and the flips already spent; the task that
receives a prefix enumerates the variants of its fingerprints inside that prefix, sorts
them, and links each to the first of its equals. Links found in a prefix are reduced to a
spanning forest there, so a dense group emits at most one link per member and prefix, never all pairs.
Components then come from alternating large-star and small-star steps over the links, each
step saved in the shared checkpoint folder. All of it works on distinct fingerprints: a
group of exact copies is one of them. A prefix that more than HOT_PREFIX fingerprints
reach is dealt once more by SUB_BITS further bits, with the flips that are left, so a
dense group's work is spread over tasks.

Null text counts as empty and has fingerprint zero, linked like any other. Null ids never
name a component unless all of its ids are null. Repeated rows give repeated results; other
columns are ignored. Whole texts are shingled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meetloom.llm.common import lower_words, saved, small_batches, text_udf, unclashing

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Fingerprints a prefix has on average before its neighbours come to it; variants that are sorted at once.
PER_PREFIX, AT_ONCE = 64, 4_000_000
HOT_PREFIX, SUB_BITS = 1_000_000, 10
BROADCAST_KEYS = 500_000


def simhash(text: str | None, words_each: int = SHINGLE) -> int:
    """64 bits, unsigned: a bit is set if over half of the shingles' hashes have it."""
    words = lower_words(text)
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - words_each + 1)
    size = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(size + 1) - size - 1
    last = start + size
    begin, end = start[:n].tolist(), last[-n:].tolist() if len(words) >= words_each else [len(joined)]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(begin, end, strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 4096):  # bits of a few thousand hashes at a time
        ones += np.unpackbits(h[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int((ones * 2 > n).astype(object) @ (1 << np.arange(64, dtype=object)))


def fingerprint_column(words_each: int = SHINGLE):
    """An Arrow UDF of the text column: the fingerprint as a signed 64-bit number."""
    return text_udf("long", lambda found: pa.array(np.array(found, np.uint64).view(np.int64)), lambda: lambda t: simhash(t, words_each))


def ball(bits: int, radius: int) -> np.ndarray:
    """All masks of so many bits with at most radius of them set."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)], np.uint64)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each member's component, members 0..n-1 with links a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(root, up := root[root]):  # to the end each time: what is no root must not be hooked, or it leaves its own
            root = up
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def _meetings(values: np.ndarray, budget: np.ndarray, who: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between members whose balls (radius budget, in the low bits of values) share a variant; large inputs are split on further leading bits."""
    total = sum(int((budget == r).sum()) * len(ball(bits, r)) for r in range(int(budget.max(initial=0)) + 1))
    if total > AT_ONCE and bits > 8:
        low = bits - 4
        top, rest = values >> np.uint64(low), values & np.uint64((1 << low) - 1)
        tops, rests, budgets, whos = [], [], [], []
        for mask in ball(4, int(budget.max())):
            spent = int(mask).bit_count()
            can = budget >= spent
            tops.append(top[can] ^ mask)
            rests.append(rest[can])
            budgets.append(budget[can] - spent)
            whos.append(who[can])
        tops, rests, budgets, whos = map(np.concatenate, (tops, rests, budgets, whos))
        for t in range(16):
            here = tops == t
            yield from _meetings(rests[here], budgets[here], whos[here], low)
        return
    found, owners = [], []
    for r in range(int(budget.max(initial=0)) + 1):
        some = budget == r
        if some.any():
            masks = ball(bits, r)
            found.append((values[some][:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(who[some], len(masks)))
    if not found:
        return
    found, owners = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(found)
    found, owners = found[order], owners[order]
    same = found[1:] == found[:-1]
    yield owners[:-1][same], owners[1:][same]


def _links_of_prefix(fps: np.ndarray, spent: np.ndarray, prefix_bits: int, radius: int) -> np.ndarray:
    """Index pairs into fps: a spanning forest of the links found in one prefix, every link verified."""
    bits = 64 - prefix_bits
    rest = fps & np.uint64((1 << bits) - 1)
    half, members = radius // 2, np.arange(len(fps))
    root = members
    for a, b in _meetings(rest, half - spent, members, bits):
        near = np.bitwise_count(fps[a] ^ fps[b]) <= radius
        if near.any():  # folded at once, so that meetings are never held together
            child = np.flatnonzero(root != members)
            root = _roots(len(fps), np.concatenate([child, a[near]]), np.concatenate([root[child], b[near]]))
    child = np.flatnonzero(root != members)
    return np.stack([child, root[child]], 1)


def _dealt(rows: DataFrame, key_bits: int, at_bit: int, half: int) -> DataFrame:
    """rows (fp, spent) by the key_bits bits of fp above at_bit, flipped in all ways that `half` still allows: prefix, fp, spent."""
    flips = [(int(m), int(m).bit_count()) for m in ball(key_bits, half)]
    key = F.shiftrightunsigned(F.col("fp"), at_bit).bitwiseAND((1 << key_bits) - 1)
    each = rows.select("*", F.explode(F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(c).cast("byte").alias("flips")) for m, c in flips])).alias("v")).where(F.col("spent") + F.col("v.flips") <= half)
    return each.select(*[c for c in rows.columns if c not in ("fp", "spent")], key.bitwiseXOR(F.col("v.mask")).alias("key"), "fp", (F.col("spent") + F.col("v.flips")).cast("byte").alias("spent"))


def near_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fps: distinct fp. Links (a, b) that connect whatever lies within radius (an even number), a > b as signed numbers."""
    half = radius // 2
    n = fps.count()
    prefix_bits = min(28, max(4, (max(1, n) // PER_PREFIX).bit_length()))
    variants = _dealt(fps.select("fp", F.lit(0).cast("byte").alias("spent")), prefix_bits, 64 - prefix_bits, half).withColumnRenamed("key", "prefix")
    links = _links(variants.withColumn("sub", F.lit(0).cast("long")), prefix_bits, radius)
    if n <= HOT_PREFIX:  # a fingerprint reaches a prefix once, so none is hot
        return links.distinct()
    hot = saved(variants.groupBy("prefix").count().where(F.col("count") > HOT_PREFIX).select("prefix"))  # at most 407 n / HOT_PREFIX rows
    if not hot.limit(1).count():
        return links.distinct()
    cold = variants.join(F.broadcast(hot), "prefix", "left_anti").withColumn("sub", F.lit(0).cast("long"))
    split = _dealt(variants.join(F.broadcast(hot), "prefix"), SUB_BITS, 64 - prefix_bits - SUB_BITS, half).withColumnRenamed("key", "sub")
    return _links(cold, prefix_bits, radius).unionByName(_links(split, prefix_bits + SUB_BITS, radius)).distinct()


def _links(variants: DataFrame, known_bits: int, radius: int) -> DataFrame:
    """variants (prefix, sub, fp, spent): links among those that meet in (prefix, sub), which stand for the leading known_bits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for prefix in _whole_prefixes(batches):
            signed = prefix["fp"].to_numpy(np.int64)
            order = np.argsort(signed, kind="stable")
            signed, spent = signed[order], prefix["spent"].to_numpy(np.int64)[order]
            pairs = _links_of_prefix(signed.view(np.uint64), spent, known_bits, radius)
            if len(pairs):
                yield pd.DataFrame({"a": signed[pairs[:, 0]], "b": signed[pairs[:, 1]]})

    return variants.select("prefix", "sub", "fp", "spent").repartition("prefix", "sub").sortWithinPartitions("prefix", "sub").mapInPandas(run, "a long, b long")


def _whole_prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted batches cut into one frame per (prefix, sub)."""
    held: list[pd.DataFrame] = []
    last = None
    for b in batches:
        if not len(b):
            continue
        prefix, sub = b["prefix"].to_numpy(), b["sub"].to_numpy()
        cuts = [0, *(np.flatnonzero((prefix[1:] != prefix[:-1]) | (sub[1:] != sub[:-1])) + 1).tolist(), len(b)]
        for x, y in zip(cuts, cuts[1:], strict=False):
            if held and last != (prefix[x], sub[x]):
                yield pd.concat(held)
                held = []
            last = prefix[x], sub[x]
            held.append(b.iloc[x:y])
    if held:
        yield pd.concat(held)


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> (node, root): the least node of each linked node's component, by alternating star steps."""
    edges = saved(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = saved(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of a set of links."""
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(r)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, fp for every row, computed once."""
    small_batches(docs.sparkSession)
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return saved(docs.select("doc_id", fingerprint_column()("text").alias("fp")))


def rooted(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """prints (doc_id, fp) -> (fp, root, least): each fingerprint's component and its own least doc_id."""
    fps = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(fps.select("fp"), radius))
    return fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def component_of(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """prints (doc_id, fp) -> (fp, component_id): the least doc_id that each fingerprint reaches."""
    fps = rooted(prints, radius)
    least = fps.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps.join(least, "root").select("fp", "component_id")


def near_duplicate_components(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint, component_id: one row per row of docs."""
    prints = fingerprint_documents(docs)
    return prints.join(component_of(prints, radius), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of docs of each component, columns unchanged."""
    prints = fingerprint_documents(docs)
    return keep_first(docs, prints, rooted(prints, radius).select("fp", "root"), fingerprint_column())


def keep_first(docs: DataFrame, prints: DataFrame, roots: DataFrame, print_of) -> DataFrame:
    """prints (doc_id, fp) of docs, roots (fp, root). One row of each root: the least doc_id's (null ids last), then the least
    fingerprint's, then the least text's; of rows equal in all three, any one. Only keys of rows to drop or repeated are looked
    up, by broadcast if they are at most BROADCAST_KEYS; only rows with such an id are fingerprinted again. Helper columns take
    names that docs has not."""
    i, k, z, odd_id, hit, fp = unclashing(["m_id", "m_key", "m_again", "m_odd", "m_hit", "m_fp"], docs.columns)
    keys = prints.groupBy("doc_id", "fp").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "fp")
    best = keys.join(roots, "fp").groupBy("root").agg(F.min(order).alias("k")).select(F.col("k.doc_id").alias("b_id"), F.col("k.fp").alias("b_fp"))
    judged = keys.join(best, keys["doc_id"].eqNullSafe(best["b_id"]) & (keys["fp"] == best["b_fp"]), "left")
    odd = saved(judged.where("b_fp is null or n > 1").select(F.col("doc_id").alias(i), F.col("fp").alias(k), F.col("b_fp").isNotNull().alias(z)))
    again, ids = odd.where(F.col(z)), odd.select(F.col(i).alias(odd_id), F.lit(True).alias(hit)).distinct()
    repeated = again.limit(1).count() > 0
    if odd.count() <= BROADCAST_KEYS:
        odd, again, ids = F.broadcast(odd), F.broadcast(again), F.broadcast(ids)
    rows = docs.join(ids, docs["doc_id"].cast("long").eqNullSafe(F.col(odd_id)), "left").withColumn(fp, print_of(F.when(F.col(hit), docs["text"].cast("string"))))
    same = rows["doc_id"].cast("long").eqNullSafe(F.col(i)) & (rows[fp] == F.col(k))
    kept = rows.join(odd, same, "left_anti").select(*docs.columns)
    if not repeated:
        return kept
    whole = F.struct(*[F.col(c) for c in docs.columns])
    once = rows.join(again, same, "left_semi").groupBy(F.col("doc_id").cast("long").alias(i), F.col(fp)).agg(F.min_by(whole, F.struct(F.col("text").isNotNull(), F.col("text"))).alias(k))
    return kept.unionByName(once.select(f"{k}.*"))
