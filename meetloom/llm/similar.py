"""One document of each group of near copies: ball hashing finds candidates, exact similarity of word shingles decides.

Two texts are near copies if the sets of their SHINGLE-word shingles have a Jaccard similarity of LIKE or
more. At 0.8 their SimHash bits differ with a probability of at most APART (the angle between sets of equal
size), so some ten of 64 bits do, too many for a ball around a whole fingerprint. So the operator's ball
hashing runs inside bands: a fingerprint has 128 bits here, a band takes some of them, and in each band every
fingerprint emits all variants within HALF bits. Fingerprints that share a variant of a band meet; those lie
within 2 * HALF bits of each other in it. A band is wide enough to keep the number of strangers that meet
bounded, and there are as many bands as leave at most MISSED of the pairs at exactly LIKE without a meeting.
As in simhash, a variant is shipped by its leading bits and enumerated where it arrives.

What meets is verified in two steps: fingerprints within RADIUS bits become candidates, and candidates are
compared set with set; only pairs that pass are linked, and components are those of simhash. In a bucket of fingerprints
that share a variant, each meets its ALL_PAIRS - 1 followers, which is all in a bucket of that size. Of a band's pairs only
the closest that connect the same fingerprints, a minimum spanning forest, become candidates: a dense group of m texts gives
at most m - 1 a band, never all pairs. Everything works on distinct shingle sets: exact copies are one of them.

Bands, buckets and forests leave links out, so an exact step follows that finds every link between two of the components
so far. A set of n shingles has a head: its floor((1 - LIKE) n) + 1 first shingles in an order that all sets share. Two sets
at LIKE or more have their first common shingle in both heads, so heads are shuffled by shingle, and all members of a
bucket are compared there that differ in component and that sizes, places in the heads and a few coarse counts of hashes allow
to reach LIKE; no bucket has a cap. What leaves the bucket is no pair but a visit: the set of the smaller component goes to the
block of the other's component (components are cut into blocks of some BLOCK sets), so a group of m sets costs a visitor m / BLOCK
rows. In a block each visitor is compared with all sets, by bins and then set with set, and gives one link at most.
The order puts shingles first that are rare in a part of the corpus, so a common line is in a head only where a text has
little else; which part that is affects the speed, never the result. Texts are read again only for sets that have a
candidate.

Null, empty and wordless texts have the empty set and are copies of each other. Null ids lose against others.
Repeated rows are copies; columns of docs are returned unchanged, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meetloom.llm import simhash
from meetloom.llm.common import each_text, lower_words, saved, small_batches, stored, text_slices, text_udf, unclashing

SHINGLE, LIKE, SEED = 5, 0.8, 42
BITS, RADIUS, MISSED, HALF = 128, 34, 0.005, 1
#: Sets by which common shingles are told (or one of ORDER_SHARE, if more), their least count there, and how many are told at most.
ORDER_SETS, ORDER_SHARE, COMMON, MOST_COMMON = 4096, 16, 3, 1 << 18
#: Hashes that a bin of a set holds on average, at most.
PER_BIN = 4
#: Bins of all hashes that go with a head, and the count from which they say nothing.
COARSE, OVER = 16, 255
#: Sets of a component that a visitor meets at once, and visitors that meet them in one task; bits that number a component's blocks.
BLOCK, GUESTS, PART_BITS = 256, 4096, 24
APART = math.acos(2 * LIKE / (1 + LIKE)) / math.pi
ALL_PAIRS = 48
#: Fingerprints of other texts that share a variant of a band with one, on average, at most.
STRANGERS = 32
#: Fingerprints a key has on average before its neighbours come to it; fingerprints whose variants are enumerated at once.
PER_KEY, AT_ONCE = 1 << 18, 1 << 15


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; a shorter text is one shingle, one without words none."""
    words = lower_words(text)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    last = np.cumsum(size + 1) - 1
    begin = (last - size).tolist()
    end = last[SHINGLE - 1 :].tolist() or [len(joined)] * bool(words)
    return np.unique(np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begin, end, strict=False)], np.uint64))


def key_of(held: np.ndarray) -> int:
    """A signed number for a shingle set."""
    return int(np.uint64(xxhash.xxh64_intdigest(held.tobytes(), SEED)).astype(np.int64)) if len(held) else 0


def sketch(held: np.ndarray) -> np.ndarray:
    """BITS bits as two numbers: a bit is set if over half of the shingles' hashes have it."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(held), 4096):
        h = held[at : at + 4096]
        with np.errstate(over="ignore"):
            g = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            g = (g ^ (g >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            g ^= g >> np.uint64(32)
        ones += np.unpackbits(np.stack([h, g], 1).astype("<u8").view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(ones * 2 > max(1, len(held)), bitorder="little").view("<u8").view(np.int64)


def bands(documents: int) -> list[np.ndarray]:
    """The bits of each band; runs of one shuffled order share none. More documents take wider bands, and so more of them."""
    width = 12
    while width < 48 and documents * sum(math.comb(width, r) for r in range(2 * HALF + 1)) > STRANGERS << width:
        width += 1
    meet = sum(math.comb(width, r) * APART**r * (1 - APART) ** (width - r) for r in range(2 * HALF + 1))
    count = math.ceil(math.log(MISSED) / math.log(1 - meet))
    rng, out = np.random.default_rng(SEED), []
    while len(out) < count:
        order = rng.permutation(BITS)
        out += [order[at : at + width] for at in range(0, BITS - width + 1, width)]
    return out[:count]


def band_value(hi: np.ndarray, lo: np.ndarray, band: np.ndarray) -> np.ndarray:
    """The bits of one band as a number."""
    bits = np.unpackbits(np.stack([lo, hi], 1).astype("<i8").view(np.uint8), axis=1, bitorder="little")
    return bits[:, band].astype(np.int64) @ (1 << np.arange(len(band)))


def common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several sets of a part of the corpus have, sorted, and their counts. They say in what order heads are made, nothing else."""
    text = docs["text"].cast("string")
    share = max(ORDER_SETS, (n := docs.count()) // ORDER_SHARE) / max(1, n)
    some = docs.where(F.pmod(F.xxhash64(text), F.lit(1 << 20)) < int(share * (1 << 20))) if share < 1 else docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, texts in text_slices(b.column(0)):
                held = list(map(shingles, texts))
                yield pa.RecordBatch.from_arrays([pa.array([key_of(s) for s in held], pa.int64()), pa.array([s.view(np.int64) for s in held], pa.list_(pa.int64()))], ["fp", "held"])

    each = some.select(text.alias("text")).mapInArrow(run, "fp long, held array<long>").dropDuplicates(["fp"]).select(F.explode("held").alias("h"))
    counts = each.groupBy("h").count().where(F.col("count") >= COMMON).orderBy(F.desc("count"), "h").limit(MOST_COMMON).toArrow()
    h, count = counts.column("h").to_numpy().view(np.uint64), counts.column("count").to_numpy()
    order = np.argsort(h)
    return h[order], count[order]


def head(held: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first shingles of a set, as many as must hold one of any near copy's: those that are not common, then the others from the rarest on; ties by hash."""
    size = len(held) - math.ceil(LIKE * len(held) - 1e-9) + 1 if len(held) else 0
    names, counts = common
    if not len(names):
        return held[:size]
    at = np.minimum(np.searchsorted(names, held), len(names) - 1)
    count = np.where(names[at] == held, counts[at], 0)
    return held[np.argsort(count, kind="stable")[:size]]


def bins(held: np.ndarray) -> np.ndarray:
    """How many of a set's hashes begin with which bits; larger sets have more bins."""
    bits = max(3, (len(held) // PER_BIN).bit_length())
    return np.minimum(np.bincount((held >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8)


def may_share(x: bytes, y: bytes, need: float) -> bool:
    """Whether sets with these bins can share as many hashes as needed: in each bin at most as many as the one with fewer has there."""
    few, many = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    if max(few.max(), many.max()) == 255:  # or more
        return True
    return np.minimum(few, many.reshape(len(few), -1).sum(1)).sum() >= need - 1e-6


def prints_of(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the set's key), hi, lo, n (its size), bins, head, coarse of every row, computed once."""
    small_batches(docs.sparkSession)
    common = common_shingles(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(key_of(s), *sketch(s).tolist(), len(s), bins(s).tobytes(), head(s, common).tobytes(), coarse(s)) for s in map(shingles, each_text(b.column(1)))]
            fp, lo, hi, n, counts, *more = zip(*found, strict=True) if found else [()] * 7
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (fp, hi, lo, n)), *(pa.array(x, pa.binary()) for x in (counts, *more))], ["doc_id", "fp", "hi", "lo", "n", "bins", "head", "coarse"])

    return saved(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long, hi long, lo long, n long, bins binary, head binary, coarse binary"))


def _apart(rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    # As unsigned numbers: of signed ones, bitwise_count counts the absolute value's bits.
    return sum(np.bitwise_count((rows[c][i] ^ rows[c][j]).view(np.uint64)).astype(np.int64) for c in ("hi", "lo"))


def _near(rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return _apart(rows, i, j) <= RADIUS


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the links a-b among members 0..n-1 make up the spanning forest that prefers links earlier in order (Boruvka's rounds)."""
    chosen, live, root = np.zeros(len(a), bool), np.arange(len(a)), np.arange(n)
    while len(live):
        best = np.full(n, len(a))
        np.minimum.at(best, root[a[live]], live)
        np.minimum.at(best, root[b[live]], live)
        chosen[best[best < len(a)]] = True
        root = simhash._roots(n, a[chosen], b[chosen])
        live = live[root[a[live]] != root[b[live]]]
    return chosen


def closest(rows: dict[str, np.ndarray], pairs: Iterator[tuple[np.ndarray, np.ndarray]], kept: int = 1 << 20) -> np.ndarray:
    """The minimum spanning forest of pairs by bits apart, as an array (pairs, 2) of indices; folded whenever more than `kept` pairs wait."""
    n, held, waiting = len(rows["fp"]), np.empty((0, 2), np.int64), []

    def folded() -> np.ndarray:
        all_pairs = np.unique(np.concatenate([held, *waiting]), axis=0)
        i, j = all_pairs.T
        order = np.lexsort((rows["fp"][i] ^ rows["fp"][j] ^ rows["key"][i], _apart(rows, i, j)))
        return all_pairs[order][forest(n, i[order], j[order])]

    for i, j in pairs:
        if len(i):
            waiting.append(np.stack([np.minimum(i, j), np.maximum(i, j)], 1))
            if sum(map(len, waiting)) > kept:
                held, waiting = folded(), []
    return folded()


def within(bucket: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of members of one bucket that lie at most `reach` places apart; bucket is sorted."""
    for d in range(1, min(reach + 1, len(bucket))):
        at = np.flatnonzero(bucket[d:] == bucket[:-d])
        if not len(at):
            return
        yield at, at + d


def bucket_pairs(rows: dict[str, np.ndarray], who: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Near pairs of members of buckets and their followers there: who[k] (an index into rows) lies in bucket[k]; sorted by bucket, then who. A pair that lies further apart is left to missed()."""
    for x, y in within(bucket, ALL_PAIRS - 1):
        near = _near(rows, who[x], who[y])
        yield who[x[near]], who[y[near]]


def met(rows: dict[str, np.ndarray], width: int, known: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (band value, spent flips, hi, lo) of one band and one prefix of `known` bits whose balls share a variant."""
    low = width - known
    rest = rows["value"] & ((1 << low) - 1)
    whos, values = [], []
    for spent in range(HALF + 1):
        some = np.flatnonzero(rows["spent"] == spent)
        masks = simhash.ball(low, HALF - spent).view(np.int64)
        whos.append(np.repeat(some, len(masks)))
        values.append((rest[some][:, None] ^ masks[None, :]).ravel())
    who, value = np.concatenate(whos), np.concatenate(values)
    order = np.lexsort((who, value))
    yield from bucket_pairs(rows, who[order], value[order])


def candidates(sets: DataFrame) -> DataFrame:
    """sets: distinct fp with hi, lo. Pairs (a, b), a > b, whose fingerprints share a variant of a band and lie within RADIUS."""
    n = sets.count()
    cut = bands(n)
    width = len(cut[0])
    known = min(width - 4, max(0, (n // PER_KEY).bit_length()))
    flips = simhash.ball(known, HALF).view(np.int64) << (width - known)
    spends = np.bitwise_count(flips.view(np.uint64)).astype(np.int8)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                b = whole.slice(at, 2048)
                hi, lo = b.column(1).to_numpy(), b.column(2).to_numpy()
                value = np.stack([band_value(hi, lo, band) for band in cut], 1)  # (rows, bands)
                key = ((value[:, :, None] ^ flips) >> (width - known)) | (np.arange(len(cut)) << known)[None, :, None]
                row = pa.array(np.repeat(np.arange(len(hi)), len(cut) * len(flips)))
                shipped = np.tile(spends, len(hi) * len(cut))
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(shipped), *(b.column(i).take(row) for i in range(3))], ["key", "spent", "fp", "hi", "lo"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_keys(batches):
            band = cut[int(rows["key"][0]) >> known]
            rows["value"] = np.concatenate([band_value(rows["hi"][at : at + 8192], rows["lo"][at : at + 8192], band) for at in range(0, len(rows["hi"]), 8192)])
            for part in _parts(rows, width - known):
                here = {c: v[part] for c, v in rows.items()}
                pairs = here["fp"][closest(here, met(here, width, known))]
                if len(pairs):
                    yield pa.RecordBatch.from_arrays([pa.array(pairs.max(1)), pa.array(pairs.min(1))], ["a", "b"])

    dealt = sets.select("fp", "hi", "lo").mapInArrow(deal, "key long, spent byte, fp long, hi long, lo long")
    return saved(dealt.repartition("key").sortWithinPartitions("key", "fp", "spent").mapInArrow(meet, "a long, b long").distinct())


def _parts(rows: dict[str, np.ndarray], low: int) -> Iterator[np.ndarray]:
    """Rows of one key, cut on further bits of the value where they are more than AT_ONCE. A row goes to each part that a flip still allowed can bring it to."""
    n = len(rows["value"])
    cuts = min(low, max(0, math.ceil(math.log2(max(1, n) / AT_ONCE))))
    if not cuts:
        yield np.arange(n)
        return
    top = rows["value"] >> (low - cuts) & (1 << cuts) - 1
    for part in range(1 << cuts):
        yield np.flatnonzero(np.bitwise_count((top ^ part).view(np.uint64)) <= HALF - rows["spent"])


def whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Sorted batches cut into the columns of each key."""
    held: list[pa.RecordBatch] = []

    def columns() -> dict[str, np.ndarray]:
        table = pa.Table.from_batches(held)
        return {c: table.column(c).to_numpy() for c in table.column_names}

    for b in batches:
        if not b.num_rows:
            continue
        key = b.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for x, y in zip(cuts, cuts[1:], strict=False):
            if held and held[-1].column(0)[0].as_py() != key[x]:
                yield columns()
                held = []
            held.append(b.slice(x, y - x))
    if held:
        yield columns()


def whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Sorted batches as columns in which no key is cut; rows alone with their key are left out."""
    held: list[pa.RecordBatch] = []

    def columns() -> dict[str, np.ndarray]:
        table = pa.Table.from_batches(held)
        key = table.column(0).to_numpy()
        same = key[1:] == key[:-1]
        some = np.flatnonzero(np.r_[False, same] | np.r_[same, False])
        return {c: table.column(c).to_numpy()[some] for c in table.column_names}

    for b in batches:
        if not b.num_rows:
            continue
        key = b.column(0).to_numpy()
        if held and held[-1].column(0)[-1].as_py() == key[-1]:
            held.append(b)
            continue
        cut = int(np.searchsorted(key, key[-1]))
        held.append(b.slice(0, cut))
        yield columns()
        held = [b.slice(cut)]
    if held:
        yield columns()


def coarse(held: np.ndarray) -> bytes:
    """COARSE counts of a set's hashes by their first bits; all OVER if one has OVER or more."""
    count = np.bincount((held >> np.uint64(64 - COARSE.bit_length() + 1)).astype(np.int64), minlength=COARSE)
    return (count if count.max() < OVER else np.full(COARSE, OVER)).astype(np.uint8).tobytes()


def allowed(rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether members i (or one member) and j of a bucket differ in component and can be alike, if the bucket's shingle is the first that they share."""
    need = LIKE / (1 + LIKE) * (rows["n"][i] + rows["n"][j]) - 1e-6
    can = (rows["root"][i] != rows["root"][j]) & (np.minimum(rows["n"][i] - rows["at"][i], rows["n"][j] - rows["at"][j]) >= need)
    if can.any():
        share = np.minimum(rows["coarse"][np.broadcast_to(i, can.shape)[can]], rows["coarse"][j[can]]).sum(1)
        can[can] = (share >= need[can]) | (share == COARSE * OVER)
    return can


def paired(rows: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All allowed pairs of members of buckets (rows sorted by key)."""
    start = np.flatnonzero(np.r_[True, rows["key"][1:] != rows["key"][:-1]])
    size = np.diff(np.r_[start, len(rows["key"])])
    small = np.flatnonzero(np.repeat(size <= ALL_PAIRS, size))
    for x, y in within(rows["key"][small], ALL_PAIRS - 1):
        i, j = small[x], small[y]
        can = allowed(rows, i, j)
        yield i[can], j[can]
    for at, n in zip(start[size > ALL_PAIRS].tolist(), size[size > ALL_PAIRS].tolist(), strict=True):
        if (rows["root"][at : at + n] == rows["root"][at]).all():
            continue
        members = at + np.argsort(rows["n"][at : at + n], kind="stable")
        # In order of size, those a member can be alike with end where LIKE of the size is over its own.
        ends = np.searchsorted(rows["n"][members] * LIKE - 1e-6, rows["n"][members], "right").tolist()
        for k, end in enumerate(ends):
            others = members[k + 1 : end]
            others = others[allowed(rows, members[k], others)]
            yield np.full(len(others), members[k]), others


def visits_of(rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Pairs i, j as rows (fp, root, part): the one of the smaller component visits the other's block."""
    size = rows["of"] >> PART_BITS
    back = (size[i] > size[j]) | (size[i] == size[j]) & (rows["root"][i] > rows["root"][j])
    guest, host = np.where(back, j, i), np.where(back, i, j)
    return np.stack([rows["fp"][guest], rows["root"][host], rows["of"][host] & (1 << PART_BITS) - 1], 1)


def in_blocks(roots: DataFrame) -> DataFrame:
    """roots (node, root) -> fp, root, size (of the component), part (of it, with BLOCK sets on average at most), roots themselves included."""
    size = roots.groupBy("root").agg((F.count(F.lit(1)) + 1).alias("size"))
    nodes = roots.select(F.col("node").alias("fp"), "root").union(size.select("root", "root")).join(size, "root")
    return saved(nodes.select("fp", "root", "size", F.expr(f"pmod(fp, ceil(size / {BLOCK}))").cast("long").alias("part")))


def missed(prints: DataFrame, sets: DataFrame, blocks: DataFrame) -> DataFrame:
    """prints (doc_id, fp, n, head, coarse); sets: distinct fp with least; blocks: in_blocks of what is linked. Visits (fp, root, part): for all near copies of two components, one's visit to the other's block is among them."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                fp, root, of, n = (b.column(i).to_numpy() for i in range(4))
                low, high = np.frombuffer(b"".join(b.column(5).to_pylist()), np.int64).reshape(-1, 2).T
                heads = [np.frombuffer(x, np.int64) for x in b.column(4).to_pylist()]
                size = np.array(list(map(len, heads)))
                row = np.repeat(np.arange(len(heads)), size)
                place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.concatenate(heads), fp[row], root[row], of[row], n[row] << 32 | place, low[row], high[row])], ["key", "fp", "root", "of", "n_at", "low", "high"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        waiting, most = 0, 1 << 18

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop().T], ["fp", "root", "part"])

        for rows in whole_buckets(batches):
            rows |= {"root": np.where(rows["root"] == 0, rows["fp"], rows["root"]), "n": rows["n_at"] >> 32, "at": rows["n_at"] & 0xFFFFFFFF}
            rows["coarse"] = np.stack([rows["low"], rows["high"]], 1).view(np.uint8)
            for i, j in paired(rows):
                if len(i):
                    held.append(visits_of(rows, i, j))
                    waiting += len(i)
                    if waiting > most or len(held) > 4096:
                        held = [np.unique(np.concatenate(held), axis=0)]
                        waiting = len(held[0])
                        if waiting > most // 2:
                            yield out()
                            waiting = 0
        if held:
            held = [np.unique(np.concatenate(held), axis=0)]
            yield out()

    # One row of a set goes on; rows equal in id and set may both do, since members of one component are never paired.
    copies = prints.select("doc_id", "fp").join(sets.select("fp", "least"), "fp").where(~F.col("doc_id").eqNullSafe(F.col("least")))
    copies = hinted(saved(copies.select(F.col("doc_id").alias("c_id"), F.col("fp").alias("c_fp")).distinct()))
    one_each = prints.where("n > 0").join(copies, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("fp") == F.col("c_fp")), "left_anti")
    of = blocks.select("fp", "root", F.expr(f"shiftleft(size, {PART_BITS}) + part").alias("of"))
    linked = one_each.select("fp", "n", "head", "coarse").join(hinted(of), "fp", "left")
    # No root is 0: that is the key of the empty set, which has no head.
    dealt = linked.select("fp", F.coalesce("root", F.lit(0)).alias("root"), F.coalesce("of", F.lit(1 << PART_BITS)).alias("of"), "n", "head", "coarse").mapInArrow(deal, "key long, fp long, root long, of long, n_at long, low long, high long")
    return saved(dealt.repartition("key").sortWithinPartitions("key").mapInArrow(meet, "fp long, root long, part long").distinct())


def hinted(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= simhash.BROADCAST_KEYS else df


class Bins:
    """Sets of a block by their sizes and bins."""

    def __init__(self, sizes: np.ndarray, bins_: list[bytes]):
        self.by_length = {}
        length = np.array(list(map(len, bins_)))
        for x in np.unique(length).tolist():
            at = np.flatnonzero(length == x)
            self.by_length[x] = at, sizes[at], np.frombuffer(b"".join(bins_[i] for i in at), np.uint8).reshape(len(at), x)

    def passing(self, n: int, its: bytes) -> np.ndarray:
        """Which sets may be alike with one (its size, its bins): may_share and the sizes say so."""
        mine, found = np.frombuffer(its, np.uint8), []
        for length, (at, sizes, theirs) in self.by_length.items():
            few = min(length, len(mine))
            share = np.minimum(mine.reshape(few, -1).sum(1), theirs.reshape(len(at), few, -1).sum(2)).sum(1)
            can = (share >= LIKE / (1 + LIKE) * (n + sizes) - 1e-6) | (theirs.max(1) == 255) | (mine.max() == 255)
            found.append(at[can & (np.minimum(n, sizes) >= LIKE * np.maximum(n, sizes))])
        return np.concatenate(found)


class Sets:
    """Shingle sets of a block, with the places of each shingle."""

    def __init__(self, sizes: np.ndarray, held: list[bytes]):
        every, self.sizes = np.frombuffer(b"".join(held), np.uint64), sizes
        order = np.argsort(every, kind="stable")
        self.every, self.whose = every[order], np.repeat(np.arange(len(sizes)), sizes)[order]

    def passing(self, n: int, its: bytes) -> np.ndarray:
        """Which sets are near copies of one."""
        mine = np.frombuffer(its, np.uint64)
        first = np.searchsorted(self.every, mine)
        count = np.searchsorted(self.every, mine, "right") - first
        place = np.arange(count.sum()) + np.repeat(first - np.cumsum(count) + count, count)
        both = np.bincount(self.whose[place], minlength=len(self.sizes))
        return np.flatnonzero(both >= LIKE * (n + self.sizes - both))


def over_blocks(rows: DataFrame, kind: type[Bins] | type[Sets], all_of_them: bool) -> DataFrame:
    """rows (root, part, turn, guest, fp, n, what): in each block and turn, guests are compared with all hosts, the rows that are no guests.
    Of each guest that passes with a host: itself and all hosts that pass with a guest (guest, fp, root, part), or its link to one host (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hosts, block, hit = None, [], None, np.empty(0, bool)

        def ended() -> list[tuple]:
            return [(False, hosts[i][0], *now[:2]) for i in np.flatnonzero(hit).tolist()] if all_of_them else []

        for b in batches:
            out = []
            for root, part, turn, guest, fp, n, what in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now != (root, part, turn):
                    out += ended()
                    now, hosts, block, hit = (root, part, turn), [], None, np.empty(0, bool)
                if not guest:
                    hosts.append((fp, n, what))
                    continue
                if block is None:
                    block, hit = kind(np.array([h[1] for h in hosts]), [h[2] for h in hosts]), np.zeros(len(hosts), bool)
                passed = block.passing(n, what)
                if len(passed):
                    hit[passed] = True
                    other = hosts[passed[0]][0]
                    out.append((True, fp, root, part) if all_of_them else (max(fp, other), min(fp, other)))
            if out:
                yield made(out)
        if out := ended():
            yield made(out)

    def made(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names)

    names, schema = (["guest", "fp", "root", "part"], "guest boolean, fp long, root long, part long") if all_of_them else (["a", "b"], "a long, b long")
    dealt = rows.select("root", "part", "turn", "guest", "fp", "n", "what").repartition("root", "part", "turn")
    return dealt.sortWithinPartitions("root", "part", "turn", "guest").mapInArrow(run, schema)


def in_turns(rows: DataFrame) -> DataFrame:
    """rows (guest, fp, root, part) with turns: a block with more than GUESTS guests has several, and its hosts are in each."""
    turns = rows.where("guest").groupBy("root", "part").agg(F.ceil(F.count(F.lit(1)) / GUESTS).alias("turns"))
    each = rows.join(turns, ["root", "part"])
    turn = F.when(F.col("guest"), F.array(F.expr("pmod(fp, turns)").cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1))
    return each.select("root", "part", "guest", "fp", F.explode(turn).alias("turn"))


def missed_links(docs: DataFrame, sets: DataFrame, blocks: DataFrame, visits: DataFrame) -> DataFrame:
    """Of each visit, one link of the visitor to a near copy in the block, if there is one."""
    visited = visits.select("root", "part").distinct()
    linked = blocks.select("fp", "root", "part")
    alone = visited.join(linked.select("root").distinct(), "root", "left_anti").select(F.col("root").alias("fp"), "root", "part")
    hosts = linked.join(visited, ["root", "part"], "left_semi").select("fp", "root", "part").union(alone)
    rows = hosts.select(F.lit(False).alias("guest"), "fp", "root", "part").union(visits.select(F.lit(True), "fp", "root", "part"))
    left = saved(over_blocks(in_turns(rows).join(sets.select("fp", "n", F.col("bins").alias("what")), "fp"), Bins, True).distinct())
    held = sets_of(docs, sets, left)
    return over_blocks(in_turns(left).join(held.select("fp", F.expr("length(held) div 8").alias("n"), F.col("held").alias("what")), "fp"), Sets, False)


def alike(a: bytes, b: bytes) -> bool:
    """Whether two shingle sets (as bytes) are near copies."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if min(len(x), len(y)) < LIKE * max(len(x), len(y)):
        return False
    both = len(x) + len(y) - len(np.union1d(x, y))
    return both >= LIKE * (len(x) + len(y) - both)


def near_links(docs: DataFrame, prints: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b), a > b, of keys whose shingle sets are near copies; they connect all that are. sets: distinct fp of prints with least, hi, lo, n, bins."""
    found = saved(verified(docs, sets, candidates(sets)))
    blocks = in_blocks(simhash.components(found))
    return found.union(missed_links(docs, sets, blocks, missed(prints, sets, blocks)))


def sets_of(docs: DataFrame, sets: DataFrame, some: DataFrame) -> DataFrame:
    """fp, held (the set's hashes) of the keys fp in some. Only texts with their least ids are read again."""
    nodes = saved(some.select("fp").distinct().join(sets.select("fp", "least"), "fp"))
    (wanted,) = unclashing(["m_id"], docs.columns)
    ids = nodes.select(F.col("least").alias(wanted)).distinct()
    if nodes.count() <= simhash.BROADCAST_KEYS:
        ids = F.broadcast(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, texts in text_slices(b.column(0)):
                held = list(map(shingles, texts))
                yield pa.RecordBatch.from_arrays([pa.array([key_of(s) for s in held], pa.int64()), pa.array([s.tobytes() for s in held], pa.binary())], ["fp", "held"])

    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    read = texts.join(ids, texts["doc_id"].eqNullSafe(F.col(wanted)), "left_semi").select("text").mapInArrow(run, "fp long, held binary")
    return stored(read.join(nodes.select("fp"), "fp", "left_semi").dropDuplicates(["fp"]), "near-sets")


def verified(docs: DataFrame, sets: DataFrame, candidates: DataFrame) -> DataFrame:
    """Those of the candidates (a, b) whose shingle sets are near copies."""
    size = sets.select("fp", "n", "bins")
    met_pairs = candidates.join(size.toDF("a", "n_a", "bins_a"), "a").join(size.toDF("b", "n_b", "bins_b"), "b")
    sized = met_pairs.where(F.least("n_a", "n_b") >= LIKE * F.greatest("n_a", "n_b"))

    @F.arrow_udf("boolean")
    def can_pass(x: pa.Array, y: pa.Array, need: pa.Array) -> pa.Array:
        return pa.array([may_share(*each) for each in zip(x.to_pylist(), y.to_pylist(), need.to_pylist(), strict=True)], pa.bool_())

    pairs = saved(sized.where(can_pass("bins_a", "bins_b", (F.col("n_a") + F.col("n_b")) * (LIKE / (1 + LIKE)))).select("a", "b"))
    held = sets_of(docs, sets, pairs.select(F.col("a").alias("fp")).union(pairs.select("b")))

    @F.arrow_udf("boolean")
    def pass_(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([alike(a.as_py(), b.as_py()) for a, b in zip(x, y, strict=True)], pa.bool_())

    both = pairs.join(held.toDF("a", "x"), "a").join(held.toDF("b", "y"), "b")
    return both.where(pass_("x", "y")).select("a", "b")


def key_column():
    """An Arrow UDF of the text column: the key of its shingle set."""
    return text_udf("long", lambda found: pa.array(found, pa.int64()), lambda: lambda t: key_of(shingles(t)))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of docs of each group of near copies, columns unchanged; which one is said at simhash.keep_first."""
    prints = prints_of(docs)
    sets = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.min("hi").alias("hi"), F.min("lo").alias("lo"), F.min("n").alias("n"), F.first("bins").alias("bins")))
    roots = simhash.components(near_links(docs, prints, sets))
    rooted = sets.select("fp").join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return simhash.keep_first(docs, prints.select("doc_id", "fp"), rooted, key_column())
