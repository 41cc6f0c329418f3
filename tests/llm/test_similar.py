"""Near copies of the pipeline stage against all pairs of shingle sets."""

import random

import corpus_pipeline
import numpy as np

from meetloom.llm import similar
from meetloom.llm.common import lower_words


def _set(text):
    words = lower_words(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def test_stage_drops_copies_that_differ_in_many_bits_and_keeps_others(spark):
    rng, rows, pairs = random.Random(5), [], 0
    for k in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        near, far = list(words), list(words)
        for at in (20, 60, 100, 140):  # 20 of 196 shingles: similarity 0.81
            near[at] = "changed"
        for at in range(10, 190, 25):  # similarity below 0.7
            far[at] = "changed"
        assert _jaccard(_set(" ".join(words)), _set(" ".join(near))) >= 0.8 > 0.75 > _jaccard(_set(" ".join(words)), _set(" ".join(far)))
        rows += [(3 * k, " ".join(words)), (3 * k + 1, " ".join(near))] + ([(3 * k + 2, " ".join(far))] if k % 2 else [])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.keep_one_of_each(spark, docs, "").collect()}
    assert all(3 * k in kept for k in range(60)) and all(3 * k + 2 in kept for k in range(1, 60, 2))
    assert sum(3 * k + 1 not in kept for k in range(60)) >= 58


def test_odd_rows_and_a_group_larger_than_a_full_bucket(spark):
    rows = [(None, "a b c d", 1), (None, "a b c d", 1), (None, "another text altogether", 2), (7, None, 3), (8, "", 4), (9, "A b c d", 5)]
    kept = similar.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string, x int")).collect()
    assert sorted(r["x"] for r in kept) == [2, 3, 5]
    words = [f"w{i}" for i in range(300)]
    many = [(i, " ".join([*words[: i + 1], "other", *words[i + 2 :]])) for i in range(120)]
    assert [r["doc_id"] for r in similar.keep_one_of_each(spark.createDataFrame(many, "doc_id long, text string")).collect()] == [0]
    assert similar.keep_one_of_each(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_shingles_are_those_of_five_words():
    for text in ("", None, "one", "a b c d", "a b c d e", "A b  c d e f\tg", "x " * 50):
        assert len(similar.shingles(text)) == len(_set(text))
    assert similar.key_of(similar.shingles("a b c d e f")) == similar.key_of(np.sort(similar.shingles("A B c d e f")))


def test_splitting_a_key_or_its_rows_loses_no_candidate(spark, monkeypatch):
    rng, rows = np.random.default_rng(2), []
    for _ in range(40):
        base = rng.integers(0, 2, similar.BITS)
        for _ in range(12):
            bits = base.copy()
            bits[rng.choice(similar.BITS, rng.integers(0, 16), replace=False)] ^= 1
            lo, hi = np.packbits(bits.astype(np.uint8), bitorder="little").view("<u8").view(np.int64).tolist()
            rows.append((len(rows), hi, lo))
    sets = spark.createDataFrame(rows, "fp long, hi long, lo long")
    apart = lambda a, b: bin((rows[a][1] ^ rows[b][1]) % 2**64).count("1") + bin((rows[a][2] ^ rows[b][2]) % 2**64).count("1")
    close = [(a, b) for a, *_ in rows for b, *_ in rows if a > b and apart(a, b) <= 19]
    for per_key, at_once in ((1 << 18, 1 << 15), (16, 1 << 15), (1 << 18, 20), (16, 20)):
        monkeypatch.setattr(similar, "PER_KEY", per_key)
        monkeypatch.setattr(similar, "AT_ONCE", at_once)
        got = [tuple(r) for r in similar.candidates(sets).collect()]
        assert all(apart(a, b) <= similar.RADIUS for a, b in got)
        root = similar.simhash._roots(len(rows), *np.array(got).T)
        assert sum(root[a] == root[b] for a, b in close) > 0.99 * len(close) > 0


def test_forest_is_minimal():
    rng = np.random.default_rng(6)
    for _ in range(20):
        a, b = rng.integers(0, 30, (2, 80))
        a, b = a[a != b], b[a != b]
        want, parent = [], list(range(30))

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
            if root(x) != root(y):
                parent[root(x)] = root(y)
                want.append(i)
        assert np.flatnonzero(similar.forest(30, a, b)).tolist() == want


def test_components_of_chains_in_any_order_are_whole_and_their_forest_ends():
    rng = np.random.default_rng(14)
    for n in (2, 9, 60, 300):
        for _ in range(20):
            order = rng.permutation(2 * n)
            a, b = np.r_[order[: n - 1], order[n:-1]], np.r_[order[1:n], order[n + 1 :]]
            want = np.empty(2 * n, np.int64)
            want[order[:n]], want[order[n:]] = order[:n].min(), order[n:].min()
            assert np.array_equal(similar.simhash._roots(2 * n, a, b), want)
            assert similar.forest(2 * n, a, b).all()  # after the line above, since it would not end


def test_a_dense_group_gives_few_candidates_and_one_document(spark):
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for i in range(600):
        mine = list(words)
        for at in rng.choice(400, 4, replace=False):
            mine[at] = f"x{i}"
        texts.append((i, " ".join(mine)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    prints = similar.prints_of(docs)
    assert similar.candidates(prints.select("fp", "hi", "lo")).count() < 12 * 600
    assert [r["doc_id"] for r in similar.keep_one_of_each(docs).collect()] == [0]


def test_no_link_is_lost_though_bands_find_none(spark, monkeypatch):
    rng, rows = random.Random(11), []
    line = [f"common{i}" for i in range(30)]
    for k in range(70):  # over ALL_PAIRS sets share the line
        words = [f"w{rng.randrange(9000)}" for _ in range(170)] + line
        near, longer, far = list(words), [f"v{rng.randrange(9000)}" for _ in range(40)] + words, list(words)
        for at in (20, 60, 100, 140):
            near[at] = "changed"
        for at in range(5, 165, 20):
            far[at] = "other"
        rows += [(4 * k, " ".join(words)), (4 * k + 1, " ".join(near)), (4 * k + 2, " ".join(longer)), (4 * k + 3, " ".join(far))]
    sets = {i: _set(t) for i, t in rows}
    want = {(a, b) for a in sets for b in sets if a > b and _jaccard(sets[a], sets[b]) >= 0.8}
    assert {(4 * k + 1, 4 * k) for k in range(70)} | {(4 * k + 2, 4 * k) for k in range(70)} <= want
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(similar, "candidates", lambda sets: sets.select("fp", "fp").toDF("a", "b").limit(0))
    monkeypatch.setattr(similar, "ORDER_SETS", 64)
    root = similar.simhash._roots(len(rows), *np.array(sorted(want)).T)
    assert {r["doc_id"] for r in similar.keep_one_of_each(docs).collect()} == set(root.tolist())


def test_bounds_keep_all_near_copies():
    rng = np.random.default_rng(12)
    for n in (1, 4, 5, 9, 40, 300, 3000):
        x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        for _ in range(20):
            y = np.unique(np.r_[rng.permutation(x)[: -max(0, len(x) // 9) or None], rng.integers(0, 2**63, max(0, n // 9), dtype=np.uint64)])
            both = len(np.intersect1d(x, y))
            assert similar.may_share(similar.bins(x).tobytes(), similar.bins(y).tobytes(), both)
            if both >= 0.8 * (len(x) + len(y) - both):
                common = np.sort(rng.permutation(x)[: n // 2]), np.arange(n // 2) % 7 + 3
                assert len(np.intersect1d(similar.head(x, common), similar.head(y, common)))
    assert not similar.may_share(similar.bins(x).tobytes(), similar.bins(rng.integers(0, 2**63, 3000, dtype=np.uint64) * np.uint64(2)).tobytes(), 2667)


def test_a_bucket_of_strangers_takes_linear_work():
    n = 20_000
    rng = np.random.default_rng(13)
    rows = {c: rng.integers(-(2**63), 2**63 - 1, n) for c in ("fp", "hi", "lo")}
    compared = 0
    near = similar._near

    def counted(rows, i, j):
        nonlocal compared
        compared += len(i)
        return near(rows, i, j)

    similar._near = counted
    try:
        list(similar.bucket_pairs(rows, np.arange(n), np.zeros(n, np.int64)))
    finally:
        similar._near = near
    assert 0 < compared <= similar.ALL_PAIRS * n


def test_a_set_visits_blocks_of_a_component_not_its_members_and_no_link_is_lost(spark, monkeypatch):
    rng = random.Random(15)
    base = [f"w{i}" for i in range(150)]

    def changed(k, name):
        words = list(base)
        for at in rng.sample(range(5, 145), k):
            words[at] = f"{name}x{at}"
        return " ".join(words)

    texts = [changed(1, i) for i in range(120)] + [changed(2 + i % 4, 120 + i) for i in range(40)]
    held = [similar.shingles(t) for t in texts]
    key = [similar.key_of(s) for s in held]
    known = spark.createDataFrame([(max(key[i], key[0]), min(key[i], key[0])) for i in range(1, 120)], "a long, b long")
    monkeypatch.setattr(similar, "candidates", lambda sets: known)
    monkeypatch.setattr(similar, "BLOCK", 40)
    monkeypatch.setattr(similar, "GUESTS", 7)
    made, missed = [], similar.missed
    monkeypatch.setattr(similar, "missed", lambda *a: made.append(missed(*a)) or made[0])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in similar.keep_one_of_each(docs).collect()}
    near = np.array([(i, j) for i in range(160) for j in range(i) if similar.alike(held[i].tobytes(), held[j].tobytes())])
    assert kept == set(similar.simhash._roots(160, *near.T).tolist()) and 1 < len(kept) < 40
    component = similar.simhash.components(known).first()["root"]
    assert 0 < made[0].where(made[0]["root"] == component).count() <= 40 * 3  # blocks, not 40 * 120 pairs
