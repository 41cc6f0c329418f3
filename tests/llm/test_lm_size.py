"""The language model's size and its gradient."""

import inspect

import numpy as np

from meetloom.llm import lm


def test_pairs_have_rows_enough_and_training_its_rounds():
    pairs = lm.context_features(np.arange(lm.SYMBOLS**2))[:, 3]
    assert len(np.unique(pairs)) > 15_000
    assert inspect.signature(lm.train).parameters["rounds"].default == 10
    assert inspect.signature(lm.score_documents).parameters["rounds"].default == 10


def test_gradient_of_many_contexts_equals_the_sum_over_each():
    rng = np.random.default_rng(1)
    m = lm.MaxEnt({b"": 0}, rng.normal(size=(lm.BUCKETS, lm.CLASSES)).astype("f4"), rng.normal(size=(lm.BUCKETS, lm.SYMBOLS)).astype("f4"))
    context, symbol, n = rng.permutation(lm.SYMBOLS**2)[:2100], rng.integers(0, lm.SYMBOLS, 2100), rng.integers(1, 9, 2100)
    slope, seen = lm.gradient(m, context, symbol, n)
    parts = [lm.gradient(m, context[p], symbol[p], n[p]) for p in np.array_split(np.arange(2100), 7)]
    assert np.allclose(sum(p[0] for p in parts), slope, atol=1e-3) and np.allclose(sum(p[1] for p in parts), seen) and np.isclose(seen.sum(), 2 * 4 * n.sum())
    mass = seen[:, : lm.CLASSES].sum(1)
    again, held = np.zeros_like(slope), np.zeros_like(mass)
    lm.add_packed(lm.packed(slope, mass), again, held)
    assert np.allclose(again, slope, atol=1e-2 * (1 + mass[:, None]).max() / 10) and np.allclose(held, mass)


def test_merged_counts_are_sums():
    rng, a, b = np.random.default_rng(4), (np.empty(0, np.int64), np.empty(0, np.int64)), []
    for _ in range(5):
        b.append(rng.integers(0, 50, 200))
        a = lm.merged(a, np.unique(b[-1], return_counts=True))
    code, n = np.unique(np.concatenate(b), return_counts=True)
    assert (a[0] == code).all() and (a[1] == n).all()


def test_score_equals_a_plain_model_over_the_same_weights(spark, monkeypatch):
    """Every word's probability, feature by feature and class by class, from the trained weights."""
    import math
    import random
    import zlib
    from collections import Counter

    kept, fitted = [], []
    monkeypatch.setattr(lm, "pair_values", lambda pairs, shared, tails, f=lm.pair_values: fitted.append((shared, f(pairs, shared, tails))) or fitted[-1][1])
    monkeypatch.setattr(lm, "train", lambda events, model, rounds, f=lm.train: kept.append(f(events, model, rounds)) or kept[-1])
    rng = random.Random(8)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(400)], [1 / (i + 1) for i in range(400)], k=rng.randint(0, 60))) for _ in range(120)] + ["odd ones meet odd ones"] * 4 + [None, "", "Never seen words"]
    got = {r["doc_id"]: r["score"] for r in lm.score_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), rounds=3).collect()}
    count = Counter(w for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2 for w in [*(t or "").lower().encode().split(), b""])
    (m,) = kept
    tail = Counter()
    for w, n in count.items():
        if w not in m.head:
            tail[zlib.crc32(w[-3:]) % lm.TAILS] += n + 1
    each = lm.SYMBOLS // lm.CLASSES
    ((shared, (codes, values)),) = fitted
    value, place = dict(zip(codes.tolist(), values.tolist(), strict=True)), {w: i for i, w in enumerate(shared.value.words)}

    def weight(before, word):
        at = place.get(word)
        return 0.0 if before not in place or at is None else value.get(lm.EVENTS + (place[before] << lm.KEY_BITS) + lm.TAILS + at, 0.0)

    def within(before, word):
        group = [w for w in count if w not in m.head and lm.tail_of(w) == lm.tail_of(word)]
        q, unseen = {w: (count[w] + 1) / (tail[lm.tail_of(word)] + 1) for w in group}, 1 / (tail[lm.tail_of(word)] + 1)
        z = unseen + math.fsum(q[w] * 10 ** weight(before, w) for w in group)
        return (q[word] if word in q else unseen) * 10 ** weight(before, word) / z

    def log_probability(two, one, word, before):
        y = m.head.get(word, lm.SYMBOLS - lm.TAILS + zlib.crc32(word[-3:]) % lm.TAILS)
        f = lm.context_features(np.array([two * lm.SYMBOLS + one]))[0]
        c = [math.fsum(float(m.by_class[k, i]) for k in f) for i in range(lm.CLASSES)]
        s = [math.fsum(float(m.by_symbol[k, i]) for k in f) for i in range(y // each * each, y // each * each + each)]
        p = math.exp(c[y // each]) / sum(map(math.exp, c)) * math.exp(s[y % each]) / sum(map(math.exp, s))
        if word not in m.head:
            p *= within(before, word)
        return math.log10(p), y

    for i, t in enumerate(texts):
        two = one = 0
        total, before = 0.0, b""
        for w in [*(t or "").lower().encode().split(), b""]:
            x, y = log_probability(two, one, w, before)
            total, two, one, before = total + x, one, y, w
        assert math.isclose(got[i], total, abs_tol=1e-3 + 1e-5 * abs(total))
    assert len(codes) > 100
    listed = [(b, w) for b in place for w in place if w not in m.head and weight(b, w)]
    before, word = max(listed, key=lambda p: weight(*p))
    assert within(before, word) > (count[word] + 1) / (tail[lm.tail_of(word)] + 1)


def test_pair_weights_solve_their_equations():
    """At the optimum, a pair's count is its expectation and the penalty; a word before without a group's pairs has no value there."""
    words = [f"x{i}".encode() for i in range(60)]
    known = lm.Words({b"": 0}, words, np.arange(1, 61)[::-1].copy()).indexed()
    tails = np.full(lm.TAILS, 1.0)
    for i, w in enumerate(words):
        tails[lm.tail_of(w)] += known.n[i] + 1
    rng, pair, total = np.random.default_rng(2), {}, {}
    for before, word, n in zip(rng.integers(0, 9, 150), rng.integers(0, 60, 150), rng.integers(1, 30, 150), strict=True):
        pair[before, word] = pair.get((before, word), 0) + int(n)
        total[before, lm.tail_of(words[word])] = total.get((before, lm.tail_of(words[word])), 3) + int(n)
    total[9, 0] = 8
    coded = {lm.EVENTS + (int(b) << lm.KEY_BITS) + lm.TAILS + int(w): n for (b, w), n in pair.items()} | {lm.EVENTS + (int(b) << lm.KEY_BITS) + g: n for (b, g), n in total.items()}
    codes, values = lm.fit_pairs(np.array(list(coded)), np.array(list(coded.values())), known, tails)
    value = dict(zip(codes.tolist(), (values * np.log(10)).tolist(), strict=True))
    assert len(value) == len(pair) + len(total) - 1
    for (b, w), n in pair.items():
        g = lm.tail_of(words[w])
        weight, minus_log_z = value[lm.EVENTS + (int(b) << lm.KEY_BITS) + lm.TAILS + int(w)], value[lm.EVENTS + (int(b) << lm.KEY_BITS) + g]
        expected = total[b, g] * (known.n[w] + 1) / tails[g] * np.exp(weight + minus_log_z)
        assert abs(n - expected - lm.PAIR_PENALTY * weight) < 0.02 * (n + 1)
