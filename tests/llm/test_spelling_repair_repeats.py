"""Spelling variants, conversation repair and repeated passages against brute force and edge cases. Their SQL is compared in test_grouping_operators."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from meetloom.llm import repair, repeats, spelling

ODD_DOCS = "doc_id long, text string, n long, word string, shard int, seed long, row long"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.fixture(scope="module")
def vocabulary():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abç") for _ in range(rng.randint(5, 8))) for _ in range(400)})
    return {w: rng.randint(3, 200) for w in words}


@pytest.mark.parametrize("shard_words", [5, 50_000])
def test_near_words_equal_brute_force(spark, vocabulary, shard_words):
    words = spark.createDataFrame(list(vocabulary.items()), "word string, n long")
    want = {(a, b) for a in vocabulary for b in vocabulary if abs(len(a) - len(b)) < 2 and distance(a, b) == 1}
    pairs = [(r["word"], r["near"]) for r in spelling.near_pairs(words, shard_words).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == want
    near = {w: sorted((x for a, x in want if a == w), key=lambda x: (-vocabulary[x], x)) for w in vocabulary}
    form = {w: x[0] if x and vocabulary[x[0]] >= 2 * vocabulary[w] else None for w, x in near.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    got = spelling.group_variants(words, shard_words=shard_words).collect()
    assert {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got} == {w: (n, len(near[w]), form[w], vocabulary.get(form[w]), root(w)) for w, n in vocabulary.items()}


def test_words_of_odd_texts(spark):
    long = "Straßen " * 40_000
    rows = [(1, None, 0, "", 0, 0, 0), (2, "", 0, "", 0, 0, 0), (None, "naïve NAÏVE naïve×x", 1, "w", 1, 1, 1), (3, long, 0, "", 0, 0, 0), (3, long, 0, "", 0, 0, 0)]
    docs = spark.createDataFrame(rows, ODD_DOCS)
    want = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = spelling.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    assert {r["word"]: r["n"] for r in spelling.count_words(docs).collect()} == {w: n for w, n in want.items() if n >= 3 and len(w) >= 5}
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


def test_a_damaged_run_loses_one_letter():
    runs = [f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100 % 6]}" for i in range(600)]
    lost = dict(spelling.damages(7, runs))
    assert lost and all(len(left) == len(run) - 1 and distance(run, left) == 1 for run, left in lost.items())
    assert set(lost) == {r for r in runs if spelling.crc32(f"7:{r}".encode()) % 97 == 0}


def cheapest(rows, inserts=3):
    """(cost, audit, initials) of the cheapest repair, by trying all."""
    best, prefix = [], re.compile("s?(ua)*u?$")

    def go(i, out, cost, audit, left):
        if best and cost > best[0][0] or not prefix.match(out):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", out):
            best[:] = [min([*best, (cost, audit, out)])]
        if left:
            for r in "ua":
                go(i, out + r, cost + 5, audit + "I", left - 1)
        if i < len(rows):
            row = rows[i]
            go(i + 1, out, cost + 2, audit + "D", left)
            if row.fault not in ("blank", "duplicate"):
                more = 5 * (row.fault == "truncated")
                if row.role[:1] in ("s", "u", "a"):
                    go(i + 1, out + row.role[0], cost + more, audit + "K", left)
                for r in "ua":
                    go(i + 1, out + r, cost + more + 1, audit + "R", left)

    go(0, "", 0, "", inserts)
    return best[0]


@pytest.mark.parametrize("open_rows", [2, 256])
def test_repairs_are_the_cheapest(monkeypatch, open_rows):
    monkeypatch.setattr(repair, "OPEN_ROWS", open_rows)
    rng = random.Random(open_rows)
    for _ in range(300):
        rows = [repair.Row(i, rng.choice(["user", "assistant", "system", "tool", ""]), f"t{i}.", rng.choice(["", "", "", "blank", "truncated", "duplicate"])) for i in range(rng.randint(0, 6))]
        got = list(repair.repair(iter(rows)))
        tally = repair.Tally()
        tally.edited(iter(got))
        assert (tally.cost, "".join(tally.audit), "".join(role[0] for edit, role, _ in got if edit != "D")) == cheapest(rows)
        assert [row for _, _, row in got if row] == rows


def test_a_long_conversation_is_parsed_with_few_rows_open():
    chart, most, told = repair.Chart(), 0, 0
    for i in range(20_000):
        chart.read(repair.Row(i, ("user", "assistant")[i % 2] if i % 97 else "system", "x.", "duplicate" if i % 31 == 5 else ""))
        most = max(most, len(chart.open))
        if len(chart.open) >= 256 and not len(chart.open) % 256:
            told += len(chart.settled())
    assert told > 19_000 and most < 2_000


def test_conversations_of_odd_rows(spark):
    rows = [(None, None, None, None, 1), (None, None, None, None, 1), (1, 0, "user", "Hi.", 1), (1, 0, "user", "Hi.", 1), (1, None, "assistant", "Yes", 1), (1, 5, "assistant", "x. " * 200_000, 1), (1, 7, "user", "Hi.", 1)]
    made = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copies int")
    found = repair.faults(made)
    assert Counter(r["fault"] for r in found.collect()) == {"blank": 1, "truncated": 1, "": 2, "duplicate": 1}
    got = {r["conv_id"]: r for r in repair.repair_report(found).collect()}
    assert (got[None]["blank"], got[None]["duplicate"], got[None]["audit"], got[None]["gaps"]) == (2, 0, "DD", 0)
    assert got[None]["repaired_sha256"] == hashlib.sha256().hexdigest()
    one = got[1]
    assert (one["gaps"], one["duplicate"], one["truncated"], one["illegal"]) == (5, 2, 1, 1)
    assert (one["audit"], one["cost"]) == ("DKDKD", 6)
    assert one["repaired_sha256"] == hashlib.sha256(("user:Hi.\nassistant:" + "x. " * 200_000).encode()).hexdigest()
    turns = sorted((r["at"], r["edit"], r["role"], r["turn"]) for r in repair.repaired_turns(found).where("conv_id = 1").collect())
    assert turns == [(0, "D", "assistant", None), (1, "K", "user", 0), (2, "D", "user", 0), (3, "K", "assistant", 5), (4, "D", "user", 7)]
    empty = repair.repair_report(repair.faults(repair.damaged(made.limit(0))))
    assert empty.count() == 0
    dropped = next(i for i in range(999) if spelling.crc32(f"{i}:0".encode()) % 20 == 0)
    gone = repair.repair_report(repair.faults(repair.damaged(spark.createDataFrame([(dropped, 0, "user", "Hi.", 1)], "conv_id long, turn long, role string, text string, copies int")))).first()
    assert tuple(gone)[:8] == (dropped, 0, 0, 0, 0, 0, 0, "") and gone["repaired_sha256"] == hashlib.sha256().hexdigest()


def removed_by_hand(docs, window):
    starts = Counter(tuple(w[i : i + window]) for w in docs for i in range(len(w) - window + 1))
    out = []
    for w in docs:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append([x for x, g in zip(w, gone, strict=True) if not g])
    return out


@pytest.mark.parametrize(("window", "seed", "hot"), [(7, 3, 2_000), (7, 3, 1), (35, 6, 2_000)])
def test_repeated_passages_equal_brute_force(spark, window, seed, hot):
    rng = random.Random(window)
    common = [rng.choice("abcde") + str(rng.randint(0, 40)) for _ in range(300)]
    docs = []
    for _ in range(120):
        w = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            at, n = rng.randint(0, 250), rng.randint(1, 2 * window)
            w += common[at : at + n] + [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 4))]
        docs.append(w)
    docs += [["a"] * (2 * window), docs[5], ["b", "c"] * window, [], common[: window - 1], common[:window]]
    df = spark.createDataFrame([(i, " ".join(w), i, "x", 0, 0, 0) for i, w in enumerate(docs)], ODD_DOCS)
    got = {r["doc_id"]: r for r in repeats.without_repeats(df, window, seed, shard_bytes=2_000, hot=hot).collect()}
    for i, kept in enumerate(removed_by_hand(docs, window)):
        assert got[i]["n_words"] == len(docs[i]) and got[i]["kept"] == " ".join(kept), i
        assert sum(s["end"] - s["start"] for s in got[i]["spans"]) == len(docs[i]) - len(kept)


def test_repeats_in_odd_texts(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, None), (2, ""), (None, "a   b"), (3, "x " * 30_000), (4, passage), (4, passage), (5, f"new\t{passage}\nend"), (6, " ".join(f"q{i}" for i in range(50)))]
    df = spark.createDataFrame([(i, t, 0, "", 0, 0, 0) for i, t in rows], ODD_DOCS)
    got = sorted(((r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"], r["n_removed"]) for r in repeats.repeat_digests(df).collect()))
    assert got == [(-1, 3, 0), (1, 0, 0), (2, 0, 0), (3, 30_000, 30_000), (4, 60, 60), (4, 60, 60), (5, 62, 60), (6, 50, 0)]
    assert repeats.repeat_digests(df.limit(0)).count() == 0
    kept = repeats.repeat_digests(df).where("doc_id = 5").select("kept_sha256").first()[0]
    assert kept == hashlib.sha256(b"new end").hexdigest()
    assert repeats.repeat_digests(df.select("doc_id", F.col("text"))).count() == len(rows)
