"""BPE, toxicity, language ID, decontamination and language model against brute force and edge cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from meetloom.llm import bpe, decontaminate, langid, lm, queries, toxicity
from meetloom.llm.common import lower_words

TOKENIZER = bpe.located(queries.TOKENIZER)
tokenizers = pytest.importorskip("tokenizers")
ODD = [None, "", " ", "a", "\n\n  x\t", "<|endoftext|>", "a<|endoftext|> b", "é漢字 ß" * 50, "x" * 20_000, " " * 5_000, "don't 'll 123abc!!"]


def documents(spark, texts, **more):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(TOKENIZER)
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_equals_the_library(library):
    b = bpe.Bpe.load(TOKENIZER)
    rng = random.Random(1)
    texts = [t or "" for t in ODD] + ["".join(rng.choice("aAbEethnoprs'  \n\t.,!<|>0129éß漢 ") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        got = b.encode(t)
        assert got.tolist() == want
        assert b.decode_bytes(got).decode() == library.decode(want, skip_special_tokens=False)


def test_every_token_encodes_to_itself():
    b = bpe.Bpe.load(TOKENIZER)
    assert all(b.encode_piece(t) == [i] for t, i in b.id_of.items())


def test_bpe_digests_of_odd_rows(spark, library):
    df = documents(spark, [*ODD, "a"]).unionByName(documents(spark, ["again"]))
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.bpe_digests(df, TOKENIZER).collect()}
    for i, t in enumerate([*ODD, "a"]):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) in got
    assert bpe.bpe_digests(df.limit(0), TOKENIZER).count() == 0
    back = bpe.decode_texts(bpe.encode_texts(df, TOKENIZER), TOKENIZER).collect()
    assert sorted(r["text"] for r in back) == sorted([*(t or "" for t in ODD), "a", "again"])


def _within(pattern, text):
    """Least edit distance to any part, by the plain table."""
    before = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        row = [i]
        for j, y in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        before = row
    return min(before)


def test_leaks_equal_brute_force():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    items = [(i, " ".join(word() for _ in range(rng.randint(4, 30)))) for i in range(12)]
    m = decontaminate.Matcher(items)
    for _ in range(150):
        _, item = rng.choice(items)
        copy = list(item)
        for _ in range(rng.randint(0, 12)):
            at = rng.randrange(len(copy))
            copy[at : at + 1] = rng.choice([[], [rng.choice("abcxyz")], [copy[at], "q"]])
        text = decontaminate.folded(" ".join([*(word() for _ in range(rng.randint(0, 20))), "".join(copy), *(word() for _ in range(rng.randint(0, 20)))]))
        want = {i: d for i, t in items if (d := _within(t if len(t) >= decontaminate.LEAST else f" {t} ", text if len(t) >= decontaminate.LEAST else f" {text} ")) <= decontaminate.error_budget(len(t))}
        assert {i: d for i, d, _, _ in m.search(text)} == want


def test_leaks_of_odd_rows(spark):
    passage = "one passage of the benchmark that is long enough to be told apart from others"
    bench = spark.createDataFrame([(1, passage), (2, None), (3, "?!"), (4, "Short one"), (5, passage), (None, passage)], "item_id long, text string")
    docs = documents(spark, [*ODD, f"before. {passage.upper()}! after", passage.replace("long", "lung"), "a (short-one)", "a short onee"])
    for block in (1 << 20, 10):
        got = sorted((r["doc_id"], r["item_id"] or 0, r["distance"]) for r in decontaminate.find_leaks(docs, bench, block).collect())
        n = len(ODD)
        assert got == sorted([*((n + k, i, d) for k, d in ((0, 0), (1, 1)) for i in (0, 1, 5)), (n + 2, 4, 0)])
        kept = decontaminate.keep_uncontaminated(docs, bench, block)
        assert (kept.columns, kept.count()) == (docs.columns, n + 1)
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0


def test_toxicity_on_held_out_rows(spark):
    got = queries.op8_toxicity(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert ((got["score"] >= 0.3) == (got["predicted"] == 1)).all() and got["score"].between(0, 1).all()
    hit = (got["predicted"] == 1) & (got["toxic"] == 1)
    assert hit.sum() / (got["toxic"] == 1).sum() > 0.85 and ((got["predicted"] == 1) & (got["toxic"] == 0)).mean() < 0.01


def test_toxicity_of_odd_rows(spark):
    docs, none = documents(spark, ODD), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.score_documents(docs, none).collect()} == {0.0}
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(len(ODD))] + [(0, None, None), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.score_documents(docs.unionByName(docs), labels).collect()
    assert len(got) == 2 * len(ODD) and all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0


def test_languages(spark, sf):
    got = queries.op4_language_id(spark, "/root/testdata/sf0.01").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "n_chars").toPandas().merge(got[got["doc_id"].notna()], on="doc_id", suffixes=("_label", ""))
    assert len(docs) == 1000 and (docs["lang"] == docs["lang_label"]).mean() > 0.98
    pages = got[got["page_id"].notna()]
    assert len(pages) == 250 and (pages["declared"] == pages["lang"]).mean() > 0.95


def test_evidence_decides_where_text_does_not(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog of the house", "en", "s", 0), (2, "le chat et le chien de la maison", "fr", "s", 0), (3, None, None, None, 0), (4, "", "en", "s", 0)], "doc_id long, text string, lang string, source string, n int")
    page = lambda i, lang: (i, f"http://h{i}.x/", f"<html lang='{lang}'><body></body></html>")
    pages = spark.createDataFrame([page(1, "fr"), page(2, "xx"), (3, None, None), (4, "nothing", "<p>the cat and the dog</p>")], "page_id long, url string, html string")
    got = {(r["doc_id"], r["page_id"]): r for r in langid.identify_languages(docs, pages).collect()}
    assert (got[1, None]["lang"], got[2, None]["lang"], got[3, None]["lang"], got[4, None]["keep"]) == ("en", "fr", "und", False)
    assert (got[None, 1]["lang"], got[None, 2]["lang"], got[None, 3]["lang"], got[None, 4]["lang"]) == ("fr", "und", "und", "en")
    kept = langid.keep_identified(docs)
    assert (kept.columns, sorted(r["doc_id"] for r in kept.collect())) == (docs.columns, [1, 2])
    assert langid.identify_languages(docs.limit(0), pages).where("keep").count() == 0


def test_language_model_counts_and_distribution(spark):
    import math
    from collections import Counter

    texts = [*ODD, *(" ".join(random.Random(i).choices(["The", "cat", "sat.", "mat", f"w{i}"], k=30)) for i in range(60))]
    docs = documents(spark, texts)
    count = Counter()
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(lower_words(t))
            count[b""] += 1
    n, v = sum(count.values()), len(count)
    got = {r["doc_id"]: r for r in lm.score_documents(docs, rounds=4).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        words = [*lower_words(t), b""]
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(count[w] > 0 for w in words), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words))
        assert r["score"] < 0
    long = [r for r in got.values() if r["doc_id"] >= len(ODD)]
    assert sum(r["score"] for r in long) > sum(r["base_score"] for r in long)
    assert lm.score_documents(docs.limit(0)).count() == 0


def test_maxent_is_a_distribution():
    rng = np.random.default_rng(0)
    m = lm.MaxEnt({b"": 0}, rng.normal(size=(lm.BUCKETS, lm.CLASSES)).astype("f4"), rng.normal(size=(lm.BUCKETS, lm.SYMBOLS)).astype("f4"))
    assert np.allclose((10.0 ** m.log10_table(np.arange(0, 60_000, 997))).sum(1), 1, atol=1e-4)
    context, symbol, n = np.array([5, 5, 700]), np.array([1, 9, 200]), np.array([3, 2, 4])
    slope, seen = lm.gradient(m, context, symbol, n)
    f = lm.context_features(np.array([700]))[0]
    assert np.allclose(slope.sum(), 0, atol=1e-3)
    eps, (k, y) = 1e-2, (int(f[-1]), 200)
    like = lambda model: sum(c * (model.log_parts(np.array([x]))[0][0, s // 16] + model.log_parts(np.array([x]))[1][0, s]) for x, s, c in zip(context, symbol, n, strict=True))
    up, down = (lm.MaxEnt(m.head, m.by_class, m.by_symbol.copy()) for _ in range(2))
    up.by_symbol[k, y] += eps
    down.by_symbol[k, y] -= eps
    assert (like(up) - like(down)) / (2 * eps) == pytest.approx(slope[k, lm.CLASSES + y], abs=0.05)
