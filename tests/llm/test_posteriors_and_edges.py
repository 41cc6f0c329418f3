"""The language posterior and the toxicity score by hand, exact ids beside null ids, clashing columns, odd tables."""

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from meetloom.llm import bpe, chat, decontaminate, imatch, langid, lm, queries, shard, toxicity, urlfilter

BIG = 2**53 + 1


def trigrams_by_hand(text):
    b = b" " + b" ".join((text or "").encode().lower().split()) + b" "
    out = []
    for i in range(len(b) - 2):
        g = b[i : i + 3]
        if max(g) >= 97:
            h = (g[0] * 0x9E3779B1 ^ g[1] * 0x85EBCA77 ^ g[2] * 0xC2B2AE3D) & 0xFFFFFFFF
            out.append(h >> 16)
    return out


def levels(host):
    host = host or ""
    labels = host.split(".")
    return host, ".".join(labels[-2:]), labels[-1] if len(labels) > 1 else ""


def test_language_posterior_by_hand(spark, sf):
    docs, pages = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "pages"))
    model = langid.fit_text(langid.labelled_sample(docs))
    k = range(len(model.langs))

    def evidence(text):
        t = trigrams_by_hand(text)
        if not t:
            return [0.0 for _ in k], 0
        ll = [sum(float(model.table[h, i]) for h in t) / (1 + len(t) / langid.TEXT_WEIGHT) for i in k]
        return [x - max(ll) for x in ll], len(t)

    rows = [(("d", r["doc_id"]), r["source"], None, r["text"]) for r in docs.collect()]
    shown = pages.select("page_id", langid.url_host(F.col("url")).alias("host"), langid.declared_language(F.col("html")).alias("declared"), langid.page_text(F.col("html")).alias("text"))
    rows += [(("p", r["page_id"]), r["host"], r["declared"], r["text"]) for r in shown.collect()]
    known = lambda d: None if d is None else d if d in model.langs else "other"
    seen = [(key, levels(host), known(declared), *evidence(text)) for key, host, declared, text in rows]
    vote = lambda ll, n: [math.exp(ll[i]) / sum(map(math.exp, ll)) if n else 0.0 for i in k]
    sums, declared_sums, total = [defaultdict(lambda: [0.0] * (len(k) + 1)) for _ in range(3)], defaultdict(lambda: [0.0] * len(k)), [0.0] * (len(k) + 1)
    for _, at, declared, ll, n in seen:
        v = [*vote(ll, n), float(n > 0)]
        for level, name in zip(sums, at, strict=True):
            level[name] = [a + b for a, b in zip(level[name], v, strict=True)]
        total = [a + b for a, b in zip(total, v, strict=True)]
        if declared:
            declared_sums[declared] = [a + b for a, b in zip(declared_sums[declared], v[:-1], strict=True)]
    overall = [(total[i] + 1) / (total[-1] + len(k)) for i in k]
    smooth = lambda s, parent: [(s[i] + langid.SMOOTHING * parent[i]) / (s[-1] + langid.SMOOTHING) for i in k]
    spoken = [sum(d[i] for d in declared_sums.values()) for i in k]
    trust = lambda d, i: langid.DECLARED_RIGHT if d == model.langs[i] else langid.DECLARED_WRONG
    said = {d: [((declared_sums[d][i] if d in declared_sums else 0) + trust(d, i)) / (spoken[i] + langid.DECLARED_RIGHT + len(k) * langid.DECLARED_WRONG) for i in k] for d in [*model.langs, "other"]}
    want = {}
    for key, (host, domain, suffix), declared, ll, n in seen:
        parent = smooth(sums[1][domain], smooth(sums[2][suffix], overall))
        own, h = vote(ll, n), sums[0][host]
        prior = [(max(0.0, h[i] - own[i]) + langid.SMOOTHING * parent[i]) / (max(0.0, h[-1] - (n > 0)) + langid.SMOOTHING) for i in k]
        logs = [ll[i] + math.log(prior[i]) + (math.log(said[declared][i]) if declared else 0.0) for i in k]
        top = max(logs)
        posterior = 1 / sum(math.exp(x - top) for x in logs)
        keep = (n > 0 or declared in model.langs) and posterior >= langid.LEAST_POSTERIOR
        want[key] = (model.langs[logs.index(top)] if keep else "und", posterior, keep)
    got = {("d", r["doc_id"]) if r["doc_id"] is not None else ("p", r["page_id"]): r for r in langid.identify_languages(docs, pages).collect()}
    assert set(got) == set(want)
    for key, (lang, posterior, keep) in want.items():
        assert got[key]["posterior"] == pytest.approx(posterior, rel=1e-5), key
        assert abs(posterior - langid.LEAST_POSTERIOR) < 1e-5 or (got[key]["lang"], got[key]["keep"]) == (lang, keep), key


def test_a_repeated_id_takes_one_place_of_the_sample(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 50)
    rows = [(7, f"text {i}", "en") for i in range(500)] + [(i, f"texte {i}", "fr") for i in range(100, 160)]
    got = langid.labelled_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(got) == 50 and sum(lang == "en" for _, lang in got) <= 1


def test_very_long_texts_and_pages(spark):
    long = "the quick brown fox " * 60_000
    docs = spark.createDataFrame([(1, long, "en", "s"), (2, "der schnelle braune fuchs " * 50, "de", "s"), (3, None, None, None)], "doc_id long, text string, lang string, source string")
    pages = spark.createDataFrame([(1, "http://" + "a" * 50_000 + ".example.com/", f"<html lang=de>{long}</html>"), (2, None, None)], "page_id long, url string, html string")
    got = {(r["doc_id"], r["page_id"]): r["lang"] for r in langid.identify_languages(docs, pages).collect()}
    assert got[1, None] == "en" and got[2, None] == "de" and got[3, None] == "und" and len(got) == 5
    judged = urlfilter.judge_urls(spark.createDataFrame([(1, "http://example.com/" + "x/" * 200_000 + "?q"), (2, "http://" + "net." * 20_000 + "net/es/")], "page_id long, url string"), [urlfilter.host_rule(*r) for r in queries.HOST_RULES])
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in judged.collect()} == {1: ("com/", "allow"), 2: ("net/es/", "block")}


def grams_by_hand(text):
    fold = "".join(c.lower() if c.isascii() else c for c in (text or ""))
    fold = "".join(c if not c.isascii() or c.isalnum() else " " for c in fold)
    b = (" " + " ".join(x for x in fold.split(" ") if x) + " ").encode()
    out = set()
    for n in toxicity.SIZES:
        for i in range(len(b) - n + 1):
            h = n
            for c in b[i : i + n]:
                h = ((h ^ c) * 0x01000193) & 0xFFFFFFFF
            h ^= h >> 15
            h = (h * 0x2C1B3C6D) & 0xFFFFFFFF
            out.add(h >> (32 - toxicity.BUCKET_BITS))
    return out


def test_toxicity_score_by_hand(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    sample = toxicity.labelled_sample(docs, labels)
    model = toxicity.fit(sample)
    # The ratios that scale the weights, counted by hand for the features that carry one.
    sets, y = [grams_by_hand(t) for t, _ in sample], [int(t > 0) for _, t in sample]
    toxic, clean = sum(y), len(y) - sum(y)
    carried = np.flatnonzero(model.weight)
    share = toxic / len(y)
    for f in carried[:: max(1, len(carried) // 50)].tolist():
        p, q = sum(f in s for s, t in zip(sets, y, strict=True) if t), sum(f in s for s, t in zip(sets, y, strict=True) if not t)
        r = math.log((p + 1) / (toxic + 2)) - math.log((q + 1) / (clean + 2))
        z = (p - (p + q) * share) / math.sqrt((p + q) * share * (1 - share))
        assert p + q >= toxicity.LEAST_DOCS and abs(z) >= toxicity.LEAST_Z and r * float(model.weight[f]) * z != 0
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in toxicity.score_documents(docs, labels).collect():
        total = model.bias + sum(float(model.weight[f]) for f in sorted(grams_by_hand(text[r["doc_id"]])))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-max(-700, min(700, total)))), rel=1e-4, abs=1e-9)
        assert r["predicted"] == int(r["score"] >= toxicity.REJECT_AT)


def test_ids_stay_exact_beside_null_ids(spark, sf):
    bench = spark.createDataFrame([(BIG, "a benchmark question that nobody should ever train on, really"), (None, None)], "item_id long, text string")
    docs = spark.createDataFrame([(BIG + 2, "before a benchmark question that nobody should ever train on, really after"), (None, "x"), (None, None)], "doc_id long, text string")
    got = decontaminate.find_leaks(docs, bench).collect()
    assert {r["doc_id"] for r in got} == {BIG + 2} and {r["item_id"] for r in got} == {BIG}
    talks = spark.createDataFrame([(BIG, 0, "user", "hi"), (None, None, "user", None), (BIG + 2, 0, "assistant", "yo")], "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.format_conversations(chat.messages_as_events(talks))).collect()
    assert {r["conv_id"] for r in back} == {BIG, BIG + 2, None}


def test_decontamination_of_repeated_rows(spark):
    bench = spark.createDataFrame([(1, "a benchmark question that nobody should ever train on")] * 2, "item_id long, text string")
    docs = spark.createDataFrame([(1, "see a benchmark question that nobody should ever train on")] * 3 + [(2, "clean")], "doc_id long, text string")
    assert [r["doc_id"] for r in decontaminate.keep_uncontaminated(docs, bench).collect()] == [2]


CLASH = "part int, key string, root long, shard int, side string, term string, mask long, host string, declared string, ev double, row string, judged string, score double, word string, n long, hit string, slot long, own long, nth long, guest string, fp long, events string, seq long"


def clashing(spark, columns, rows):
    """Rows whose other columns have names that operators might use for helpers."""
    df = spark.createDataFrame(rows, columns)
    taken = {c.lower() for c in df.columns}
    for name, kind in (x.rsplit(" ", 1) for x in CLASH.split(", ")):
        if name.lower() not in taken:
            df = df.withColumn(name, F.lit("1").cast(kind))
    return df


DOCS = [(1, "the first text with some words in it, quite a few of them", "en", "s1"), (2, "another text that says something else entirely", "en", "s2"), (3, None, None, None)]


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op4", "op6", "op8", "op9"])
def test_clashing_columns_change_nothing(spark, name):
    columns = "doc_id long, text string, lang string, source string"
    plain, odd = spark.createDataFrame(DOCS, columns), clashing(spark, columns, DOCS)
    bench = spark.createDataFrame([(1, DOCS[0][1])], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    pages = spark.createDataFrame([(1, "http://a.example.com/", "<html lang=en>the words</html>")], "page_id long, url string, html string")
    run = {
        "op1": lambda d: decontaminate.find_leaks(d, bench), "op2": lambda d: bpe.bpe_digests(d, queries.TOKENIZER), "op3": lm.score_documents, "op4": lambda d: langid.identify_languages(d, pages),
        "op6": shard.hilbert_shards, "op8": lambda d: toxicity.score_documents(d, labels), "op9": imatch.imatch_fingerprints,
    }[name]
    key = lambda r: [(k, round(v, 9) if isinstance(v, float) else v) for k, v in sorted(r.asDict(recursive=True).items())]
    assert sorted(map(str, map(key, run(odd).collect()))) == sorted(map(str, map(key, run(plain).collect())))


def test_clashing_columns_of_conversations_and_stages(spark):
    columns = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo")]
    plain, odd = spark.createDataFrame(rows, columns), clashing(spark, columns, rows)
    back = lambda d: sorted(map(tuple, chat.read_back(chat.format_conversations(chat.messages_as_events(d))).collect()))
    assert back(odd) == back(plain)
    docs = clashing(spark, "doc_id long, text string, lang string, source string", DOCS)
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    bench = spark.createDataFrame([(1, DOCS[0][1])], "item_id long, text string")
    for kept in (toxicity.keep_clean(docs, labels), langid.keep_identified(docs), decontaminate.keep_uncontaminated(docs, bench)):
        assert kept.columns == docs.columns and kept.count() >= 1


def test_language_model_with_all_rows_held_out(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:5]
    docs = spark.createDataFrame([(i, "some words here") for i in held], "doc_id long, text string")
    got = lm.score_documents(docs).collect()
    assert len(got) == len(held) and all(r["held_out"] and r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in got)
