"""Chat, sharding, SimHash, I-Match, URL rules and the pipeline against brute force and edge cases."""

import hashlib
import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
import xxhash
from conftest import rows_of
from pyspark.sql import functions as F

from meetloom.llm import chat, imatch, queries, shard, simhash, urlfilter
from meetloom.llm.common import lower_words

DOCS = "doc_id long, text string, lang string, source string, fingerprint int"
ODD = [(1, None, None, None, 1), (2, "", "en", "s", 1), (2, "", "en", "s", 1), (None, "x y", "en", "s", 1), (3, "word " * 9000, "de", "t", 1), (3, "Word", "de", "t", 1), (-5, "x y", "en", "s", 1)]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, sf, duck, name):
    assert rows_of(queries.queries()[name](spark, sf).toPandas()) == rows_of(duck.execute(queries.oracle_sql()[name]).df())


def test_chat_round_trip_and_events(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "<\\|", "<\\\\|x|", "a<", "\\", "", "<<|", "|>"]
    for role, text in product(["user", "assistant", "", "a\nb\\n", "<|im_start|>"], nasty):
        segment, a, b = chat.render(role, text)
        assert chat.parse(segment) == (role, text)
        assert chat.unescape(segment[a:b]) == (text if role == "assistant" else "")
    log = [(1, 0, 0, "message", "user", "hi"), (1, 1, 0, "delta", "assistant", "he"), (1, 1, 2, "delta", None, "y"), (1, 1, 1, "delta", None, "llo"), (1, 2, 0, "message", "user", "more"), (1, 2, 1, "edit", None, "less"),
           (1, 3, 0, "message", "assistant", "bad"), (1, 3, 1, "regenerate", None, None), (1, 3, 2, "delta", None, "go"), (1, 3, 3, "delta", None, "od"), (1, 4, 0, "message", "user", "x"), (1, 4, 1, "delete", None, None), (None, None, None, "message", None, None)]
    random.Random(1).shuffle(log)
    segments = chat.format_conversations(spark.createDataFrame(log, chat.EVENTS)).toPandas()
    mine = segments[segments["conv_id"] == 1].sort_values(["msg", "nth"])
    assert [chat.parse(s) for s in mine["segment"]] == [("user", "hi"), ("assistant", "helloy"), ("user", "less"), ("assistant", "good")]
    assert [chat.parse(s) for s in segments[segments["conv_id"].isna()]["segment"]] == [("", "")]
    reopened = [(2, 0, 0, "message", "user", "gone"), (2, 0, 1, "delete", None, None), (2, 0, 2, "delta", None, "back")]
    assert [chat.parse(r["segment"]) for r in chat.format_conversations(spark.createDataFrame(reopened, chat.EVENTS)).collect()] == [("user", "back")]
    with pytest.raises(Exception, match="unknown kind"):
        chat.format_conversations(spark.createDataFrame([(1, 0, 0, "other", "user", "")], chat.EVENTS)).collect()
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], chat.EVENTS))).count() == 0


def test_curve_is_continuous_and_shards_keep_the_law(spark, sf):
    cells = sorted(product(range(16), repeat=3), key=shard.hilbert_index)
    assert all(sum(abs(a - b) for a, b in zip(x, y, strict=True)) == 1 for x, y in zip(cells, cells[1:], strict=False))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for df, n in ((docs, docs.count()), (spark.createDataFrame(ODD, DOCS), len(ODD)), (docs.limit(0), 0)):
        got = shard.hilbert_shards(df).toPandas()
        assert len(got) == n
        count = Counter(got["shard"])
        assert not n or max(count.values()) - min(count.get(s, 0) for s in range(8)) <= 1
        for s, g in got.groupby("shard"):
            assert sorted(g["slot"]) == list(range(len(g)))
        assert got.sort_values("shard")["curve_index"].groupby(got["shard"]).agg(["min", "max"]).stack().is_monotonic_increasing if n else True
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    by_place = sorted((r["shard"], r["slot"], zlib.crc32((text[r["doc_id"]] or "").encode()), r["curve_index"], r["doc_id"]) for r in shard.hilbert_shards(docs).collect())
    assert [(c, x, i) for _, _, x, c, i in by_place] == sorted((c, x, i) for _, _, x, c, i in by_place)  # curve, checksum, id: so equal texts are neighbours
    cells = {}
    for _, _, _, c, i in by_place:
        assert cells.setdefault(text[i] or "", c) == c
    for r in shard.hilbert_shards(docs).collect():
        raw = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
    assert shard.shard_manifest(shard.hilbert_shards(docs)).count() == 8


def test_hot_texts_are_numbered_like_others(spark, monkeypatch):
    rows = [(i, "hot text" if i % 3 else f"text {i % 40}", "en" if i % 2 else "de", f"s{i % 5}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    plain = sorted((r["doc_id"], r["curve_index"]) for r in shard.hilbert_shards(docs).collect())
    monkeypatch.setattr(shard, "HOT_ROWS", 20)
    got = shard.hilbert_shards(docs).toPandas()
    assert sorted(zip(got["doc_id"], got["curve_index"], strict=True)) == plain
    assert {len(g) for _, g in got.groupby("shard")} == {50}
    places = got.assign(place=got["shard"] * 50 + got["slot"]).sort_values("place")
    assert places["place"].tolist() == list(range(400)) and places["curve_index"].is_monotonic_increasing
    at = places.loc[places["doc_id"] % 3 != 0, "place"]
    assert at.max() - at.min() == len(at) - 1


def _plain_simhash(text):
    words = lower_words(text)
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def _plain_components(rows):
    """component of each row: the least id within reach, by comparing all pairs."""
    fps = sorted({f for _, f in rows})
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                parent[root(b)] = root(a)
    least = {}
    for i, f in rows:
        if i is not None:
            least[root(f)] = min(least.get(root(f), i), i)
    return {(i, f): least.get(root(f)) for i, f in rows}, len({root(f) for f in fps})


def test_simhash_components_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(ODD, DOCS).select(F.col("doc_id") + 10_000, "text").toDF("doc_id", "text"))
    rows = [(r["doc_id"], _plain_simhash(r["text"])) for r in docs.collect()]
    want, groups = _plain_components(rows)
    got = simhash.near_duplicate_components(docs).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == sorted((str(i), f"{f:016x}", str(want[i, f])) for i, f in rows)
    kept = simhash.keep_one_of_each(docs)
    assert kept.count() == groups and kept.columns == docs.columns
    assert simhash.near_duplicate_components(docs.limit(0)).count() == 0 and simhash.keep_one_of_each(docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(None, 'a b c d', 1), (None, 'a b c d', 1), (None, 'another text altogether', 2), (7, None, 3)], 'doc_id long, text string, m_id int')
    assert sorted(map(str, simhash.keep_one_of_each(twice).collect())) == sorted(map(str, twice.distinct().collect()))
    clash = docs.select("*", *[F.lit(1).alias(c) for c in ("m_fp", "M_key", "m_again", "m_odd", "m_hit", "__fp", "__id", "fp", "root")])
    kept = simhash.keep_one_of_each(clash)
    assert kept.columns == clash.columns and kept.count() == groups and kept.where("m_fp <> 1 or __fp <> 1 or fp <> 1").count() == 0


def test_links_of_clusters_equal_brute_force(spark, monkeypatch):
    """Fingerprints made to lie at 1 to 8 bits; a small bound makes the balls split."""
    rng = random.Random(3)
    fps = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(60):
            f = base
            for b in rng.sample(range(64), rng.randint(0, 7)):
                f ^= 1 << b
            fps.add(f)
    rows = [(i, f) for i, f in enumerate(sorted(fps))]
    want, _ = _plain_components(rows)
    df = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in rows], "doc_id long, fp long")
    got = {r["fp"] % (1 << 64): r["component_id"] for r in simhash.component_of(df).collect()}
    assert got == {f: c for (_, f), c in want.items()}
    monkeypatch.setattr(simhash, "HOT_PREFIX", 8)
    assert {r["fp"] % (1 << 64): r["component_id"] for r in simhash.component_of(df).collect()} == got
    fp = np.array(sorted(fps), np.uint64)
    whole = simhash._links_of_prefix(fp, np.zeros(len(fp), np.int64), 4, 4)
    monkeypatch.setattr(simhash, "AT_ONCE", 20_000)
    split = simhash._links_of_prefix(fp, np.zeros(len(fp), np.int64), 4, 4)
    assert sorted(map(tuple, whole)) == sorted(map(tuple, split))


def test_imatch_against_plain_python(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(1001, None), (1002, ""), (1003, "Ünï 1"), (1004, "é" * 7)], "doc_id long, text string"))
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), reverse=True)
    got = {r["doc_id"]: r for r in imatch.imatch_fingerprints(docs).collect()}
    assert len(got) == len(rows)
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        k = len(text) // 3
        edited = text[: len(text) - k] + after[:k]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    by_text = {}
    for i, text in rows:
        assert by_text.setdefault(text, got[i]["fingerprint"]) == got[i]["fingerprint"]
    long = [g for g in got.values() if g["n_terms"] >= 20]
    assert sum(g["near_edited"] > g["near_next"] for g in long) > 0.9 * len(long)


def test_imatch_of_a_large_group_of_copies(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(10_000)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(60, 150)))) for i in range(300)]
    copy = " ".join(rng.choices(words, k=120))
    got = {r["doc_id"]: r for r in imatch.imatch_fingerprints(spark.createDataFrame(rows + [(1000 + i, copy) for i in range(30)], "doc_id long, text string")).collect()}
    copies = [got[1000 + i] for i in range(30)]
    assert all(r["n_terms"] > 0 and r["near_edited"] > 0 for r in copies) and len({r["fingerprint"] for r in copies}) == 1
    assert sorted(r["near_next"] for r in copies)[1] == 1.0


def test_imatch_of_ids_at_both_ends_of_long(spark):
    ids = [-(2**63), -(2**62), -5, 0, 2**53, 2**53 + 1, 2**62 + 5, 2**63 - 1, None, None]
    df = spark.createDataFrame([(i, f"text of row {k} " * (k + 3)) for k, i in enumerate(ids)], "doc_id long, text string")
    rows = sorted(((-(2**64) if r["doc_id"] is None else r["doc_id"], r["text"]) for r in df.collect()), reverse=True)
    want = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        k = len(text) // 3
        want.append((i, hashlib.sha256((text[: len(text) - k] + after[:k]).encode()).hexdigest()))
    assert sorted((-(2**64) if r["doc_id"] is None else r["doc_id"], r["edited_sha256"]) for r in imatch.imatch_fingerprints(df).collect()) == sorted(want)


def test_imatch_of_odd_rows(spark):
    df = spark.createDataFrame(ODD, DOCS)
    assert imatch.imatch_fingerprints(df).count() == len(ODD)
    assert imatch.imatch_fingerprints(df.limit(1)).count() == 1
    assert imatch.imatch_fingerprints(df.limit(0)).count() == 0


def test_url_rules_in_row_and_by_join_agree(spark, sf):
    odd = [(1, None), (2, "no scheme"), (3, "http://COM"), (3, "http://Com/x"), (4, "http://example.com/en/a"), (5, "http://www.EXAMPLE.com/en/"), (6, "http://notexample.com/en/"), (7, "https://a.net/es"), (8, "https://a.net/es/?q=net/fr/"),
           (9, "x://y//z://w.com/"), (10, "http://spam-farm.example.org/en/1#f"), (11, "http://a.b/affiliate/x"), (12, "http://h?x=/fr/"), (None, "http://n.net/fr/#/en/")]
    pages = spark.createDataFrame(odd, "page_id long, url string").withColumn("host", F.lit("clash")).unionByName(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", F.lit("clash").alias("host")))
    rules = [*(urlfilter.host_rule(*r) for r in queries.HOST_RULES), *urlfilter.SPAM_RULES, urlfilter.pattern_rule("*q*"), urlfilter.host_rule("com", "/x", "block")]
    fast, wide = (urlfilter.judge_urls(pages, rules, in_row_rules=n) for n in (1000, 0))
    assert rows_of(fast.toPandas()) == rows_of(wide.toPandas())
    got = {r["page_id"]: r for r in fast.where("page_id <= 12 or page_id is null").collect()}
    assert [(got[i]["rule"], got[i]["verdict"]) for i in (4, 6, 10, 11, None)][-1] == ("net/fr/", "block")
    assert urlfilter.judge_urls(pages.limit(0), rules).count() == 0 and urlfilter.judge_urls(pages, []).where("verdict <> 'allow'").count() == 0


def test_pipeline_keeps_and_drops(spark, tmp_path):
    import corpus_pipeline

    src = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{src}/documents.parquet")
    columns, left = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, src)
        path = str(tmp_path / name.replace(" ", "_"))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        left.append(docs.count())
    assert left == sorted(left, reverse=True) and left[-1] == left[-2] > 0.7 * left[0]
    assert left[1] < left[0] and left[3] < left[2] and left[4] < left[3]
    again = corpus_pipeline.run(spark, src)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, docs.collect()))


def test_a_long_chain_of_fingerprints_is_one_component_of_its_prefix():
    rng, fps = np.random.default_rng(15), [0]
    while len(fps) < 400:
        fps.append(fps[-1] ^ sum(1 << int(b) for b in rng.choice(60, 4, replace=False)))
    fps = rng.permutation(np.unique(np.array(fps, np.uint64)))
    links = simhash._links_of_prefix(fps, np.zeros(len(fps), np.int64), 4, 4)
    assert len(links) == len(fps) - 1
