"""Keyed writes and their traps."""

import datetime

import pytest
from pyspark.sql import functions as F

from meetloom.operators import items as itm
from meetloom.operators import ranking
from meetloom.sources import store

ITEM = "document_id string, agenda_item_id string, title string"


def test_last_row_of_a_batch_wins(spark):
    b = spark.createDataFrame([("d", "a", "old", 1), ("d", "a", "new", 2)], ITEM + ", pos int")
    assert [tuple(r) for r in store.last_per_key(b, ["agenda_item_id"], "pos").select("agenda_item_id", "title").collect()] == [("a", "new")]


def test_upsert_keeps_what_it_must_and_is_idempotent(spark):
    base = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "k string, v string, created int")
    batch = spark.createDataFrame([("b", None), ("c", "z")], "k string, v string")
    once = store.upsert(base, batch, ["k"])
    assert sorted(map(tuple, once.collect()), key=str) == [("a", "x", 1), ("b", None, 2), ("c", "z", None)]
    assert sorted(map(tuple, store.upsert(once, batch, ["k"]).collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_stale_children_only_of_parents_in_the_batch(spark):
    old = spark.createDataFrame([("d1", "i1", ""), ("d1", "i2", ""), ("d2", "i3", "")], ITEM)
    batch = spark.createDataFrame([("d1", "i2", "")], ITEM)
    assert [tuple(r) for r in store.stale_children(old, batch, "document_id", "agenda_item_id").collect()] == [("d1", "i1")]


def test_replace_children_names_repeats(spark):
    old = spark.createDataFrame([("a", "t1"), ("b", "t2")], "agenda_item_id string, topic_tag string")
    new = spark.createDataFrame([("a", "t3")], old.schema)
    assert sorted(map(tuple, store.replace_children(old, new, "agenda_item_id", ["agenda_item_id", "topic_tag"]).collect())) == [("a", "t3"), ("b", "t2")]
    with pytest.raises(ValueError, match="t3"):
        store.replace_children(old, new.unionByName(new), "agenda_item_id", ["agenda_item_id", "topic_tag"])


def test_store_swaps_all_tables_or_none(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "wh"))
    df = spark.createDataFrame([("d", "a", "t")], ITEM)
    assert s.read("items", df.schema).count() == 0
    s.commit({"items": df, "topics": df})
    bad = df.withColumn("title", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        s.commit({"items": df.unionByName(df), "topics": bad})
    assert s.read("items", df.schema).count() == 1
    s.commit({"items": df.unionByName(df)})
    assert (s.read("items", df.schema).count(), s.read("topics", df.schema).count()) == (2, 1)


def test_thinning_is_greedy(spark):
    days = [0, 3, 5, 6, 11, 12, 13]
    df = spark.createDataFrame([("s", datetime.datetime(2026, 1, 1) + datetime.timedelta(days=d)) for d in days], "scope string, ts timestamp")
    assert sorted((r["ts"] - datetime.datetime(2026, 1, 1)).days for r in ranking.thin_snapshots(df, "scope", "ts").collect()) == [0, 6, 12]


def test_negative_limit_is_none_and_items_keep_all_tags(spark):
    cols = "agenda_item_id string, document_id string, source_id string, cluster_name string, meeting_date_iso string, meeting_date string, section_number string, section_title string, item_label string, title string, text_block string"
    items = spark.createDataFrame([("a", "d", "s", "", None, "Wednesday, x", "10", "", "A", "t", "b"), ("b", "d", "s", None, "2026-01-01", None, "2", "", "B", "t", "b")], cols)
    topics = spark.createDataFrame([("a", "t1"), ("a", "t2")], "agenda_item_id string, topic_tag string")
    got = itm.fetch_items(items, topics, itm.ItemFilters(topic="t1", limit=-1)).collect()
    assert [(r["agenda_item_id"], r["topic_tags"]) for r in got] == [("a", ["t1", "t2"])]
    assert [r["agenda_item_id"] for r in itm.fetch_items(items, topics).collect()] == ["a", "b"]
    assert {r["body"]: r["items"] for r in itm.count_by_body(items).collect()} == {"Unknown Cluster": 2}
    assert itm.digest_markdown(itm.fetch_items(items, topics)) == "# Weekly Digest\n\n- Items reviewed: 2\n\n## Clusters\n- Unknown Cluster: 2\n\n## Topics\n- t1: 1\n- t2: 1\n\n## High-Signal Items"
