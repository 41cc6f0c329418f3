"""Filtered item reads, their order, and the summaries over them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetloom.functions import rules
from meetloom.functions.exprs import contains_like, or_label


@dataclass(frozen=True)
class ItemFilters:
    """Empty and None mean no filter; a negative limit means none."""

    source_id: str | None = None
    topic: str | None = None
    cluster_name: str | None = None
    meeting_date: str | None = None
    meeting_date_iso: str | None = None
    motion_by: str | None = None
    second_by: str | None = None
    final_action: str | None = None
    search: str | None = None
    limit: int = 50

    EQUAL = ("source_id", "cluster_name", "meeting_date", "meeting_date_iso", "motion_by", "second_by", "final_action")


def limited(df: DataFrame, limit: int) -> DataFrame:
    return df if limit < 0 else df.limit(limit)


def item_order() -> list[Column]:
    """Newest first by ISO date, else display date; then body, section and label as text, and the id."""
    newest = F.coalesce("meeting_date_iso", "meeting_date")
    return [newest.desc_nulls_last(), *(F.col(c).asc_nulls_first() for c in ("cluster_name", "section_number", "item_label", "agenda_item_id"))]


def tags_of(topics: DataFrame, key: str = "agenda_item_id") -> DataFrame:
    return topics.groupBy(key).agg(F.array_sort(F.collect_set("topic_tag")).alias("topic_tags"))


def fetch_items(items: DataFrame, topics: DataFrame, filters: ItemFilters = ItemFilters()) -> DataFrame:
    """Filtered, ordered and limited items with all their tags. Tags are aggregated before the join; the topic filter is a semi join."""
    for c in ItemFilters.EQUAL:
        if getattr(filters, c):
            items = items.where(F.col(c) == getattr(filters, c))
    if filters.search:
        items = items.where(contains_like(F.col("title"), filters.search) | contains_like(F.col("text_block"), filters.search))
    if filters.topic:
        items = items.join(topics.where(F.col("topic_tag") == filters.topic), "agenda_item_id", "left_semi")
    none = F.array().cast("array<string>")
    found = limited(items.orderBy(*item_order()), filters.limit) if filters.limit >= 0 else items
    # The limit comes first: only the rows that stay meet their tags; topics come from a table of their own.
    with_tags = found.join(tags_of(topics.join(found.select("agenda_item_id"), "agenda_item_id", "left_semi")), "agenda_item_id", "left")
    return with_tags.withColumn("topic_tags", F.coalesce("topic_tags", none)).orderBy(*item_order())


def count_by_topic(items: DataFrame) -> DataFrame:
    return items.select(F.explode("topic_tags").alias("topic_tag")).groupBy("topic_tag").agg(F.count(F.lit(1)).alias("items")).orderBy(F.desc("items"), "topic_tag")


def count_by_body(items: DataFrame) -> DataFrame:
    return items.groupBy(or_label(F.col("cluster_name"), "Unknown Cluster").alias("body")).agg(F.count(F.lit(1)).alias("items")).orderBy(F.desc("items"), "body")


def parliamentary_counts(items: DataFrame) -> DataFrame:
    """One row: items with a mover, a seconder, a final action and a vote; unanimous and split votes."""
    given = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    voted = F.col("ayes_count").isNotNull()
    whole = voted & (F.coalesce("noes_count", F.lit(0)) == 0) & (F.coalesce("abstain_count", F.lit(0)) == 0)
    return items.agg(
        F.count_if(given("motion_by")).alias("with_motion"), F.count_if(given("second_by")).alias("with_second"), F.count_if(given("final_action")).alias("with_action"),
        F.count_if(voted).alias("with_vote"), F.count_if(whole).alias("unanimous"), F.count_if(voted & ~whole).alias("split"),
    )


def ranked(items: DataFrame, column: str) -> DataFrame:
    """Counts of a column's non-empty values, most first."""
    return items.where(F.col(column) != "").groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("items")).orderBy(F.desc("items"), "value")


def high_signal(items: DataFrame, topics: list[str] = rules.DIGEST_TOPICS, n: int = 10) -> DataFrame:
    """The first n items in list order that have one of the topics."""
    return items.where(F.arrays_overlap("topic_tags", F.array(*map(F.lit, topics)))).orderBy(*item_order()).limit(n)


def digest_markdown(items: DataFrame) -> str:
    """A digest of an already limited read, as Markdown; null fields read None, and there is no line feed at the end."""
    held = items.persist()
    try:
        parts = [["# Weekly Digest"], [f"- Items reviewed: {held.count()}"]]
        parts.append(["## Clusters", *(f"- {r['body']}: {r['items']}" for r in count_by_body(held).collect())])
        parts.append(["## Topics", *(f"- {r['topic_tag']}: {r['items']}" for r in count_by_topic(held).collect())])
        parts.append(["## High-Signal Items", *(f"- {r['meeting_date']} | {r['cluster_name']} | {r['title']}" for r in high_signal(held).collect())])
        return "\n\n".join("\n".join(x) for x in parts)
    finally:
        held.unpersist()


def count_by(rows: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column, in order of the value."""
    return rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.asc_nulls_first("value"))
