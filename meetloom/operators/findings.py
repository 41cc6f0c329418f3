"""Scored findings from items, and reads over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetloom.functions import exprs, rules
from meetloom.operators.items import limited


@dataclass(frozen=True)
class FindingFilters:
    source_id: str | None = None
    topic: str | None = None
    cluster: str | None = None
    meeting_date: str | None = None
    priority: str | None = None
    search: str | None = None
    limit: int = 50


def generate_findings(items: DataFrame, high: Sequence[str] = rules.HIGH_PRIORITY_TOPICS, explanations: Mapping[str, str] = rules.TOPIC_EXPLANATIONS, keywords: Sequence[str] = rules.HIGH_PRIORITY_KEYWORDS) -> DataFrame:
    """One finding per item: projections only, no shuffle; the lowered text is made once."""
    title, text, tags, low = F.col("title"), F.col("text_block"), F.col("topic_tags"), F.col("lowered_text")
    acted = items.withColumn("lowered_text", exprs.lowered(title, text)).withColumn("action_classification", exprs.action_class(low, F.col("section_title")))
    action = F.col("action_classification")
    scored = acted.withColumns({"priority_level": exprs.priority(low, tags, action, high, keywords), "trend_signal": exprs.trend_signal(low, tags, action, high)})
    return scored.select(
        exprs.stable_id("finding_", F.col("agenda_item_id")).alias("finding_id"), "agenda_item_id", "document_id", "source_id", "cluster_name", "meeting_date", "title",
        exprs.summary_plain(F.col("cluster_name"), F.col("item_label"), action, title).alias("summary_plain"),
        exprs.why_it_matters(tags, F.col("priority_level"), explanations).alias("why_it_matters"),
        "priority_level", "action_classification", "trend_signal", text.alias("evidence_text"), F.array_sort(F.array_distinct(tags)).alias("topic_tags"),
    )


def finding_order() -> list[Column]:
    """High, medium, the rest; then the display date as text, newest first; then body, title and id."""
    rank = F.when(F.col("priority_level") == "high", 0).when(F.col("priority_level") == "medium", 1).otherwise(2)
    return [rank.asc(), F.col("meeting_date").desc_nulls_last(), F.col("cluster_name").asc_nulls_first(), F.col("title").asc_nulls_first(), F.col("finding_id").asc()]


def fetch_findings(findings: DataFrame, filters: FindingFilters = FindingFilters()) -> DataFrame:
    for column, value in (("source_id", filters.source_id), ("cluster_name", filters.cluster), ("meeting_date", filters.meeting_date), ("priority_level", filters.priority)):
        if value:
            findings = findings.where(F.col(column) == value)
    if filters.topic:
        findings = findings.where(F.array_contains("topic_tags", filters.topic))
    if filters.search:
        findings = findings.where(exprs.contains_like(F.col("title"), filters.search) | exprs.contains_like(F.col("summary_plain"), filters.search) | exprs.contains_like(F.col("why_it_matters"), filters.search))
    return limited(findings.orderBy(*finding_order()), filters.limit)


def top_findings(findings: DataFrame, n: int = 10) -> DataFrame:
    """The dashboard's list: priority, the display date as text, source, title."""
    rank = finding_order()[0]
    found = findings.orderBy(rank, F.col("meeting_date").desc_nulls_last(), F.col("source_id").asc_nulls_first(), F.col("title").asc_nulls_first(), F.col("finding_id").asc()).limit(n)
    return found.select("finding_id", "source_id", F.col("cluster_name").alias("body_name"), "meeting_date", "title", "summary_plain", "priority_level", "trend_signal")
