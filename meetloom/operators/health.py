"""Source health: one grouped pass per table, joined onto the registry of sources."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetloom.functions.exprs import blank_to_null, is_non_blank
from meetloom.functions.files import has_parser_warning


def per_source(table: DataFrame, key: str, **aggregates: Column) -> DataFrame:
    return table.groupBy(key).agg(*[v.alias(k) for k, v in aggregates.items()])


def latest_date(iso: str, display: str) -> Column:
    """The greatest non-blank ISO date, else the greatest non-blank display text."""
    return F.coalesce(F.max(F.when(is_non_blank(F.col(iso)), F.col(iso))), F.max(F.when(is_non_blank(F.col(display)), F.col(display))))


def source_health(sources: DataFrame, key: str, rollups: list[DataFrame], zero: list[str]) -> DataFrame:
    """Every source of the registry with its rollups; missing counts are 0. Rows of unknown sources stay out."""
    out = sources
    for r in rollups:
        out = out.join(r, key, "left")
    return out.fillna(0, zero)


def totals(health: DataFrame, sums: list[str], flags: Mapping[str, Column]) -> DataFrame:
    return health.agg(F.count(F.lit(1)).alias("sources"), *[F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}") for c in sums], *[F.count_if(v).alias(k) for k, v in flags.items()])


def latest_recorded(state: DataFrame, column: str = "recorded_at") -> DataFrame:
    return state.agg(blank_to_null(F.max(column)).alias("latest"))


def recent_agendas(documents: DataFrame, key: str = "document_id", n: int = 10) -> DataFrame:
    """Rows with an ISO date first, newest first; then display date, source, body and the key."""
    dated = is_non_blank(F.col("meeting_date_iso"))
    return documents.orderBy(F.when(dated, 0).otherwise(1), F.col("meeting_date_iso").desc_nulls_last(), F.col("meeting_date").desc_nulls_last(), F.col("source_id").asc_nulls_first(), F.col("cluster_name").asc_nulls_first(), F.col(key)).limit(n)


def result_buckets(results: DataFrame) -> DataFrame:
    """Exclusive buckets of processing results: ready, needs_retry, needs_manual_review, download_failed."""
    bucket = F.when(F.col("processing_status") == "ready", "ready").when(F.col("retryable"), "needs_retry").when(F.col("needs_manual_review"), "needs_manual_review").otherwise("download_failed")
    return results.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("documents"))


HEALTH_COUNTS = ["raw_documents", "structured_documents", "structured_items", "findings", "high_priority_findings", "retry_queue_items", "manual_review_items"]


def health_records(sources: DataFrame, raw: DataFrame, documents: DataFrame, items: DataFrame, findings: DataFrame, state: DataFrame, queues: DataFrame) -> DataFrame:
    """The 17 fields of each registered source: one grouped pass per table, joined onto the registry. queues: source_id and its two counts."""
    n = F.count(F.lit(1))
    rollups = [
        per_source(raw, "source_id", raw_documents=n, latest_document_date=F.max(F.when(is_non_blank(F.col("meeting_date")), F.col("meeting_date")))),
        per_source(documents, "source_id", structured_documents=n, latest_structured_date=latest_date("meeting_date_iso", "meeting_date")),
        per_source(items, "source_id", structured_items=n),
        per_source(findings, "source_id", findings=n, high_priority_findings=F.count_if(F.col("priority_level") == "high")),
        per_source(state, "source_id", latest_refresh_recorded_at=F.max("recorded_at")),
        per_source(queues, "source_id", retry_queue_items=F.sum("retry_queue_items"), manual_review_items=F.sum("manual_review_items")),
    ]
    about = ["source_id", "source_name", "status", "priority_level", "download_root", "structured_output_dir"]
    out = source_health(sources.select(*about, has_parser_warning(F.col("parser")).alias("has_parser_config_warning")), "source_id", rollups, HEALTH_COUNTS)
    return out.select(*about, *HEALTH_COUNTS[:5], "latest_document_date", "latest_structured_date", "latest_refresh_recorded_at", *HEALTH_COUNTS[5:], "has_parser_config_warning")


def health_totals(records: DataFrame) -> DataFrame:
    """One row over all sources: how many, how many active, the sums of the counts, and the parser warnings."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in HEALTH_COUNTS]
    return records.agg(F.count(F.lit(1)).alias("source_count"), F.count_if(F.col("status") == "active").alias("active_source_count"), *sums, F.count_if("has_parser_config_warning").alias("sources_with_parser_config_warnings"))


def queue_lengths(files: DataFrame) -> DataFrame:
    """files (source_id, path, value): entries of the JSON arrays named retry_queue.json and manual_review_queue.json; anything else counts as none."""
    length = F.coalesce(F.json_array_length("value"), F.lit(0))
    of = lambda name: F.sum(F.when(F.col("path").endswith(f"/{name}.json"), length).otherwise(0))
    return files.groupBy("source_id").agg(of("retry_queue").alias("retry_queue_items"), of("manual_review_queue").alias("manual_review_items"))
