"""Stored tables and the ids that link them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meetloom.functions.exprs import blank_to_null, date_iso, stable_id


def _texts(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


_TEXT = ("agenda_item_id", "document_id", "source_id", "source_path", "source_document_id", "meeting_id", "cluster_name", "meeting_date", "meeting_date_iso", "document_role", "section_number", "section_title", "item_label", "item_type", "title", "text_block",
         "action_text_raw", "vote_text_raw", "final_action", "motion_by", "second_by")
_COUNTS = ("ayes_count", "noes_count", "abstain_count", "absent_count")
ITEMS = T.StructType([*_texts(*_TEXT), T.StructField("speakers", T.ArrayType(T.StringType())), *[T.StructField(n, T.IntegerType()) for n in _COUNTS], *[T.StructField(n.replace("count", "members"), T.ArrayType(T.StringType())) for n in _COUNTS]])
TOPICS = T.StructType(_texts("agenda_item_id", "topic_tag"))
#: Parsed documents, raw documents as they were downloaded, and meetings.
DOCUMENTS = T.StructType([*_texts("document_id", "source_id", "source_path", "source_document_id", "meeting_id", "document_role", "cluster_name", "meeting_date", "meeting_date_iso", "structured_json_path"), T.StructField("item_count", T.LongType())])
RAW_DOCUMENTS = T.StructType(_texts("document_id", "source_id", "external_id", "title", "document_type", "meeting_date", "body_name", "jurisdiction", "file_path", "text_path", "sha256", "mime_type", "collected_at"))
MEETINGS = T.StructType(_texts("meeting_id", "source_id", "body_name", "meeting_date", "meeting_date_iso", "meeting_title", "meeting_type", "meeting_status", "jurisdiction", "location_text", "start_time_text"))
FINDINGS = T.StructType(_texts("finding_id", "agenda_item_id", "document_id", "source_id", "cluster_name", "meeting_date", "title", "summary_plain", "why_it_matters", "priority_level", "action_classification", "trend_signal", "evidence_text"))
FINDING_TOPICS = T.StructType(_texts("finding_id", "topic_tag"))
#: Registered sources with the times at which they came and last changed.
SOURCES = T.StructType(_texts("source_id", "source_name", "jurisdiction", "government_level", "body_name", "source_type", "collection_method", "base_url", "meeting_frequency", "priority_level", "status", "adapter", "parser", "notes", "created_at", "updated_at"))
#: What a refresh has seen: one row per source and file.
STATE = T.StructType([*_texts("source_id", "path"), T.StructField("modified", T.TimestampType()), T.StructField("length", T.LongType()), *_texts("recorded_at")])
MEETING_UPDATES = ["source_id", "body_name", "meeting_date", "meeting_date_iso"]


def with_ids(found: DataFrame) -> DataFrame:
    """Ids by content: a document's from its path, an item's from document, label and title (not its section), a meeting's from parser,
    body, date and path. Rows that carry a meeting's id keep it."""
    path = "path" if "path" in found.columns else "source_path"
    for c in ("source_document_id", "meeting_id", "parser"):
        if c not in found.columns:
            found = found.withColumn(c, F.lit(None).cast("string"))
    iso = F.coalesce(blank_to_null(F.col("meeting_date_iso")), date_iso(F.col("meeting_date")))
    meeting = stable_id("meeting_", F.coalesce(blank_to_null(F.col("parser")), F.lit("default")), F.col("cluster_name"), iso, F.col(path))
    document = stable_id("doc_", F.col(path)) if "document_id" not in found.columns else F.coalesce(blank_to_null(F.col("document_id")), stable_id("doc_", F.col(path)))
    found = found.withColumns({"document_id": document, "meeting_id": F.coalesce(blank_to_null(F.col("meeting_id")), meeting), "meeting_date_iso": iso, "document_role": F.coalesce(blank_to_null(F.col("document_role")), F.lit("agenda"))})
    item = stable_id("item_", F.col("document_id"), F.col("item_label"), F.col("title"))
    return found.withColumn("agenda_item_id", item if "agenda_item_id" not in found.columns else F.coalesce(blank_to_null(F.col("agenda_item_id")), item))


def stored_items(found: DataFrame) -> DataFrame:
    """Extracted rows as stored ones, with their position for last-wins."""
    return with_ids(found).withColumnRenamed("path", "source_path").select(*[f.name for f in ITEMS], "pos")


def item_topics(found: DataFrame) -> DataFrame:
    """One row per item row and tag: an id that occurs twice with one tag shows as a repeat, which the import refuses."""
    return with_ids(found).select("agenda_item_id", F.explode("topic_tags").alias("topic_tag"))
