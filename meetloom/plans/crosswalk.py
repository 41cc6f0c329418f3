"""The driver's tables in the roles of the document engine's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meetloom.functions import exprs, rules


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as agenda items: the first line is the title, the language the body, the source's rest the section."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("agenda_item_id"), (F.col("doc_id") % 97).alias("document_id"), F.col("source").alias("source_id"), F.col("lang").alias("cluster_name"),
        F.lit(None).cast("string").alias("meeting_date_iso"), (F.col("n_chars") % 31).cast("string").alias("meeting_date"), (F.col("n_chars") % 7).cast("string").alias("section_number"),
        F.col("source").alias("section_title"), (F.col("doc_id") % 5).cast("string").alias("item_label"), F.split("text", "\n")[0].alias("title"), F.col("text").alias("text_block"),
    )


#: The same projection for DuckDB.
ITEMS_SQL = """SELECT doc_id AS agenda_item_id, doc_id % 97 AS document_id, source AS source_id, lang AS cluster_name, NULL::VARCHAR AS meeting_date_iso,
 (n_chars % 31)::VARCHAR AS meeting_date, (n_chars % 7)::VARCHAR AS section_number, source AS section_title, (doc_id % 5)::VARCHAR AS item_label,
 split_part(text, chr(10), 1) AS title, text AS text_block FROM documents"""


def topics(rows: DataFrame) -> DataFrame:
    return rows.select("agenda_item_id", F.explode(exprs.topic_tags(F.col("text_block"), rules.DEMO_RULES)).alias("topic_tag"))


def tags_sql() -> str:
    """The demo rules as a sorted DuckDB list over text_block."""
    hits = [f"CASE WHEN {' OR '.join(f"contains(lower(text_block), '{w}')" for w in words)} THEN '{tag}' END" for tag, words in sorted(rules.DEMO_RULES.items())]
    return f"list_filter([{', '.join(hits)}], lambda x: x IS NOT NULL)"
