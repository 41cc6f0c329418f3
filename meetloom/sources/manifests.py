"""Manifests and folders compared both ways, and counts of tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MATCHED, MISSING, ORPHANED, CHANGED = "matched", "missing", "orphaned", "changed"


def reconcile(manifest: DataFrame, folder: DataFrame, key: str = "path", mark: str = "sha256") -> DataFrame:
    """key, state, the manifest's mark, the folder's mark: one full outer join says which entries have their file, which lack it, which files no
    entry names, and which have another mark. An entry without a mark is matched by its file alone; of repeated entries the least mark counts."""
    said = manifest.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(mark).alias("said"), F.lit(True).alias("in_manifest"))
    held = folder.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(mark).alias("held"), F.lit(True).alias("in_folder"))
    state = F.when(F.col("in_folder").isNull(), MISSING).when(F.col("in_manifest").isNull(), ORPHANED).when(F.col("said") != F.col("held"), CHANGED).otherwise(MATCHED)
    return said.join(held, key, "full_outer").select(key, state.alias("state"), "said", "held")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a manifest, one JSON object with `documents`, a byte order mark or none."""
    fields = ("sds_doc_id", "title", "sds_title", "meeting_date", "source_url", "sds_published_url", "local_path")
    text = F.regexp_replace("value", "^\ufeff", "")
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json(text, f"documents array<struct<{', '.join(f'{f}: string' for f in fields)}>>")["documents"]).alias("pos", "d"))
    return rows.select("pos", "d.*").withColumnRenamed("local_path", "path")


def folder_marks(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path (without scheme), sha256, length of the files below a folder, hashed where they are read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return rows.select(F.regexp_replace("path", "^file:/*", "/").alias("path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes_downloaded"))


def proceedings_documents(manifest: DataFrame, folder: DataFrame, source_id: str) -> tuple[DataFrame, DataFrame]:
    """(raw documents, missing paths) of a manifest whose files lie in a folder; missing ones are told, not fatal."""
    blank = lambda c: F.nullif(F.trim(F.coalesce(F.col(c), F.lit(""))), F.lit(""))
    joined = manifest.withColumn("path", F.coalesce("path", F.lit(""))).join(folder, "path", "left")
    stem = F.regexp_replace(F.regexp_extract("path", "([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    number = F.coalesce(blank("sds_doc_id"), stem)
    external = F.concat(F.lit("bos_sop:"), number)
    rows = joined.where("sha256 is not null").select(
        "pos", F.concat(F.lit("doc_"), F.substring(F.sha1(external.cast("binary")), 1, 16)).alias("document_id"), F.lit(source_id).alias("source_id"), external.alias("external_id"), F.coalesce(blank("title"), blank("sds_title"), stem).alias("title"),
        F.lit("statement_of_proceedings").alias("document_type"), "meeting_date", F.col("path").alias("file_path"), "sha256", F.lit("application/pdf").alias("mime_type"))
    return rows, joined.where("sha256 is null").select("path")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, table_rows of each table in one job. A count needs no column, so Parquet files are read no further than their footers."""
    parts = [df.select(F.lit(name).alias("table_name")).groupBy("table_name").agg(F.count(F.lit(1)).alias("n")) for name, df in tables.items()]
    named = next(iter(tables.values())).sparkSession.createDataFrame([(n,) for n in tables], "table_name string")
    counted = parts[0]
    for p in parts[1:]:
        counted = counted.unionByName(p)
    return F.broadcast(named).join(counted, "table_name", "left").select("table_name", F.coalesce("n", F.lit(0)).alias("table_rows"))
