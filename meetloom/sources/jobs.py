"""Batch jobs over the stored tables: import, findings, incremental refresh.

Every job is a set of DataFrame rewrites and one commit, so readers see all of a batch or
none. A refresh reads changed files only, and writes its state last: a failure before that
repeats the work, and a file without items is not tried again until it changes.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meetloom import schemas
from meetloom.extract import kernels
from meetloom.operators import findings as fnd
from meetloom.operators import items as itm
from meetloom.operators.ranking import document_summaries
from meetloom.sources import screening, store

#: Changed files are named to the reader one by one up to this number; beyond it, the whole folder is read and joined.
NAMED_FILES, FINDINGS_LIMIT = 100_000, 10_000


def document_rows(rows: DataFrame) -> DataFrame:
    """Item rows to one row per document: the number of rows, all else from the first."""
    kept = [f.name for f in schemas.DOCUMENTS if f.name in rows.columns and f.name != "document_id"]
    return store.conform(document_summaries(rows, "document_id", "pos", kept), schemas.DOCUMENTS)


def meeting_rows(rows: DataFrame) -> DataFrame:
    """Item rows to one row per meeting, from its first item."""
    first = document_summaries(rows.where("meeting_id is not null").withColumn("at", F.struct("source_path", "pos")), "meeting_id", "at", ["source_id", "cluster_name", "meeting_date", "meeting_date_iso"])
    return store.conform(first.withColumnRenamed("cluster_name", "body_name"), schemas.MEETINGS)


def import_items(tables: store.Store, found: DataFrame) -> dict[str, int]:
    """Merge extracted rows (with source_id): meetings keep what the batch doesn't know, items that a document no longer has go with
    their topics, findings and finding topics, the others are merged, topics are replaced; all in one commit. The rows are extracted
    once and staged; everything else is read from there, so a lost executor extracts nothing again."""
    staged = tables.staged(schemas.with_ids(found))
    rows, topics = schemas.stored_items(staged), schemas.item_topics(staged)
    old = tables.read("items", schemas.ITEMS)
    old_topics, old_findings, old_tags = (tables.read(n, s) for n, s in (("item_topics", schemas.TOPICS), ("findings", schemas.FINDINGS), ("finding_topics", schemas.FINDING_TOPICS)))
    batch = store.last_per_key(rows.withColumn("at", F.col("pos")), ["agenda_item_id"], "at").drop("pos")
    gone = store.stale_children(old, batch, "document_id", "agenda_item_id").select("agenda_item_id")
    gone_findings = old_findings.join(gone, "agenda_item_id", "left_semi").select("finding_id")
    documents = document_rows(rows)
    tables.commit({
        "meetings": store.upsert(tables.read("meetings", schemas.MEETINGS), meeting_rows(rows), ["meeting_id"], schemas.MEETING_UPDATES),
        "documents": store.upsert(tables.read("documents", schemas.DOCUMENTS), documents, ["document_id"]),
        "items": store.upsert(store.without(old, gone, "agenda_item_id"), store.conform(batch, schemas.ITEMS), ["agenda_item_id"]),
        "item_topics": store.replace_children(store.without(old_topics, gone, "agenda_item_id"), topics, "agenda_item_id", ["agenda_item_id", "topic_tag"]),
        "findings": store.without(old_findings, gone, "agenda_item_id"),
        "finding_topics": store.without(old_tags, gone_findings, "finding_id"),
    })
    return {"documents_imported": documents.count(), "items_imported": rows.count(), "topics_imported": topics.count()}


def generate_findings(tables: store.Store, filters: itm.ItemFilters = itm.ItemFilters(limit=FINDINGS_LIMIT)) -> dict[str, int]:
    """Findings of the items that pass, merged into the stored ones; their topics are replaced. Others are untouched."""
    found = itm.fetch_items(tables.read("items", schemas.ITEMS), tables.read("item_topics", schemas.TOPICS), filters)
    made = fnd.generate_findings(found).persist()
    try:
        tags = made.select("finding_id", F.explode("topic_tags").alias("topic_tag"))
        tables.commit({
            "findings": store.upsert(tables.read("findings", schemas.FINDINGS), store.conform(made, schemas.FINDINGS), ["finding_id"]),
            "finding_topics": store.without(tables.read("finding_topics", schemas.FINDING_TOPICS), made.select("finding_id"), "finding_id").unionByName(tags),
        })
        by = {r["priority_level"]: r["count"] for r in made.groupBy("priority_level").count().collect()}
        return {"items_scanned": sum(by.values()), "findings_written": sum(by.values()), "high_priority_findings": by.get("high", 0)}
    finally:
        made.unpersist()


def stored_findings(tables: store.Store) -> DataFrame:
    """Findings with their tags, which are gathered before the join."""
    tags = tables.read("finding_topics", schemas.FINDING_TOPICS).groupBy("finding_id").agg(F.array_sort(F.collect_set("topic_tag")).alias("topic_tags"))
    return tables.read("findings", schemas.FINDINGS).join(tags, "finding_id", "left").withColumn("topic_tags", F.coalesce("topic_tags", F.array().cast("array<string>")))


def read_texts(spark: SparkSession, root: str, paths: DataFrame) -> DataFrame:
    """path, text of the named files. Only they are opened while they are at most NAMED_FILES."""
    named = [r["path"] for r in paths.select("path").limit(NAMED_FILES + 1).collect()]
    if not named:
        return spark.createDataFrame([], "path string, text string")
    few = len(named) <= NAMED_FILES
    files = spark.read.format("binaryFile").load(named) if few else spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(root).join(paths.select("path"), "path", "left_semi")
    return files.select("path", F.decode("content", "UTF-8").alias("text"))


def _refresh(tables: store.Store, source_id: str, state_key: str, root: str, chosen: DataFrame, parser: str | None, with_findings: bool, lineage: DataFrame | None) -> dict:
    state = tables.read("refresh_state", schemas.STATE).where(F.col("source_id") == state_key)
    changed = screening.changed_files(chosen.select("path", "modified", "length"), state.select("path", "modified", "length")).persist()
    try:
        out = {"source_id": source_id, "text_files_discovered": chosen.count(), "new_or_changed_text_files": changed.count(), "documents_written": 0, "items_written": 0, "import_summary": None, "findings_summary": None}
        if not out["new_or_changed_text_files"]:
            return out
        found = kernels.extract_items(read_texts(tables.spark, root, changed).withColumn("parser", F.lit(parser).cast("string"))).withColumn("source_id", F.lit(source_id))
        if lineage is not None:
            found = found.join(lineage, found["path"] == lineage["text_path"], "left").drop("text_path")
        out["import_summary"] = import_items(tables, found)
        out["documents_written"], out["items_written"] = out["import_summary"]["documents_imported"], out["import_summary"]["items_imported"]
        if with_findings:
            out["findings_summary"] = generate_findings(tables, itm.ItemFilters(source_id=source_id, limit=FINDINGS_LIMIT))
        seen = changed.select(F.lit(state_key).alias("source_id"), "path", "modified", "length", F.lit(datetime.now(timezone.utc).isoformat()).alias("recorded_at"))
        tables.commit({"refresh_state": store.upsert(tables.read("refresh_state", schemas.STATE), seen, ["source_id", "path"])})
        return out
    finally:
        changed.unpersist()


def refresh_source(tables: store.Store, source_id: str, root: str, parser: str | None = None, with_findings: bool = True) -> dict:
    """Extract and import the agenda files below root that are new or changed since the last run."""
    files = screening.screened(screening.list_files(tables.spark, root), parser=parser)
    left_out = {r["reason"]: r["paths"] for r in files.where("reason <> 'included'").groupBy("reason").agg(F.count(F.lit(1)).alias("paths")).collect()}
    out = _refresh(tables, source_id, source_id, root, files.where("reason = 'included'"), parser, with_findings, None)
    return out | {"text_files_screened_out": sum(left_out.values()), "screened_out_breakdown": left_out}


def refresh_supporting(tables: store.Store, source_id: str, root: str, with_findings: bool = True) -> dict:
    """The same for supporting documents, which keep the id of the raw document that they are the text of."""
    return _refresh(tables, source_id, f"{source_id}.supporting", root, screening.supporting_files(screening.list_files(tables.spark, root)), kernels.SUPPORTING, with_findings, raw_lineage(tables, source_id))


def raw_lineage(tables: store.Store, source_id: str) -> DataFrame:
    """text_path, source_document_id of a source's raw documents with a text; of documents that share a path, the greatest id."""
    raw = tables.read("raw_documents", schemas.RAW_DOCUMENTS).where((F.col("source_id") == source_id) & (F.trim("text_path") != ""))
    return raw.groupBy("text_path").agg(F.max("document_id").alias("source_document_id"))


def store_sources(tables: store.Store, sources: DataFrame, now: datetime | None = None) -> int:
    """Merge the registry's rows into the stored sources: created_at stays, updated_at moves only where a row has changed, and only touched
    buckets are rewritten; how many there were."""
    stamp = F.lit((now or datetime.now(timezone.utc)).isoformat())
    rows = sources.select(*[(F.col(f.name).cast("string") if f.name in sources.columns else F.lit(None).cast("string")).alias(f.name) for f in schemas.SOURCES if f.name not in ("created_at", "updated_at")])
    return tables.merge("sources", schemas.SOURCES, rows, ["source_id"], lambda old, new: store.upsert_stamped(old, new, ["source_id"], stamp))


def upsert_raw_documents(tables: store.Store, batch: DataFrame, reuse_ids_by_file: bool = False) -> None:
    """Merge raw documents on their id; of equal ids in the batch the last row wins (by `pos` where it has one, else in the batch's own order).
    With reuse_ids_by_file a row takes the id of a stored row of the same source and file."""
    old = tables.read("raw_documents", schemas.RAW_DOCUMENTS)
    place = F.col("pos") if "pos" in batch.columns else F.monotonically_increasing_id()
    rows = batch.withColumn("place", place).select("place", *[(F.col(f.name) if f.name in batch.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.RAW_DOCUMENTS])
    if reuse_ids_by_file:
        one_id_a_file(rows)
        rows = with_known_ids(old, rows)
    tables.commit({"raw_documents": store.upsert(old, store.last_per_key(rows, ["document_id"], "place"), ["document_id"])})


def with_known_ids(old: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows with the id of the stored row of the same source and file."""
    known = old.where("file_path is not null").groupBy("source_id", "file_path").agg(F.min("document_id").alias("known_id"))
    return batch.join(known, ["source_id", "file_path"], "left").withColumn("document_id", F.coalesce("known_id", "document_id")).select(*batch.columns)


def one_id_a_file(batch: DataFrame) -> None:
    """Files that come under several ids at once would become one document; they raise and name themselves."""
    clash = batch.where("file_path is not null").groupBy("source_id", "file_path").agg(F.count_distinct("document_id").alias("ids")).where("ids > 1").limit(5).collect()
    if clash:
        raise ValueError(f"several documents of one file: {', '.join(r['source_id'] + ' ' + r['file_path'] for r in clash)}")


def structured_documents(found: DataFrame) -> DataFrame:
    """Extracted rows as one nested row per document, items in order; write with .write.json."""
    rows = schemas.with_ids(found)
    about = ["document_id", "source_id", "path", "meeting_id", "document_role", "cluster_name", "meeting_date", "meeting_date_iso"]
    item = F.struct("pos", *[c for c in rows.columns if c not in about and c != "pos"])
    return rows.groupBy(*about).agg(F.count(F.lit(1)).alias("item_count"), F.sort_array(F.collect_list(item)).alias("items"))


def read_items_index(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of item rows; keys that lack are null, rows keep their place."""
    from pyspark.sql import types as T

    schema = T.StructType([*schemas.ITEMS.fields, T.StructField("topic_tags", T.ArrayType(T.StringType()))])
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", T.ArrayType(schema))).alias("pos", "r")).select("pos", "r.*")
    return rows.withColumn("topic_tags", F.coalesce("topic_tags", F.array().cast("array<string>")))


def items_index(tables: store.Store, source_id: str | None = None) -> DataFrame:
    """Stored items with their tags, as rows of an index; write with .write.json, and read with read_items_index."""
    items = tables.read("items", schemas.ITEMS)
    items = items if source_id is None else items.where(F.col("source_id") == source_id)
    tags = tables.read("item_topics", schemas.TOPICS).groupBy("agenda_item_id").agg(F.array_sort(F.collect_set("topic_tag")).alias("topic_tags"))
    return items.join(tags, "agenda_item_id", "left").withColumn("topic_tags", F.coalesce("topic_tags", F.array().cast("array<string>")))


def ingest_messages(tables: store.Store, messages: DataFrame, source_id: str, fetcher) -> dict:
    """City notices: their documents are stored, the meeting pages they point to fetched once and kept, and the pages' items imported."""
    from meetloom.sources import downloads, fetch, mail

    notes = tables.staged(mail.notice_documents(messages))
    text = F.lit(None).cast("string")
    raw = notes.select(F.concat(F.lit("doc_"), F.substring(F.sha1("external_id"), 1, 16)).alias("document_id"), F.lit(source_id).alias("source_id"), "external_id", F.col("body_name").alias("title"), F.when(F.col("is_cancellation"), "meeting_cancellation_notice").otherwise("agenda_notice").alias("document_type"), "meeting_date", "body_name", text.alias("file_path"), "mime_type")
    upsert_raw_documents(tables, raw)
    kept = f"{tables.root}/pages"
    got = fetch.processed(downloads.download(mail.notice_links(notes.where("not is_cancellation")), fetcher, kept, url="page_url"))
    pages = downloads.contents(got.where("sha256 is not null").select("url", "sha256"), kept).select(F.col("url").alias("path"), F.decode("content", "UTF-8").alias("text"), F.lit(kernels.PRIMEGOV).alias("parser"))
    imported = import_items(tables, kernels.extract_items(pages).withColumn("source_id", F.lit(source_id)))
    counted = got.agg(F.count_if(F.col("sha256").isNotNull()).alias("ok"), F.count_if(F.col("sha256").isNull()).alias("bad")).first()
    return {"notices": notes.count(), "pages_fetched": counted["ok"], "pages_failed": counted["bad"], "import_summary": imported}
