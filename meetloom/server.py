"""A small read-only HTTP dashboard over the stored tables."""

from __future__ import annotations

import json
import mimetypes
import os
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import unquote

from pyspark.sql import functions as F

from meetloom import schemas
from meetloom.operators import findings, health
from meetloom.sources import jobs
from meetloom.sources.config import config_rows
from meetloom.sources.store import Store


def summary(tables: Store, configs: list[dict] | None = None) -> dict:
    """Totals, a record of each source, the ten latest agendas and the ten most pressing findings; all small by construction.
    Without a registry, the sources are those that have items."""
    spark = tables.spark
    items = tables.read("items", schemas.ITEMS)
    if configs is None:
        configs = [{"source_id": r["source_id"], "status": "active"} for r in items.select("source_id").distinct().orderBy("source_id").collect()]
    queues = health.queue_lengths(queue_files(spark, configs))
    documents = tables.read("documents", schemas.DOCUMENTS)
    records = health.health_records(config_rows(spark, configs), tables.read("raw_documents", schemas.RAW_DOCUMENTS), documents, items, tables.read("findings", schemas.FINDINGS), tables.read("refresh_state", schemas.STATE), queues).persist()
    try:
        totals = health.health_totals(records).first().asDict()
        recent = health.recent_agendas(documents).select("document_id", "source_id", "cluster_name", "meeting_date", "meeting_date_iso", "item_count")
        lists = {"sources": records.orderBy("source_id"), "recent_agendas": recent, "top_findings": findings.top_findings(jobs.stored_findings(tables))}
        return totals | {name: [r.asDict() for r in df.collect()] for name, df in lists.items()}
    finally:
        records.unpersist()


def queue_files(spark, configs: list[dict]):
    """source_id, path, value of the queue files below each source's download folder, where there is one."""
    out = spark.createDataFrame([], "source_id string, path string, value string")
    for c in configs:
        if (root := c.get("download_root")) and os.path.isdir(root):
            found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "{retry_queue,manual_review_queue}.json").load(str(root))
            out = out.unionByName(found.select(F.lit(c["source_id"]).alias("source_id"), "path", F.decode("content", "UTF-8").alias("value")))
    return out


def static_file(root: str | None, path: str) -> tuple[int, bytes, str]:
    """Status, content and type of a file below root: 403 for paths that lead out of it, 404 for what isn't there."""
    if not root:
        return 404, b"", "text/plain"
    base = os.path.realpath(root)
    target = os.path.realpath(os.path.join(base, unquote(path).lstrip("/") or "index.html"))
    if os.path.commonpath([base, target]) != base:
        return 403, b"", "text/plain"
    if not os.path.isfile(target):
        return 404, b"", "text/plain"
    with open(target, "rb") as f:
        return 200, f.read(), mimetypes.guess_type(target)[0] or "application/octet-stream"


def server(read: Callable[[], dict], host: str = "127.0.0.1", port: int = 0, static_root: str | None = None) -> ThreadingHTTPServer:
    """GET /health, /api/health, /api/summary and files below static_root. A failing read is 500."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:  # noqa: N802
            path, kind = self.path.split("?")[0], "application/json"
            try:
                if path in ("/health", "/api/health"):
                    status, raw = 200, json.dumps({"status": "ok"}).encode()
                elif path == "/api/summary":
                    status, raw = 200, json.dumps(read(), default=str).encode()
                else:
                    status, raw, kind = static_file(static_root, path)
                    if status != 200:
                        raw, kind = json.dumps({"error": "forbidden" if status == 403 else "not found"}).encode(), "application/json"
            except Exception as e:  # the client is told, the server goes on
                status, raw = 500, json.dumps({"error": type(e).__name__}).encode()
            self.send_response(status)
            self.send_header("Content-Type", kind)
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

        def log_message(self, *args) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)
