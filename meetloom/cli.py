"""Command line over stored tables, text files, messages, the source registry and the source log."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meetloom import schemas
from meetloom.extract import kernels
from meetloom.operators import findings, items
from meetloom.sources import config, dispatch, downloads, fetch, frontier, jobs, mail, manifests, registry_log, screening, store

ABOUT = "meetloom: items, topics and findings from public-meeting documents, on Spark"


def session() -> SparkSession:
    spark = SparkSession.builder.appName("meetloom").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def show(df: DataFrame) -> None:
    """One JSON object a line, streamed a partition at a time; null fields are left out."""
    for r in df.select(F.to_json(F.struct(*df.columns)).alias("j")).toLocalIterator():
        print(r["j"])


def say(value) -> None:
    print(json.dumps(value, indent=2, default=str))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="meetloom", description=__doc__)
    top.add_argument("--store", default="warehouse", help="root of the stored tables")
    top.add_argument("--config-dir", default="configs/sources", help="folder of the registry's files")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, about: str, *options: str, limit: int | None = None, flags: tuple[str, ...] = ()) -> None:
        c = sub.add_parser(name, help=about)
        for o in options:
            c.add_argument(o)
        for f in flags:
            c.add_argument(f, action="store_true")
        if limit is not None:
            c.add_argument("--limit", type=int, default=limit)

    dated = ("--meeting-date", "--meeting-date-iso")
    item_filters = ("--source-id", "--topic", "--cluster", *dated, "--motion-by", "--second-by", "--final-action", "--search")
    command("about", "what this is")
    command("list-parsers", "names of the parsers")
    command("list-sources", "the registry")
    command("list-items", "filtered items", *item_filters, limit=50)
    command("weekly-digest", "digest of filtered items as Markdown", *item_filters, limit=100)
    command("parliamentary-summary", "movers, actions and votes of filtered items", *item_filters, limit=500)
    command("generate-findings", "make and store the findings of filtered items", *item_filters, limit=jobs.FINDINGS_LIMIT)
    command("list-findings", "filtered stored findings", "--source-id", "--topic", "--cluster", "--meeting-date", "--priority", "--search", limit=50)
    command("extract-items", "items of text files", "root", "--parser")
    command("persist-items", "structured documents of text files as JSON below a folder", "root", "out", "--parser")
    command("import-items", "extract text files and import their items", "root", "source_id", "--parser")
    command("import-structured-items", "import a JSON array of items", "index", "source_id")
    command("screen-files", "files left out, and why", "root", "--parser")
    command("backfill-structured-dates", "recompute ISO dates of stored items, documents and meetings")
    command("refresh-source", "import agenda files that are new or changed", "source_id", "--root", "--parser", flags=("--skip-findings",))
    command("refresh-supporting-docs", "import supporting documents that are new or changed", "source_id", "--root", flags=("--skip-findings",))
    command("dashboard-summary", "totals, source records, latest agendas, top findings", flags=("--registered",))
    command("serve-dashboard", "the summary over HTTP", "--host", "--port", "--static", flags=("--registered",))
    command("validate-source-log", "problems of a source log", "path")
    command("list-source-log", "sources of a log", "path", "--status", "--activation-stage", "--collection-role")
    command("sync-source-config", "take a source's address over from the log", "path", "source_ref", flags=("--write",))
    command("activate-source", "make a source's folder and take its address over", "path", "source_ref", flags=("--write",))
    command("inspect-message", "kind, date, links and notices of message files", "path", "--sender", "--county")
    command("download-message-links", "fetch what messages link to and write manifest and queues", "path", "out")
    command("ingest-message", "store notices, fetch their meeting pages, import the items", "path", "source_id")
    command("check-online-source", "plan what a log's sources have put online, fetch it once, refresh the sources", "path", "source_ref", "--today", "--root", "--job", flags=("--download-only", "--skip-findings"))
    command("backfill-ceo-supporting-docs", "follow the links of downloaded agendas to their supporting documents", "agendas", "out", flags=("--inventory-only",))
    command("import-manifest", "raw documents of a download manifest whose files are there", "path", "source_id", "--root")
    command("write-items-index", "stored items with their tags as JSON lines", "out", "--source-id")
    command("db-counts", "rows of the stored tables")
    command("store-sources", "put the registry into the stored sources")
    command("vacuum", "remove versions that no recent commit names")
    return top


def texts_below(spark: SparkSession, root: str, named: str | None) -> DataFrame:
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt").withColumn("path", F.input_file_name())
    return screening.screened(files, parser=named).where("reason not in ('cancellation_notice', 'non_canonical_companion')").select("path", F.col("value").alias("text"), F.lit(named).cast("string").alias("parser"))


def item_filters(a: argparse.Namespace) -> items.ItemFilters:
    return items.ItemFilters(source_id=a.source_id, topic=a.topic, cluster_name=a.cluster, meeting_date=a.meeting_date, meeting_date_iso=a.meeting_date_iso, motion_by=a.motion_by, second_by=a.second_by, final_action=a.final_action, search=a.search, limit=a.limit)


def without_session(a: argparse.Namespace) -> int | None:
    """Commands that need no Spark; None for the others."""
    if a.command == "about":
        print(ABOUT)
    elif a.command == "list-parsers":
        kernels.detect_parser("", "")
        print("\n".join(sorted(kernels.PARSERS)))
    elif a.command == "list-sources":
        say([{k: c.get(k) for k in ("source_id", "source_name", "status", "parser")} for c in config.load_configs(a.config_dir)])
    elif a.command == "validate-source-log":
        found = registry_log.counts(registry_log.load(a.path))
        say(found)
        return int(not found["valid"])
    elif a.command in ("sync-source-config", "activate-source"):
        say((config.sync_from_log if a.command == "sync-source-config" else config.activate)(registry_log.load(a.path), a.config_dir, a.source_ref, a.write))
    else:
        return None
    return 0


def refreshed(a: argparse.Namespace, tables: store.Store) -> dict:
    """Root and parser as given, else as registered."""
    known = {} if a.root else config.config_of(a.config_dir, a.source_id)
    root = a.root or known["download_root"]
    if a.command == "refresh-supporting-docs":
        return jobs.refresh_supporting(tables, a.source_id, root, not a.skip_findings)
    return jobs.refresh_source(tables, a.source_id, root, a.parser or known.get("parser"), not a.skip_findings)


def backfilled(tables: store.Store) -> dict[str, int]:
    out, changed = {}, {}
    for name, schema in (("items", schemas.ITEMS), ("documents", schemas.DOCUMENTS), ("meetings", schemas.MEETINGS)):
        dated = store.backfill_dates(tables.read(name, schema))
        out[name], changed[name] = dated.drop("changed"), dated.where("changed").count()
    tables.commit(out)
    return changed


def online(a: argparse.Namespace, tables: store.Store, fetcher: fetch.Fetcher) -> dict:
    """One source of a log (or all, by 'all'): planned, worked off, refreshed where it is registered."""
    entries = [s for s in registry_log.load(a.path).get("sources", []) if a.source_ref in ("all", s.get("source_ref"))]
    if not entries:
        raise KeyError(f"unknown source_ref: {a.source_ref}")
    today = date.fromisoformat(a.today) if a.today else date.today()
    root = a.root or f"{tables.root}/files"
    out = dispatch.check_online(tables, fetcher, entries, today, root, a.job or f"online-{today.isoformat()}")
    out["refreshed"] = [] if a.download_only else [jobs.refresh_source(tables, c["source_id"], c["download_root"], c.get("parser"), not a.skip_findings) for c in config.load_configs(a.config_dir) if c.get("source_id") in {e.get("current_source_id") for e in entries}]
    fetch.write_summary(tables.spark, f"{root}/online_manifest.json", out)
    return out


def backfilled_documents(a: argparse.Namespace, tables: store.Store, fetcher: fetch.Fetcher) -> dict[str, int]:
    """Supporting documents of agendas given as JSON lines (external_id, url, text, links)."""
    agendas = tables.spark.read.schema("external_id string, url string, text string, links array<string>").json(a.agendas)
    found = agendas.select(F.explode(F.array_distinct(F.coalesce("links", F.array().cast("array<string>")))).alias("url")).where(frontier.trusted(F.col("url")))
    counts = {"agenda_documents_considered": agendas.count(), "trusted_supporting_links_discovered": found.count(), "supporting_documents_downloaded": 0, "review_target_count": 0}
    if a.inventory_only:
        return counts
    documents, review = frontier.supporting_documents(agendas, frontier.fetched(fetcher, f"{a.out}/files"))
    documents.write.mode("overwrite").json(f"{a.out}/supporting_documents")
    review.write.mode("overwrite").json(f"{a.out}/review_targets")
    counts |= {"supporting_documents_downloaded": documents.count(), "review_target_count": review.count()}
    fetch.write_summary(tables.spark, f"{a.out}/backfill_manifest.json", counts)
    return counts


def imported_manifest(a: argparse.Namespace, tables: store.Store) -> dict[str, int]:
    entries = manifests.read_manifest(tables.spark, a.path)
    rows, missing = manifests.proceedings_documents(entries, manifests.folder_marks(tables.spark, a.root or a.path.rpartition("/")[0], "*.pdf"), a.source_id)
    rows = tables.staged(rows)
    jobs.upsert_raw_documents(tables, rows)
    counts = {"documents_imported": rows.count(), "missing_files": missing.count()}
    fetch.write_summary(tables.spark, f"{a.path.rpartition('/')[0]}/import_manifest.json", counts | {"input_manifest_path": a.path, "missing": [r["path"] for r in missing.limit(1000).collect()]})
    return counts


def summed_up(a: argparse.Namespace, tables: store.Store) -> dict:
    from meetloom.server import summary

    return summary(tables, config.load_configs(a.config_dir) if a.registered else None)


def main(argv: list[str] | None = None, fetcher: fetch.Fetcher = fetch.over_http) -> int:
    a = parser().parse_args(argv)
    if (code := without_session(a)) is not None:
        return code
    spark = session()
    tables = store.Store(spark, a.store)
    read = lambda: items.fetch_items(tables.read("items", schemas.ITEMS), tables.read("item_topics", schemas.TOPICS), item_filters(a))
    if a.command == "list-items":
        show(read())
    elif a.command == "weekly-digest":
        print(items.digest_markdown(read()))
    elif a.command == "parliamentary-summary":
        found = read()
        show(items.parliamentary_counts(found))
        for column in ("motion_by", "second_by", "final_action"):
            show(items.ranked(found, column))
    elif a.command == "generate-findings":
        say(jobs.generate_findings(tables, item_filters(a)))
    elif a.command == "list-findings":
        show(findings.fetch_findings(jobs.stored_findings(tables), findings.FindingFilters(a.source_id, a.topic, a.cluster, a.meeting_date, a.priority, a.search, a.limit)))
    elif a.command == "list-source-log":
        show(registry_log.listing(spark, registry_log.load(a.path), status=a.status, activation_stage=a.activation_stage, collection_role=a.collection_role))
    elif a.command == "screen-files":
        show(screening.screening_breakdown(screening.list_files(spark, a.root), parser=a.parser))
    elif a.command == "extract-items":
        show(kernels.extract_items(texts_below(spark, a.root, a.parser)))
    elif a.command == "persist-items":
        found = kernels.extract_items(texts_below(spark, a.root, a.parser)).withColumn("source_id", F.lit(None).cast("string"))
        jobs.structured_documents(found).write.mode("overwrite").json(a.out)
    elif a.command == "import-items":
        say(jobs.import_items(tables, kernels.extract_items(texts_below(spark, a.root, a.parser)).withColumn("source_id", F.lit(a.source_id))))
    elif a.command == "import-structured-items":
        say(jobs.import_items(tables, jobs.read_items_index(spark, a.index).withColumn("source_id", F.lit(a.source_id))))
    elif a.command == "backfill-structured-dates":
        say(backfilled(tables))
    elif a.command in ("refresh-source", "refresh-supporting-docs"):
        say(refreshed(a, tables))
    elif a.command == "dashboard-summary":
        say(summed_up(a, tables))
    elif a.command == "serve-dashboard":
        from meetloom.server import server

        server(lambda: summed_up(a, tables), a.host or "127.0.0.1", int(a.port or 8765), a.static).serve_forever()
    elif a.command == "inspect-message":
        messages = mail.read_messages(spark, a.path)
        patterns = [a.sender] if a.sender else []
        show(mail.assess(messages, patterns) if a.county else mail.city_assessments(messages, patterns))
        show(mail.message_links(messages))
        show(mail.notices(messages))
    elif a.command == "download-message-links":
        targets = mail.download_targets(mail.message_links(mail.read_messages(spark, a.path)))
        say(fetch.write_manifest(fetch.processed(downloads.download(targets, fetcher, f"{a.out}/files", url="resolved_url")), a.out))
    elif a.command == "check-online-source":
        say(online(a, tables, fetcher))
    elif a.command == "backfill-ceo-supporting-docs":
        say(backfilled_documents(a, tables, fetcher))
    elif a.command == "import-manifest":
        say(imported_manifest(a, tables))
    elif a.command == "write-items-index":
        jobs.items_index(tables, a.source_id).write.mode("overwrite").json(a.out)
    elif a.command == "db-counts":
        say({r["table_name"]: r["table_rows"] for r in manifests.table_counts({n: tables.read(n, s) for n, s in (("raw_documents", schemas.RAW_DOCUMENTS), ("documents", schemas.DOCUMENTS), ("items", schemas.ITEMS))}).collect()})
    elif a.command == "store-sources":
        say({"buckets_rewritten": jobs.store_sources(tables, config.config_rows(spark, config.load_configs(a.config_dir)))})
    elif a.command == "vacuum":
        say({"folders_removed": tables.vacuum()})
    else:
        say(jobs.ingest_messages(tables, mail.read_messages(spark, a.path), a.source_id, fetcher))
    return 0


if __name__ == "__main__":
    sys.exit(main())
