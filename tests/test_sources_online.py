"""Listings, frontier, ledger, manifests and dispatch with invented sites."""

import datetime
import json
import os
import urllib.error
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meetloom import schemas
from meetloom.operators import ranking
from meetloom.sources import dispatch, downloads, frontier, jobs, ledger, listings, mail, manifests, store

DAY = datetime.date


def site(pages, log=None):
    """A fetcher over a dictionary; a value is text, bytes, (text, type) or an exception."""

    def get(url):
        if log:
            with open(log, "a") as f:
                f.write(url + "\n")
        got = pages.get(url, urllib.error.HTTPError(url, 404, "no", None, None))
        if isinstance(got, Exception):
            raise got
        body, kind = got if isinstance(got, tuple) else (got, "text/html")
        return body.encode() if isinstance(body, str) else body, kind, url

    return get


def test_windows_cover_the_days():
    got = listings.windows(DAY(2025, 1, 1), DAY(2025, 3, 5), 31)
    assert got == [(DAY(2025, 1, 1), DAY(2025, 1, 31)), (DAY(2025, 2, 1), DAY(2025, 3, 3)), (DAY(2025, 3, 4), DAY(2025, 3, 5))] and listings.windows(DAY(2025, 1, 2), DAY(2025, 1, 1)) == []


def test_meetings_come_by_windows(spark, tmp_path):
    log = str(tmp_path / "log")
    meeting = lambda i, c, t: {"id": i, "committeeId": c, "title": t, "dateTime": "2025-01-05T10:00:00", "documentList": [{"id": 10 * i, "templateId": 0, "templateName": "Agenda", "compileOutputType": 3}, {"id": 10 * i + 1, "templateId": 0, "templateName": "agenda", "compileOutputType": 1}]}
    url = lambda a, b: listings.MEETINGS_URL.format(first=a, last=b)
    (a, b), (c, d) = listings.windows(DAY(2025, 1, 1), DAY(2025, 2, 10))
    pages = {url(a, b): json.dumps([meeting(1, 1, "Council"), meeting(2, 7, "Other"), meeting(3, 1, "SAP Council")]), url(c, d): json.dumps([meeting(1, 1, "Council"), meeting(4, 104, "Housing")])}
    got = listings.archived_meetings(spark, site(pages, log), DAY(2025, 1, 1), DAY(2025, 2, 10))
    assert sorted(r["id"] for r in got.collect()) == [1, 2, 3, 4]
    work = sorted(r["url"] for r in listings.meeting_work(got).collect())
    assert [w.split("?")[1] for w in work] == ["compiledMeetingDocumentFileId=11&compileOutputType=1", "compiledMeetingDocumentFileId=41&compileOutputType=1"]
    assert set(Counter(Path(log).read_text().split()).values()) == {1}
    with pytest.raises(RuntimeError, match="404"):
        listings.archived_meetings(spark, site({}), DAY(2025, 1, 1), DAY(2025, 1, 2))


def test_sections_fall_back_to_the_page(spark):
    rows = [{"date": "2026-05-20", "deptAbbrv": "OC", "url": "https://x/a.pdf", "title": "Agenda", "documentTitle": "Extra", "originalFileName": "a"}, {"date": "bad", "deptAbbrv": "OC", "url": "u"}]
    page = '<h4>Operations Cluster</h4><p><a href="https://x/b.pdf">May 13, 2026 Agenda</a></p>'
    by_data = listings.agenda_sections(spark, site({listings.AGENDA_DATA_URL: json.dumps(rows)}), {"OC": "Operations Cluster"}).collect()
    assert [(r["body"], r["label"], str(r["agenda_date"]), r["method"]) for r in by_data] == [("Operations Cluster", "Extra", "2026-05-20", listings.API)]
    for answer in ({}, {listings.AGENDA_DATA_URL: "{}"}, {listings.AGENDA_DATA_URL: "[]"}, {listings.AGENDA_DATA_URL: "<html>"}):
        got = listings.agenda_sections(spark, site(answer | {listings.AGENDAS_PAGE: page}), {}).collect()
        assert [(r["body"], r["url"], r["method"]) for r in got] == [("Operations Cluster", "https://x/b.pdf", listings.STATIC)]


def card(day, name, n):
    return f'<div data-cms-item-id="{n}" class="card upcoming-meeting"><h4 class="card-title">{name}</h4><time data-cms-element-codename="date_and_time">{day}</time><a href="https://x/{n}.htm"><span>Agenda</span></a> <a href="https://x/{n}.pdf">p</a></div>'


def test_archive_chain(spark):
    index = listings.ARCHIVE_INDEX.format(first=DAY(2026, 5, 1), last=DAY(2026, 5, 31))
    stamps = ["20260501010101", "20260501220000", "20260505000000", "20260507000000", "20260512235959", "20260513000000"]
    page = lambda t: listings.ARCHIVE_PAGE.format(timestamp=t)
    pages = {index: json.dumps([["timestamp"], *[[t] for t in stamps]]), page("20260501010101"): card("Tuesday, May 5, 2026", "Board", 1) + card("Tuesday, June 5, 2026", "Late", 9), page("20260513000000"): card("Tuesday, May 5, 2026", "Board again", 1) + card("Tuesday, May 19, 2026", "Board", 2)}
    fetch = site(pages)
    assert sorted(r["timestamp"] for r in listings.archive_timestamps(spark, fetch, DAY(2026, 5, 1), DAY(2026, 5, 31)).collect()) == ["20260501010101", "20260507000000", "20260513000000"]
    got = listings.archived_links(spark, fetch, DAY(2026, 5, 1), DAY(2026, 5, 31)).collect()
    assert [(r["meeting_date"], r["body"], r["url"]) for r in got] == [("2026-05-05", "Board", "https://x/1.htm"), ("2026-05-05", "Board", "https://x/1.pdf"), ("2026-05-19", "Board", "https://x/2.htm"), ("2026-05-19", "Board", "https://x/2.pdf")]


def test_thinning_over_many_kept_instants(spark):
    start = datetime.datetime(2024, 1, 1)
    rows = [(s, start + datetime.timedelta(hours=h)) for s, step in (("a", 5), ("b", 149), ("c", 1000)) for h in range(0, 4000, step)] + [("d", start), ("d", start), (None, start), ("e", None)]

    def greedy(ts):
        kept = []
        for t in sorted(set(ts)):
            if not kept or t >= kept[-1] + datetime.timedelta(days=6):
                kept.append(t)
        return kept

    want = sorted((s, t) for s in "abcd" for t in greedy([t for x, t in rows if x == s]))
    got = sorted((r["scope"], r["ts"]) for r in ranking.thin_snapshots(spark.createDataFrame(rows, "scope string, ts timestamp"), "scope", "ts").collect())
    assert got == want and len([g for g in got if g[0] == "a"]) > 20


def test_library_and_search(spark, tmp_path):
    root = listings.DOCUMENTS_PAGE
    tile = '<a href="documents?scope=106"><div class="tile-label">Finance</div></a>'
    doc = lambda i, t: f'<a href="documents?id={i}" class="doclib-item"><div class="doclib-item-name">{t}</div></a>'
    got = listings.library_documents(spark, site({root: tile, f"{root}?scope=106": doc(1, "Budget A") + doc(2, "Other") + doc(3, "Budget B") + doc(4, "Budget C")}), None, ["budget"], 2).collect()
    assert sorted((r["document_id"], r["scope_id"]) for r in got) == [("1", "106"), ("3", "106")]
    log = str(tmp_path / "log")
    results = {f"https://s/?p={p}": json.dumps([{"id": str(i) if i % 3 else "", "u": f"https://s/{i}"} for i in range(p * 4, p * 4 + 6) if i < 18]) for p in range(10)}
    rows_of = lambda d: d.select("page", F.explode(F.from_json("body", "array<struct<id: string, u: string>>")).alias("r")).select("page", "r.*")
    found = listings.search_all(spark, site(results, log), lambda p: f"https://s/?p={p}", rows_of, [F.col("id"), F.col("u")], at_once=3).collect()
    assert sorted(r["u"] for r in found) == sorted(f"https://s/{i}" for i in range(18))
    assert sum(Counter(Path(log).read_text().split()).values()) <= 10


SUP = "https://file.lacounty.gov/SDSInter/bos/supdocs/"


def test_supporting_documents_are_fetched_once_and_reviewed(spark, tmp_path):
    log = str(tmp_path / "log")
    page = lambda *links: "".join(f'<a href="{x}">x</a>' for x in links)
    pages = {
        SUP + "1.pdf": ("one", "application/pdf"),
        SUP + "landing": page(SUP + "loop", SUP + "2.pdf", "https://elsewhere/3.pdf"),
        SUP + "2.pdf": ("two", "application/pdf"),
        SUP + "loop": page(SUP + "loop2"),
        SUP + "loop2": page(SUP + "loop"),
        SUP + "deep": page(SUP + "deep1"),
        SUP + "deep1": page(SUP + "deep2"),
        SUP + "deep2": page(SUP + "deep3"),
        SUP + "alone": page("https://elsewhere/"),
    }
    agendas = spark.createDataFrame([
        ("a", "https://a/", "Attachments: none", [SUP + "1.pdf", "https://zoom.us/x", SUP + "landing", SUP + "1.pdf", SUP + "gone"]),
        ("b", "https://b/", None, [SUP + "landing", SUP + "loop", SUP + "deep", SUP + "alone"]),
        ("c", "https://c/", "a Supporting Document", []),
        ("d", "https://d/", "nothing", None),
    ], "external_id string, url string, text string, links array<string>")
    documents, review = frontier.supporting_documents(agendas, frontier.fetched(site(pages, log), str(tmp_path / "kept"), run="r"))
    got = {(r["parent_external_id"], r["index"]): (r["external_id"].removeprefix(SUP), r["outcome"], r["file_name"]) for r in documents.collect()}
    assert got == {
        ("a", 1): ("1.pdf", "direct_download", "supporting_001_1.pdf"), ("a", 2): ("2.pdf", "followed_landing_page", "supporting_002_2.pdf"),
        ("b", 1): ("2.pdf", "followed_landing_page", "supporting_001_2.pdf"), ("b", 2): ("loop2", "followed_landing_page", "supporting_002_loop2.html"),
        ("b", 3): ("deep2", "followed_landing_page", "supporting_003_deep2.html"), ("b", 4): ("alone", "html_page_needs_review", "supporting_004_alone.html"),
    }
    told = sorted((r["external_id"], r["support_url"].removeprefix(SUP), r["reason"].split(":")[0]) for r in review.collect())
    assert told == [("a", "gone", "download_error"), ("b", "alone", "html_page_needs_review"), ("c", "https://c/", "supporting_labels_without_trusted_links")]
    assert set(Counter(Path(log).read_text().split()).values()) == {1}


def test_ledger_resumes_and_fetches_once(spark, tmp_path):
    log, root, broken = str(tmp_path / "log"), str(tmp_path / "kept"), tmp_path / "broken"
    tables = store.Store(spark, str(tmp_path / "wh"))
    work = spark.createDataFrame([("s", f"https://h{i % 2}/{i}", "2026-01-01", "2026-01-14") for i in range(20)] + [("s", "https://h0/0", "2026-01-15", "2026-01-28"), ("t", "https://h0/0", "2026-01-01", "2026-01-14"), ("s", "https://h0/bad", "2026-01-01", "2026-01-14")], "source_id string, url string, window_from string, window_to string")
    ledger.plan(tables, work)
    ledger.plan(tables, work)
    assert ledger.counts(tables) == {"planned": 22}
    broken.touch()

    def get(url):
        if os.path.exists(broken) and url.endswith("7"):
            os._exit(1)
        with open(log, "a") as f:
            f.write(url + "\n")
        if "bad" in url:
            raise urllib.error.HTTPError(url, 404, "no", None, None)
        return url.encode(), "text/html", url

    with pytest.raises(Exception):  # noqa: B017
        ledger.work_off(tables, "job", get, root, host_share=100)
    assert ledger.counts(tables) == {"leased": 22}
    assert ledger.lease(tables, "other").isEmpty()
    broken.unlink()
    assert ledger.work_off(tables, "job", get, root, host_share=6) == {"done": 21, "failed": 1}
    asked = Counter(Path(log).read_text().split())
    assert set(asked.values()) == {1} and len(asked) == 21
    row = ledger.states(tables.read(ledger.TABLE, ledger.EVENTS)).where("url = 'https://h0/0' and source_id = 's'").first()
    assert (row["window_from"], row["window_to"], row["state"], row["host"]) == ("2026-01-01", "2026-01-14", "done", "h0")
    ledger.compact(tables)
    assert tables.read(ledger.TABLE, ledger.EVENTS).count() == 22 and ledger.counts(tables) == {"done": 21, "failed": 1}


def test_leases_run_out_and_hosts_have_their_share(spark, tmp_path):
    tables = store.Store(spark, str(tmp_path / "wh"))
    ledger.plan(tables, spark.createDataFrame([("s", f"https://{h}/{i}", "w", "w") for h, n in (("hot", 30), ("cold", 2)) for i in range(n)], "source_id string, url string, window_from string, window_to string"))
    t0 = datetime.datetime(2026, 1, 1, tzinfo=datetime.timezone.utc)
    first = ledger.lease(tables, "one", seconds=60, host_share=5, now=t0)
    assert Counter(r["host"] for r in first.collect()) == {"hot": 5, "cold": 2}
    second = ledger.lease(tables, "two", host_share=5, now=t0)
    assert Counter(r["host"] for r in second.collect()) == {"hot": 5} and not {r["url"] for r in first.collect()} & {r["url"] for r in second.collect()}
    late = ledger.lease(tables, "three", host_share=100, now=t0 + datetime.timedelta(seconds=61))
    assert late.count() == 27


def test_store_pointers(spark, tmp_path):
    tables = store.Store(spark, str(tmp_path / "wh"))
    row = spark.createDataFrame([("a",)], "k string")
    tables.commit({"x": row})
    tables.commit({}, added={"x": row, "y": row})
    assert (tables.read("x", row.schema).count(), tables.read("y", row.schema).count()) == (2, 1)
    stale = tables._numbers()
    assert not tables._named(stale[-1], {}) and tables._numbers() == stale
    tables.commit({"x": row})
    tables.staged(row)
    assert tables.vacuum(keep=1) == 3 and (tables.read("x", row.schema).count(), tables.read("y", row.schema).count()) == (1, 1)
    other, held = store.Store(spark, tables.root), tables.pointers

    def late():
        return held()

    assert late() == other.pointers()


def test_a_commit_that_was_overtaken_raises(spark, tmp_path, monkeypatch):
    tables = store.Store(spark, str(tmp_path / "wh"))
    row = spark.createDataFrame([("a",)], "k string")
    tables.commit({"x": row, "y": row})
    overtaken, first = store.Store(spark, tables.root), [True]
    named = store.Store._named

    def slow(self, number, now):
        if first:
            first.clear()
            tables.commit({"x": row.unionByName(row)})  # slips in between reading the pointer and writing the next one
        return named(self, number, now)

    monkeypatch.setattr(store.Store, "_named", slow)
    with pytest.raises(RuntimeError, match="another writer"):
        overtaken.commit({"x": row})
    first.append(True)
    overtaken.commit({"y": row.unionByName(row)})  # another table: both stand
    assert (tables.read("x", row.schema).count(), tables.read("y", row.schema).count()) == (2, 2)


def test_last_raw_document_wins_and_clashes_are_named(spark, tmp_path):
    tables = store.Store(spark, str(tmp_path / "wh"))
    rows = lambda *r: spark.createDataFrame(list(r), "document_id string, source_id string, file_path string, title string")
    jobs.upsert_raw_documents(tables, rows(*[("d", "s", "/f", f"t{i}") for i in range(5)]))
    read = lambda: {r["document_id"]: r["title"] for r in tables.read("raw_documents", schemas.RAW_DOCUMENTS).collect()}
    assert read() == {"d": "t4"}
    jobs.upsert_raw_documents(tables, rows(("new", "s", "/f", "again")), reuse_ids_by_file=True)
    assert read() == {"d": "again"}
    with pytest.raises(ValueError, match="/f"):
        jobs.upsert_raw_documents(tables, rows(("n1", "s", "/f", "x"), ("n2", "s", "/f", "y")), reuse_ids_by_file=True)


def test_helper_names_give_way(spark):
    rows = spark.createDataFrame([("k", 1, 2, 3, 4), ("k", 0, 9, 9, 9)], "key string, at int, row int, nth int, was int")
    assert tuple(ranking.first_per_key(rows, ["key"], [F.col("at")]).first()) == ("k", 0, 9, 9, 9)
    assert ranking.first_n_per_scope(rows, "key", [F.col("at")], 1).first()["nth"] == 9
    assert tuple(store.last_per_key(rows, ["key"], "at").first()) == ("k", 2, 3, 4)
    assert store.upsert(rows, rows, ["key", "at"]).count() == 2


def test_manifest_and_folder(spark, tmp_path):
    folder = tmp_path / "sop"
    folder.mkdir()
    (folder / "a.pdf").write_bytes(b"a")
    (folder / "b.pdf").write_bytes(b"b")
    told = {"documents": [{"sds_doc_id": "7", "title": "", "sds_title": "T", "meeting_date": "2026-01-06", "local_path": str(folder / "a.pdf")}, {"local_path": str(folder / "gone.pdf")}, {"title": "B", "local_path": str(folder / "b.pdf")}]}
    path = tmp_path / "m.json"
    path.write_text("﻿" + json.dumps(told), encoding="utf-8")
    held = manifests.folder_marks(spark, str(folder))
    rows, missing = manifests.proceedings_documents(manifests.read_manifest(spark, str(path)), held, "sop")
    assert sorted((r["external_id"], r["title"], r["file_path"].split("/")[-1]) for r in rows.collect()) == [("bos_sop:7", "T", "a.pdf"), ("bos_sop:b", "B", "b.pdf")]
    assert [r["path"].split("/")[-1] for r in missing.collect()] == ["gone.pdf"]
    entry = spark.createDataFrame([(str(folder / "a.pdf"), "x"), (str(folder / "c.pdf"), None)], "path string, sha256 string")
    assert {r["path"].split("/")[-1]: r["state"] for r in manifests.reconcile(entry, held).collect()} == {"a.pdf": "changed", "b.pdf": "orphaned", "c.pdf": "missing"}


def test_online_check_plans_all_and_isolates_failures(spark, tmp_path):
    log = str(tmp_path / "log")
    today = DAY(2026, 5, 14)
    entries = [
        {"source_ref": "board", "current_source_id": "s_board", "adapter_candidate": dispatch.CURRENT, "schedule": {"lookback_days": 10, "lookahead_days": 6}},
        {"source_ref": "library", "current_source_id": "s_lib", "adapter_candidate": dispatch.LIBRARY, "tracked_scope_ids": [106], "max_documents_per_scope": 1},
        {"source_ref": "data", "current_source_id": "s_data", "adapter_candidate": dispatch.DATA},
        {"source_ref": "odd", "current_source_id": "s_odd", "adapter_candidate": "none"},
        {"source_ref": "bare"},
    ]
    root = listings.DOCUMENTS_PAGE
    pages = {listings.BOARD_PAGE: card("Tuesday, May 5, 2026", "Board", 1), "https://x/1.htm": "page", "https://x/1.pdf": ("pdf", "application/pdf"), f"{root}?scope=106": '<a href="documents?id=1" class="doclib-item"><div class="doclib-item-name">A</div></a>', f"{root}?id=1": "detail"}
    tables = store.Store(spark, str(tmp_path / "wh"))
    got = dispatch.check_online(tables, site(pages, log), entries, today, str(tmp_path / "kept"), "job")
    assert got["downloads"] == {"done": 3}
    assert [(s["source_ref"], s["from_date"], s["to_date"], (s["error"] or "").split(":")[0]) for s in got["sources"]] == [("board", "2026-05-04", "2026-05-20", ""), ("library", "2026-04-30", "2026-05-14", ""), ("data", "2026-04-30", "2026-05-14", "ValueError"), ("odd", "2026-04-30", "2026-05-14", "NotImplementedError"), ("bare", "2026-04-30", "2026-05-14", "ValueError")]
    again = dispatch.check_online(tables, site(pages, log), entries[:2], today, str(tmp_path / "kept"), "job2")
    assert again["downloads"] == {"done": 3}
    asked = Counter(Path(log).read_text().split())
    assert {u: n for u, n in asked.items() if u.startswith("https://x/") or "id=1" in u} == {"https://x/1.htm": 1, "https://x/1.pdf": 1, f"{root}?id=1": 1}


def test_messages_under_other_names(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"id": "1", "from_": "a@example.org", "to": [], "subject": "s", "text": "hello", "attachments": [{"name": "n", "mimeType": "text/html", "body": " ", "content_text": "c"}, {"filename": "f", "content": "x"}]}))
    m = mail.read_messages(spark, str(path)).first()
    assert (m["body"], [tuple(a) for a in m["attachments"]]) == ("hello", [("n", "text/html", "c"), ("f", None, "x")])


def test_index_of_stored_items(spark, tmp_path):
    tables = store.Store(spark, str(tmp_path / "wh"))
    index = tmp_path / "i.json"
    index.write_text(json.dumps([{"agenda_item_id": "i1", "document_id": "d", "title": "T", "topic_tags": ["b", "a"]}, {"agenda_item_id": "i2", "document_id": "d", "title": "U"}]))
    rows = jobs.read_items_index(spark, str(index)).withColumn("source_id", F.lit("s"))
    assert jobs.import_items(tables, rows) == {"documents_imported": 1, "items_imported": 2, "topics_imported": 2}
    got = {r["agenda_item_id"]: r["topic_tags"] for r in jobs.items_index(tables, "s").collect()}
    assert got == {"i1": ["a", "b"], "i2": []}
    assert downloads.host_of(F.col("x")) is not None


def test_an_import_extracts_each_file_once(spark, tmp_path):
    from meetloom.extract import kernels

    log = str(tmp_path / "log")
    text = "DATE: May 20, 2026\nOperations Cluster\n\n1. ITEMS:\n\nA. Award a road contract\nB. Tenant outreach\n"
    files = spark.createDataFrame([(f"/in/{i}.txt", text, None) for i in range(4)], "path string, text string, parser string")

    def noted(batches):
        for b in batches:
            with open(log, "a") as f:
                f.writelines(p + "\n" for p in b["path"])
            yield b

    read = files.mapInPandas(noted, files.schema)
    tables = store.Store(spark, str(tmp_path / "wh"))
    got = jobs.import_items(tables, kernels.extract_items(read).withColumn("source_id", F.lit("s")))
    assert got["documents_imported"] == 4 and set(asked_of(log).values()) == {1} and len(asked_of(log)) == 4


def asked_of(log):
    return Counter(Path(log).read_text().split())


def test_commands_for_online_sources(spark, tmp_path, capsys):
    from meetloom import cli

    log = tmp_path / "log.yaml"
    log.write_text("sources:\n  - source_ref: board\n    current_source_id: s_board\n    adapter_candidate: la_county_bos_current_page\n    schedule:\n      lookback_days: 20\n")
    pages = {listings.BOARD_PAGE: card("Tuesday, May 5, 2026", "Board", 1), "https://x/1.htm": "page", "https://x/1.pdf": ("pdf", "application/pdf"), SUP + "1.pdf": ("one", "application/pdf")}
    run = lambda *a: (cli.main(["--store", str(tmp_path / "wh"), "--config-dir", str(tmp_path / "cfg"), *a], site(pages)), capsys.readouterr().out)[1]
    got = json.loads(run("check-online-source", str(log), "board", "--today", "2026-05-14", "--download-only"))
    assert got["downloads"] == {"done": 2} and got["sources"][0]["from_date"] == "2026-04-24" and got["refreshed"] == []
    agendas = tmp_path / "agendas.json"
    agendas.write_text(json.dumps({"external_id": "a", "url": "https://a/", "text": "", "links": [SUP + "1.pdf", "https://zoom.us/1"]}) + "\n" + json.dumps({"external_id": "b", "url": "https://b/", "text": "Attachments: x", "links": []}))
    out = str(tmp_path / "out")
    assert json.loads(run("backfill-ceo-supporting-docs", str(agendas), out, "--inventory-only")) == {"agenda_documents_considered": 2, "trusted_supporting_links_discovered": 1, "supporting_documents_downloaded": 0, "review_target_count": 0}
    assert json.loads(run("backfill-ceo-supporting-docs", str(agendas), out))["supporting_documents_downloaded"] == 1
    folder = tmp_path / "sop"
    folder.mkdir()
    (folder / "a.pdf").write_bytes(b"a")
    (folder / "m.json").write_text(json.dumps({"documents": [{"sds_doc_id": "7", "local_path": str(folder / "a.pdf")}, {"local_path": "/none"}]}))
    assert json.loads(run("import-manifest", str(folder / "m.json"), "sop")) == {"documents_imported": 1, "missing_files": 1}
    assert json.loads(run("db-counts")) == {"raw_documents": 1, "documents": 0, "items": 0}
    assert json.loads(run("vacuum"))["folders_removed"] >= 1


def test_sources_keep_their_stamps_and_untouched_buckets(spark, tmp_path):
    tables = store.Store(spark, str(tmp_path / "wh"))
    rows = lambda *r: spark.createDataFrame(list(r), "source_id string, source_name string, status string")
    t1, t2, t3 = (datetime.datetime(2026, 1, d, tzinfo=datetime.timezone.utc) for d in (1, 2, 3))
    jobs.store_sources(tables, rows(*[(f"s{i}", f"n{i}", "active") for i in range(40)]), t1)
    before = tables.pointers()["sources"]
    assert jobs.store_sources(tables, rows(("s1", "n1", "active"), ("s2", "n2", "paused"), ("new", "n", None)), t2) <= 3
    after = tables.pointers()["sources"]
    assert len(set(before) & set(after)) >= len(before) - 3
    got = {r["source_id"]: r for r in tables.read("sources", schemas.SOURCES).collect()}
    day = lambda s, c: got[s][c][8:10]
    assert len(got) == 41 and [(day(s, "created_at"), day(s, "updated_at")) for s in ("s1", "s2", "s3", "new")] == [("01", "01"), ("01", "02"), ("01", "01"), ("02", "02")]
    assert tables.vacuum(keep=1) == 0 and tables.read("sources", schemas.SOURCES).count() == 41
    tables.commit({"sources": tables.read("sources", schemas.SOURCES)})  # written as a whole, then merged again
    assert jobs.store_sources(tables, rows(("s2", "n2", "active")), t3) == store.BUCKETS
    again = {r["source_id"]: r for r in tables.read("sources", schemas.SOURCES).collect()}
    assert len(again) == 41 and again["s2"]["updated_at"][8:10] == "03" and again["s3"]["updated_at"][8:10] == "01"
