"""File functions, the registry's parser, injected fetching, notices, listings and the health record."""

import urllib.error
from datetime import date

import pytest
from pyspark.sql import functions as F

from meetloom.functions import files
from meetloom.operators import health
from meetloom.server import static_file
from meetloom.sources import config, fetch, links, mail


def values(spark, f, *rows):
    names = [f"c{i}" for i in range(len(rows[0]) if isinstance(rows[0], tuple) else 1)]
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{n} string" for n in names))
    return [r["y"] for r in df.select("i", f(*[F.col(n) for n in names]).alias("y")).orderBy("i").collect()]


def test_suffixes_types_and_names(spark):
    assert values(spark, files.listed_suffix, "https://x/a.XLSX?b", "https://x/?id=12%20b.docx", "https://x/a.zip", "https://x/") == [".xlsx", ".docx", ".pdf", ".pdf"]
    assert values(spark, files.listed_mime, ".pdf", ".xls", ".zip") == ["application/pdf", "application/vnd.ms-excel", "application/octet-stream"]
    assert values(spark, files.download_suffix, ("https://x/a.HTM", ""), ("https://x/a", "application/pdf"), ("https://x/a", "text/plain"), ("https://x/a.exe", "x/y")) == [".htm", ".pdf", ".txt", ".bin"]
    assert values(spark, files.download_mime, ("", ".pdf"), ("a/b", ".pdf"), ("", ".htm"), ("", ".bin")) == ["application/pdf", "a/b", "text/html", "application/octet-stream"]
    assert values(spark, files.supporting_type, ("https://x/supdocs/1.pdf", "text/html", ".pdf"), ("https://x/a", "text/html", ".pdf"), ("https://x/a", "", ".pdf"), ("https://x/a", "", ".doc")) == ["ceo_supporting_document_pdf", "ceo_supporting_document_page", "ceo_supporting_document_pdf", "ceo_supporting_document_file"]
    assert values(spark, lambda u: files.supporting_filename(u, F.lit(7)), "https://x/A b.v2.pdf", "https://x/") == ["supporting_007_a-b-v2", "supporting_007"]
    assert values(spark, files.supporting_url, "/d/supporting_001_123.pdf", "supporting_2_POC25-0001.pdf", "supporting_2_x.pdf") == [files.SUPPORTING_URL + "123.pdf", files.SUPPORTING_URL + "POC25-0001.pdf", None]
    assert values(spark, files.link_filename, ("https://x/a b.pdf", None, "t", "direct_pdf"), ("https://x/", None, "An agenda", "board_agenda_page"), ("https://x", "2026-05-01", "x", "direct_pdf")) == ["a_b.pdf", "undated_An_agenda.html", "2026-05-01_x.pdf"]
    assert values(spark, files.document_kind, ("", "x", "board_agenda_page"), ("Cluster", "x", ""), ("Agenda", "u", ""), ("Cluster", "https://x/SupDocs", ""), ("", "", "")) == ["board_agenda_page", "cluster_agenda_packet", "agenda_packet", "board_supporting_document", "linked_pdf"]


def test_lenient_dates(spark):
    assert values(spark, files.lenient_date, "2026-05-01", "5/1/2026", " <b>soon</b> ", "", None) == ["2026-05-01", "2026-05-01", "soon", None, None]
    assert values(spark, files.lenient_datetime, "2026-05-01", "5/1/2026 3:04:05 pm", "x") == ["2026-05-01T00:00:00", "2026-05-01T15:04:05", "x"]
    assert values(spark, files.listing_date, "5/1/2026, 9am", "2026-05-01", "", None) == ["2026-05-01", "2026-05-01", "", ""]
    assert values(spark, files.label_date, "Agenda for May  5, 2026 (pdf)", "none") == ["2026-05-05", None]


def test_addresses_and_manifests(spark):
    d = spark.createDataFrame([(1, None, 3, 9, 5), (2, "https://own", 3, 9, 5), (3, None, 1, 0, 5), (4, "", 3, None, 5)], "i int, link string, kind int, template long, id long")
    got = [r["u"] for r in d.orderBy("i").select(files.meeting_document_url(*map(F.col, ("link", "kind", "template", "id"))).alias("u")).collect()]
    assert got == [files.MEETING_SITE + "/Portal/Meeting?meetingTemplateId=9&parentLink=newPublicPortal", "https://own", files.MEETING_SITE + "/Public/CompiledDocument?compiledMeetingDocumentFileId=5&compileOutputType=1", files.MEETING_SITE + "/Portal/Meeting?compiledMeetingDocumentFileId=5&parentLink=newPublicPortal"]
    assert d.orderBy("i").select(files.meeting_external_id(F.lit(1), F.lit(2), F.col("template"), F.col("id"), F.col("kind"))).collect()[2][0] == "primegov:1:2:5:1"
    m = spark.createDataFrame([("Body", "", "2026-05-01", "https://u", None)], "body_name string, requested_name string, meeting_date string, source_url string, document_id string")
    row = m.select(*[v.alias(k) for k, v in files.legacy_manifest_row({c: F.col(c) for c in m.columns}).items()]).first()
    assert (row["requested_name"], row["agenda_date"], row["url"], row["status"], row["document_id"][:4]) == ("Body", "2026-05-01", "https://u", "downloaded", "doc_")


def test_small_yaml_reads_what_the_library_reads(tmp_path):
    text = "# note\nsource_id: a\nname: 'x: y'\nn: 3\non: true\nnone:\npatterns:\n  - one\n  - two: 2\n    three:\n      - 4\nlist:\n- a\n- b\nmap:\n  k: v # c\n  deep:\n    x: 1.5\ninline: [a, 2]\n"
    yaml = pytest.importorskip("yaml")
    assert config.parse_yaml(text) == {str(k) if k is not True else "on": v for k, v in yaml.safe_load(text).items()}
    (tmp_path / "b.yaml").write_text(text)
    (tmp_path / "a.yaml").write_text("source_id: first\n")
    assert [c["source_id"] for c in config.load_configs(tmp_path)] == ["first", "a"]
    with pytest.raises(KeyError, match="zz"):
        config.config_of(tmp_path, "zz")
    (tmp_path / "c.yaml").write_text("- 1\n")
    with pytest.raises(ValueError):
        config.load_yaml(tmp_path / "c.yaml")


def web(pages):
    def get(url):
        got = pages[url]
        if isinstance(got, Exception):
            raise got
        return got[0], got[1], url

    return get


def test_following_and_retrying():
    pages = {"https://a/": (b"<a href='/x.html'>p</a><a href='d/y.pdf'>q</a>", "text/html"), "https://a/d/y.pdf": (b"pdf", "application/pdf"), "https://a/l": (b"<meta http-equiv='refresh' content='0;url=https://a/l2'>", "text/html"), "https://a/l2": (b"<a href='https://a/l'>", "text/html")}
    assert fetch.resolve("https://a/", web(pages)) == (b"pdf", "application/pdf", "https://a/d/y.pdf", "followed_landing_page")
    assert fetch.resolve("https://a/l", web(pages))[3] == "followed_landing_page" and fetch.resolve("https://a/l2", web(pages), trusted=lambda u: False)[3] == "html_page_needs_review"
    with pytest.raises(ValueError, match="loop"):
        fetch.resolve("https://a/l", web(pages), seen=frozenset({"https://a/l"}))
    waits, calls = [], []

    def flaky(url):
        calls.append(url)
        if len(calls) < 3:
            raise urllib.error.URLError("down")
        return b"", "text/html", url

    fetch.with_retry(flaky, 3, waits.append)("u")
    assert (len(calls), waits) == (3, [1, 2])


def test_targets_become_rows_and_queues(spark, tmp_path):
    def get(url):
        if "gone" in url:
            raise urllib.error.HTTPError(url, 404, "no", None, None)
        if "busy" in url:
            raise urllib.error.HTTPError(url, 503, "no", None, None)
        if "odd" in url:
            raise OSError("odd")
        return b"x", "text/html" if url.endswith(".html") else "application/pdf", url

    targets = spark.createDataFrame([(f"https://h/{n}",) for n in ("a.html", "b.pdf", "gone", "busy", "odd", "a.html")] + [(None,)], "url string")
    rows = fetch.processed(fetch.fetch_targets(targets, get)).persist()
    got = {r["url"][10:]: (r["processing_status"], r["review_status"], r["error_code"], r["retryable"]) for r in rows.collect()}
    assert got == {"a.html": ("ready", "not_needed", None, False), "b.pdf": ("downloaded_without_text", "needs_manual_review", None, False), "gone": ("download_failed", "not_needed", "http_404", False), "busy": ("needs_retry", "not_needed", "http_503", True), "odd": ("download_failed", "not_needed", "unexpected_fetch_error", False)}
    assert fetch.write_manifest(rows, str(tmp_path / "m")) == {"total": 5, "ready": 1, "needs_retry": 1, "needs_manual_review": 1, "download_failed": 2}
    assert spark.read.json(str(tmp_path / "m/retry_queue")).count() == 1
    assert fetch.processed(fetch.fetch_targets(targets, get), "extracted").where("url like '%b.pdf'").first()["processing_status"] == "ready"
    rows.unpersist()


def test_city_notices(spark):
    page = "<p>NOTICE</p><p>CITY COUNCIL OF LA</p>https://lacity.primegov.com/Portal/Meeting?meetingTemplateId=77"
    m = spark.createDataFrame([("1", "Clerk@x", [], "5/21/2026 3:05 PM - Parks Committee Meeting Agenda", "", None, [("n.HTML", None, page), ("m.html", "text/html", page), ("e.html", "text/html", " "), ("a.pdf", "x", "y")]), ("2", "z", [], "no date - CANCELLED", "", None, [("t", "text/html", "plain &amp; text Notice of Cancellation")])], mail.MESSAGE)
    got = {(r["id"], r["filename"]): r for r in mail.notices(m).collect()}
    assert set(got) == {("1", "n.HTML"), ("1", "m.html"), ("2", "t")}
    n = got["1", "n.HTML"]
    assert (n["body_name"], n["meeting_date"], n["meeting_time"], n["meeting_datetime"], n["is_cancellation"], n["page_template_id"]) == ("City Council Of LA", "2026-05-21", "3:05 PM", "2026-05-21T15:05:00", False, "77")
    assert got["2", "t"]["is_cancellation"] and got["2", "t"]["text_excerpt"].startswith("plain & text")
    assert mail.notice_links(mail.notices(m)).count() == 1
    assert {r["id"]: (r["message_type"], r["meeting_date"], r["relevant"]) for r in mail.city_assessments(m, ["clerk@"]).collect()} == {"1": ("agenda_notice", "2026-05-21", True), "2": ("meeting_cancellation_notice", None, False)}
    assert mail.notice_documents(m).where("content is null").count() == 0
    raw = spark.createDataFrame([("1", "hello", [("f", "t/x", "c")])], "id string, content_text string, attachments array<struct<name:string,mimeType:string,text:string>>")
    r = mail.from_aliases(raw).first()
    assert (r["body"], tuple(r["attachments"][0])) == ("hello", ("f", "t/x", "c"))


def test_archived_listings_and_details(spark):
    card = '<div data-cms-item-id="1" class="card upcoming-meeting"><h4 class="card-title">Board &amp; Co</h4><time data-cms-element-codename="date_and_time">Tuesday, May 5, 2026</time><a href="https://x/a.htm"><span>Agenda</span></a> <a href="https://x/a.pdf">p</a></div>'
    pages = spark.createDataFrame([(card + card.replace("Tuesday, May 5, 2026", "soon"),), (card,)], "html string")
    found = links.snapshot_links(pages)
    assert found.count() == 4
    got = [tuple(r[c] for c in ("meeting_date", "body", "label", "url")) for r in links.distinct_snapshot_links(found, date(2026, 5, 1), date(2026, 5, 31)).collect()]
    assert got == [("2026-05-05", "Board & Co", "Agenda", "https://x/a.htm"), ("2026-05-05", "Board & Co", "Agenda PDF", "https://x/a.pdf")]
    detail = '<script type="application/ld+json"> {"name": "N", "datePublished": "2026-01-01", "dateModified": "m"} </script><a id="bodycontent_hlDownload" class="c" href="/d?a=1&amp;b=2">x</a><span id="bodycontent_lblPubDate"> 2/2/2026 </span><span id="bodycontent_lblProject"></span>'
    r = links.document_details(spark.createDataFrame([("1", detail), ("2", "")], "document_id string, html string")).orderBy("document_id").collect()
    assert (r[0]["title"], r[0]["download_url"], r[0]["published_date"], r[0]["last_modified"], r[0]["project"], r[1]["title"]) == ("N", "/d?a=1&b=2", "2/2/2026", "m", None, None)
    docs = spark.createDataFrame([("m", 0, "Agenda", 5, 2), ("m", 1, "agenda", 9, 3), ("m", 2, "AGENDA", 7, 5), ("m", 3, "Minutes", 8, 1)], "meeting string, pos int, templateName string, id int, compileOutputType int")
    assert [r["id"] for r in links.agenda_documents(docs, "meeting", "pos").collect()] == [7]


def test_health_records(spark):
    sources = spark.createDataFrame([("a", "A", "active", "high", None, None, "lacounty_govdelivery_email"), ("b", "B", "paused", None, None, None, None)], "source_id string, source_name string, status string, priority_level string, download_root string, structured_output_dir string, parser string")
    raw = spark.createDataFrame([("a", "May 1"), ("a", " "), ("zz", "x")], "source_id string, meeting_date string")
    docs = spark.createDataFrame([("a", None, "May 2"), ("a", "2026-05-01", "May 9")], "source_id string, meeting_date_iso string, meeting_date string")
    finds = spark.createDataFrame([("a", "high"), ("a", "low")], "source_id string, priority_level string")
    state = spark.createDataFrame([("a", "2026-01-01T00:00:00"), ("a", "2026-02-01T00:00:00")], "source_id string, recorded_at string")
    queues = health.queue_lengths(spark.createDataFrame([("a", "/x/retry_queue.json", "[1,2]"), ("a", "/y/retry_queue.json", "{bad"), ("a", "/x/manual_review_queue.json", '{"a": 1}')], "source_id string, path string, value string"))
    records = health.health_records(sources, raw, docs, docs, finds, state, queues)
    assert len(records.columns) == 17
    a, b = records.orderBy("source_id").collect()
    assert (a["raw_documents"], a["latest_document_date"], a["structured_documents"], a["latest_structured_date"], a["findings"], a["high_priority_findings"], a["retry_queue_items"], a["manual_review_items"], a["latest_refresh_recorded_at"], a["has_parser_config_warning"]) == (2, "May 1", 2, "2026-05-01", 2, 1, 2, 0, "2026-02-01T00:00:00", True)
    assert (b["raw_documents"], b["latest_document_date"], b["retry_queue_items"], b["has_parser_config_warning"]) == (0, None, 0, False)
    total = health.health_totals(records).first()
    assert (total["source_count"], total["active_source_count"], total["findings"], total["sources_with_parser_config_warnings"]) == (2, 1, 2, 1)


def test_static_files_stay_below_their_root(tmp_path):
    (tmp_path / "www").mkdir()
    (tmp_path / "www/index.html").write_text("hi")
    (tmp_path / "secret").write_text("no")
    root = str(tmp_path / "www")
    assert static_file(root, "/")[:2] == (200, b"hi")
    assert static_file(root, "/../secret")[0] == 403 and static_file(root, "/%2e%2e/secret")[0] == 403 and static_file(root, "/none")[0] == 404 and static_file(None, "/")[0] == 404
