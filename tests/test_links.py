"""Link listings and the HTTP dashboard on invented pages."""

import json
import threading
from datetime import date
from urllib.error import HTTPError
from urllib.request import urlopen

import pytest
from pyspark.sql import functions as F

from meetloom.server import server
from meetloom.sources import links


def test_agendas_of_both_sources(spark):
    api = spark.createDataFrame([("2026-05-01", "u1", "HR", "Agenda", "Extra", None), ("bad", "u2", "HR", "", "", ""), ("2026-05-02", "u3", "X", "agenda", None, " f.pdf "), ("2026-05-03", None, "X", "", "", "")], "date string, url string, deptAbbrv string, title string, documentTitle string, originalFileName string")
    got = {r["url"]: (r["body"], r["label"]) for r in links.api_agendas(api, {"HR": "People"}).collect()}
    assert got == {"u1": ("People", "Extra"), "u3": ("X", "f.pdf")}
    page = '<h4>Parks &amp; Roads</h4><a href="a.pdf">May 5, 2026</a><a class="x" href="b.PDF"><b>June 1, 2026</b> late</a><a href="c.html">May 6, 2026</a><h4>None</h4><a href="d.pdf">no date</a>'
    found = links.heading_agendas(spark.createDataFrame([(page,)], "html string"))
    assert sorted((r["body"], r["label"], r["url"]) for r in found.collect()) == [("Parks & Roads", "June 1, 2026 late", "b.PDF"), ("Parks & Roads", "May 5, 2026", "a.pdf")]
    asked = links.requested_links(found, ["P", "Parks & Roads"], {"P": "Parks & Roads"}, date(2026, 5, 1), date(2026, 5, 31)).collect()
    assert [(r["requested_name"], r["url"]) for r in asked] == [("P", "a.pdf")]


def test_tiles_cards_and_choice(spark):
    page = '<a href="documents?scope=7"><div class="tile-label"> Money </div></a><a href="documents?id=1&amp;2" class="doclib-item"><div class="doclib-item-name">A <i>plan</i></div></a><a href="documents?id=1&amp;2" class="doclib-item"><div class="doclib-item-name">Again</div></a>'
    df = spark.createDataFrame([("7", page)], "scope_id string, html string")
    assert [tuple(r) for r in links.scope_tiles(df).collect()] == [("7", "Money")]
    cards = links.document_cards(df)
    assert [(r["document_id"], r["title"]) for r in cards.collect()] == [("1&2", "A plan")]
    assert links.with_keywords(cards, ["PLAN"]).count() == 1 and links.with_keywords(cards, ["x"]).count() == 0 and links.with_keywords(cards, []).count() == 1
    urls = spark.createDataFrame([("k", u) for u in ("http://x/a.html", "http://x/download?id=1", "http://x/b.pdf", "http://x/supdocs/1", "http://x/z.zip")], "k string, url string")
    assert links.best_child(urls, "k").first()["url"] == "http://x/supdocs/1"
    assert links.best_child(urls.where("url not like '%supdocs%'"), "k").first()["url"] == "http://x/b.pdf"
    trust = spark.createDataFrame([("https://a.gov/supdocs/1",), ("ftp://a.gov/supdocs/1",), ("https://evil.com/supdocs/1",), ("https://a.gov/publiccomment/supdocs",), ("https://a.gov/x",)], "u string")
    assert [r[0] for r in trust.select(links.is_trusted(F.col("u"), ["evil.com"], ["/supdocs/"])).collect()] == [True, False, False, False, False]


def test_meeting_documents(spark):
    m = spark.createDataFrame([(1, 104, "Open"), (2, 104, "SAP items"), (3, 9, "Open"), (4, 1, None)], "id int, committeeId int, title string")
    assert sorted(r["id"] for r in links.selected_meetings(m, [1, 104]).collect()) == [1, 4]
    d = spark.createDataFrame([(1, "Agenda", 3, 9), (1, "agenda ", 2, 5), (1, "Agenda", 1, 4), (1, "Minutes", 1, 1), (2, "Notice of Cancellation", 3, 1), (2, "notice of cancellation", 3, 2)], "meeting int, templateName string, compileOutputType int, id int")
    assert sorted((r["meeting"], r["id"]) for r in links.agenda_documents(d, "meeting").collect()) == [(1, 4), (2, 2)]


def test_dashboard_server():
    s = server(lambda: {"sources": []})
    threading.Thread(target=s.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{s.server_port}"
    assert json.load(urlopen(f"{base}/health")) == {"status": "ok"} and json.load(urlopen(f"{base}/api/summary?x")) == {"sources": []}
    with pytest.raises(HTTPError, match="404"):
        urlopen(f"{base}/../etc/passwd")
    s.shutdown()
