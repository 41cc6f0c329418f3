"""Link listings of meeting sites as DataFrames: API rows, heading blocks, tiles, cards, and the choice among links."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetloom.functions.exprs import blank_to_null, date_iso, plain, unescaped
from meetloom.operators.ranking import first_per_key

# Tags and words of the pages, and how child links rank.
ANCHOR = r'(?is)<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>'
SCOPE_TILE = r'(?is)<a[^>]+href="documents\?scope=(\d+)"[^>]*>.*?<div class="tile-label">(.*?)</div>.*?</a>'
DOCUMENT_CARD = r'(?is)<a\s+href="documents\?id=([^"]+)"\s+class="doclib-item">.*?<div class="doclib-item-name">(.*?)</div>.*?</a>'
LABEL_DATE = r"([A-Za-z]+\s+\d{1,2},\s+\d{4})"
OFFICE_SUFFIXES = [".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".csv"]
DOWNLOAD_WORDS = ["download", "attachment", "support", "supdoc", "boardletter"]


def api_agendas(rows: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """API rows (date, url, deptAbbrv, title, documentTitle, originalFileName) to body, label, agenda_date, url; malformed rows are skipped."""
    named = F.create_map(*[F.lit(x) for kv in names.items() for x in kv]) if names else F.create_map().cast("map<string,string>")
    parts = F.filter(F.transform(F.array("title", "documentTitle"), lambda x: F.trim(F.coalesce(x, F.lit("")))), lambda x: (x != "") & (F.lower(x) != "agenda"))
    label = F.coalesce(blank_to_null(F.array_join(parts, " - ")), blank_to_null(F.trim("originalFileName")), F.lit("Agenda"))
    dated = F.try_to_date("date", "yyyy-MM-dd")
    out = rows.select(F.coalesce(F.element_at(named, F.col("deptAbbrv")), F.col("deptAbbrv")).alias("body"), label.alias("label"), dated.alias("agenda_date"), "url")
    return out.where("agenda_date is not null and url is not null and body is not null")


def heading_agendas(pages: DataFrame) -> DataFrame:
    """Pages (html) whose h4 headings name bodies, followed by dated links to PDF files: body, label, agenda_date, url, pos."""
    blocks = pages.select(F.explode(F.slice(F.split("html", "(?i)<h4[^>]*>"), 2, 1_000_000)).alias("block"))
    named = blocks.select(plain(F.split("block", "(?i)</h4>")[0]).alias("body"), F.arrays_zip(F.regexp_extract_all("block", F.lit(ANCHOR), 1).alias("url"), F.regexp_extract_all("block", F.lit(ANCHOR), 2).alias("raw")).alias("links"))
    links = named.select("body", F.posexplode("links").alias("pos", "l")).select("body", "pos", plain(F.col("l.raw")).alias("label"), "l.url")
    dated = links.withColumn("agenda_date", F.to_date(date_iso(F.regexp_extract("label", LABEL_DATE, 1))))
    return dated.where(F.col("agenda_date").isNotNull() & F.lower("url").endswith(".pdf")).select("body", "label", "agenda_date", "url", "pos")


def requested_links(links: DataFrame, requested: Sequence[str], aliases: Mapping[str, str], first: date, last: date) -> DataFrame:
    """Links of the requested bodies within the dates; a url goes to the first body that asks for it. The request is a short list, broadcast as a literal table."""
    asked = links.sparkSession.createDataFrame([(i, r, aliases.get(r, r)) for i, r in enumerate(requested)], "asked int, requested_name string, body string")
    hit = links.join(F.broadcast(asked), "body").where(F.col("agenda_date").between(F.lit(first), F.lit(last)))
    return first_per_key(hit, ["url"], [F.col("asked"), F.col("agenda_date"), F.col("label")]).drop("asked").orderBy("agenda_date", "body", "label")


def scope_tiles(pages: DataFrame) -> DataFrame:
    pairs = F.arrays_zip(F.regexp_extract_all("html", F.lit(SCOPE_TILE), 1).alias("id"), F.regexp_extract_all("html", F.lit(SCOPE_TILE), 2).alias("label"))
    return pages.select(F.explode(pairs).alias("t")).select(F.col("t.id").alias("scope_id"), plain(F.col("t.label")).alias("scope_name")).distinct()


def document_cards(pages: DataFrame) -> DataFrame:
    """Pages (scope_id, html) to the first card of each document id: scope_id, document_id, title, pos."""
    pairs = F.arrays_zip(F.regexp_extract_all("html", F.lit(DOCUMENT_CARD), 1).alias("id"), F.regexp_extract_all("html", F.lit(DOCUMENT_CARD), 2).alias("title"))
    cards = pages.select("scope_id", F.posexplode(pairs).alias("pos", "c")).select("scope_id", unescaped(F.col("c.id")).alias("document_id"), plain(F.col("c.title")).alias("title"), "pos")
    return first_per_key(cards, ["scope_id", "document_id"], [F.col("pos")])


def with_keywords(links: DataFrame, keywords: Sequence[str], column: str = "title") -> DataFrame:
    """Rows whose lowered title holds a keyword; all rows without keywords."""
    if not keywords:
        return links
    found = F.lit(False)
    for k in keywords:
        found = found | F.lower(column).contains(k.lower())
    return links.where(found)


def is_trusted(url: Column, blocked_domains: Sequence[str], allowed: Sequence[str]) -> Column:
    """http(s), no blocked domain, no mail or comment link, and one of the allowed fragments."""
    host, low = F.lower(F.regexp_extract(url, "^https?://([^/?#]*)", 1)), F.lower(url)
    good, bad = F.lit(False), low.contains("mailto:") | low.contains("publiccomment")
    for x in allowed:
        good = good | low.contains(x)
    for x in blocked_domains:
        bad = bad | host.contains(x)
    return url.rlike("^https?://") & good & ~bad


def child_rank(url: Column) -> Column:
    """Struct that orders a landing page's links, best first."""
    low = F.lower(url)
    suffix = F.regexp_extract(F.regexp_extract(low, "^[a-z]+://[^/?#]*([^?#]*)", 1), r"(\.[a-z0-9]+)$", 1)
    word = F.lit(False)
    for w in DOWNLOAD_WORDS:
        word = word | low.contains(w)
    rank = F.when(low.contains("/supdocs/"), 0).when(suffix == ".pdf", 1).when(suffix.isin(OFFICE_SUFFIXES), 2).when(word, 10).when(suffix.isin(".html", ".htm", ""), 20).otherwise(30)
    return F.struct(rank.alias("rank"), low.alias("low"))


def best_child(links: DataFrame, key: str, url: str = "url") -> DataFrame:
    return links.groupBy(key).agg(F.min_by(url, child_rank(F.col(url))).alias(url))


def selected_meetings(meetings: DataFrame, committees: Sequence[int]) -> DataFrame:
    """Meetings of the committees whose title lacks 'sap'."""
    return meetings.where(F.col("committeeId").isin(list(committees)) & ~F.lower(plain(F.coalesce("title", F.lit("")))).contains("sap"))


def agenda_documents(documents: DataFrame, key: str, position: str | None = None) -> DataFrame:
    """One agenda document per key and template name. With a position, documents are compared pairwise in that order as they come:
    type 1 replaces another type, type 3 never replaces another type, else the larger id wins. Without one, type 1 comes before
    others and 3 last, then the larger id, which is the same for types 1 and 3 alone."""
    kept = documents.withColumn("template", F.lower(F.trim(plain(F.col("templateName"))))).where(F.col("template").contains("agenda") | F.col("template").contains("notice of cancellation"))
    if position is None:
        order = F.when(F.col("compileOutputType") == 1, 0).when(F.col("compileOutputType") == 3, 2).otherwise(1)
        return first_per_key(kept, [key, "template"], [order, -F.col("id")])
    others = [c for c in kept.columns if c not in (key, "template", position)]
    listed = kept.groupBy(key, "template").agg(F.sort_array(F.collect_list(F.struct(position, *others))).alias("all"))

    def better(now: Column, new: Column) -> Column:
        a, b = now["compileOutputType"], new["compileOutputType"]
        wins = F.when((b == 1) & (a != 1), True).when((b == 3) & (a != 3), False).otherwise(F.coalesce(new["id"], F.lit(0)) > F.coalesce(now["id"], F.lit(0)))
        return F.when(wins, new).otherwise(now)

    return listed.select(key, "template", F.aggregate(F.slice("all", 2, 1_000_000), F.get("all", 0), better).alias("d")).select(key, "template", "d.*")


# The cards of archived agenda pages, and the fields of a document's page.
CARD = r'(?i)<div data-cms-item-id="[^"]+" class="card upcoming-meeting">'
CARD_TITLE = r'(?i)<h4[^>]*class="card-title">([^<]+)</h4>'
CARD_TIME = r'(?i)data-cms-element-codename="date_and_time">([^<]+)</time>'
CARD_PAGE = r'(?is)<a[^>]+href="([^"]+\.htm[^"]*)"[^>]*>(?:(?!</a>).)*?<span>(Agenda|Supplemental)</span>(?:(?!</a>).)*?</a>\s*<a[^>]+href="([^"]+\.pdf[^"]*)"[^>]*>'
JSON_LD = r'(?is)<script\s+type="application/ld\+json">\s*(\{.*?\})\s*</script>'
DOWNLOAD_LINK = r'(?is)id="bodycontent_hlDownload"[^>]+href="([^"]+)"'
DETAIL_SPANS = {"document_type": "DocumentType", "project": "Project", "program_type": "ProgramType", "project_scope": "Scope", "published_date": "PubDate", "last_modified": "Lastmodified"}


def snapshot_links(pages: DataFrame) -> DataFrame:
    """Archived pages (html) to two rows per link pair of a dated card: meeting_date, body, label, url, for the page and for its PDF."""
    cards = pages.select(F.explode(F.slice(F.split("html", CARD), 2, 1_000_000)).alias("card"))
    pairs = F.arrays_zip(*[F.regexp_extract_all("card", F.lit(CARD_PAGE), i).alias(n) for i, n in ((1, "page"), (2, "label"), (3, "pdf"))])
    found = cards.select(plain(F.regexp_extract("card", CARD_TITLE, 1)).alias("body"), date_iso(plain(F.regexp_extract("card", CARD_TIME, 1))).alias("meeting_date"), F.explode(pairs).alias("p"))
    both = F.array(F.struct(plain(F.col("p.label")).alias("label"), F.col("p.page").alias("url")), F.struct(F.concat(plain(F.col("p.label")), F.lit(" PDF")).alias("label"), F.col("p.pdf").alias("url")))
    return found.where("meeting_date is not null and body <> ''").select("meeting_date", "body", F.explode(both).alias("x")).select("meeting_date", "body", "x.label", "x.url")


def distinct_snapshot_links(links: DataFrame, first: date, last: date) -> DataFrame:
    """Links within the dates, one per url (the first in order), by date, body, label and url."""
    inside = links.where(F.col("meeting_date").between(F.lit(first.isoformat()), F.lit(last.isoformat())))
    return first_per_key(inside, ["url"], [F.col("meeting_date"), F.col("body"), F.col("label")]).orderBy("meeting_date", "body", "label", "url")


def document_details(pages: DataFrame) -> DataFrame:
    """A document's page (document_id, html) to its metadata: embedded JSON, overridden by the page's own fields."""
    said = F.from_json(unescaped(F.regexp_extract("html", JSON_LD, 1)), "name string, datePublished string, dateModified string")
    span = {k: blank_to_null(plain(F.regexp_extract("html", f'(?is)id="bodycontent_lbl{v}">(.*?)</span>', 1))) for k, v in DETAIL_SPANS.items()}
    rows = pages.withColumn("said", said)
    embedded = {"published_date": F.col("said.datePublished"), "last_modified": F.col("said.dateModified")}
    return rows.select("document_id", F.col("said.name").alias("title"), blank_to_null(unescaped(F.regexp_extract("html", DOWNLOAD_LINK, 1))).alias("download_url"), *[F.coalesce(v, embedded.get(k, F.lit(None).cast("string"))).alias(k) for k, v in span.items()])
