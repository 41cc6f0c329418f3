"""Listings of meeting sites as tables: a data source whose partitions are date windows or pages, a fallback, an archive chain, a search.

Each adapter turns answers into work for the ledger: (url, title, meeting_date, body). Answers are stored before they are
parsed, so a listing is asked once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from meetloom.functions import files
from meetloom.operators.ranking import first_n_per_scope, first_per_key, thin_snapshots
from meetloom.sources import fetch as net
from meetloom.sources import links
from meetloom.sources.steps import stepped

# Where the sites answer, and the fields of their answers.
MEETINGS_URL = "https://lacity.primegov.com/api/v2/PublicPortal/ListArchivedMeetingsByDate?fromDate={first:%m-%d-%Y}&toDate={last:%m-%d-%Y}"
COMMITTEES = (1, 104)
AGENDA_DATA_URL = "https://ceo.lacounty.gov/wp-json/blade-child/v1/agenda-data"
AGENDAS_PAGE = "https://ceo.lacounty.gov/agendas/"
BOARD_PAGE = "https://bos.lacounty.gov/board-meeting-agendas/"
ARCHIVE_INDEX = "https://web.archive.org/cdx/search/cdx?url=https://bos.lacounty.gov/board-meeting-agendas/&from={first:%Y%m}&to={last:%Y%m}&output=json&fl=timestamp&filter=statuscode:200"
ARCHIVE_PAGE = "https://web.archive.org/web/{timestamp}id_/https://bos.lacounty.gov/board-meeting-agendas/"
DOCUMENTS_PAGE = "https://www.lahsa.org/documents"
MEETING = "array<struct<id: long, committeeId: long, title: string, dateTime: string, documentList: array<struct<id: long, templateId: long, templateName: string, compileOutputType: int, link: string>>>>"
AGENDA_ROW = "array<struct<date: string, deptAbbrv: string, url: string, title: string, documentTitle: string, originalFileName: string>>"
API, STATIC = "agenda_data_api", "static_html_fallback"
ANSWER = "window_from string, window_to string, url string, body string, error string"


class Ask(InputPartition):
    def __init__(self, first: str, last: str, url: str):
        super().__init__((first, last, url))


def answers_of(fetch: net.Fetcher, tries: int = 3) -> type[DataSource]:
    """The data source `meetloom_answers`: one partition and row per asked address (options: asks, a JSON list of [from, to, url]).
    What fails is a row with its error."""

    class Reader(DataSourceReader):
        def __init__(self, asks: list[list[str]]):
            self.asks = asks

        def partitions(self) -> Sequence[InputPartition]:
            return [Ask(*a) for a in self.asks]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            first, last, url = partition.value
            got = net.fetch_one(url, fetch, tries)
            text = None if got["content"] is None else got["content"].decode("utf-8-sig", "ignore")
            yield first, last, url, text, got["error"] if got["content"] is None else None

    class Answers(DataSource):
        @classmethod
        def name(cls) -> str:
            return "meetloom_answers"

        def schema(self) -> str:
            return ANSWER

        def reader(self, schema) -> DataSourceReader:
            return Reader(json.loads(self.options["asks"]))

    return Answers


def asked(spark: SparkSession, fetch: net.Fetcher, asks: Sequence[tuple[str, str, str]], tries: int = 3) -> DataFrame:
    """window_from, window_to, url, body, error of each ask, asked once."""
    spark.dataSource.register(answers_of(fetch, tries))
    return stepped(spark.read.format("meetloom_answers").option("asks", json.dumps([list(a) for a in asks])).load())


def windows(first: date, last: date, days: int = 31) -> list[tuple[date, date]]:
    """Consecutive windows of at most so many days that cover first to last."""
    out = []
    while first <= last:
        end = min(last, first + timedelta(days=days - 1))
        out.append((first, end))
        first = end + timedelta(days=1)
    return out


def archived_meetings(spark: SparkSession, fetch: net.Fetcher, first: date, last: date, days: int = 31, template: str = MEETINGS_URL) -> DataFrame:
    """Meetings of a portal, a partition a window; a meeting that two windows name comes once. A window that fails raises with its address."""
    got = asked(spark, fetch, [(a.isoformat(), b.isoformat(), template.format(first=a, last=b)) for a, b in windows(first, last, days)])
    if bad := got.where("error is not null").limit(5).collect():
        raise RuntimeError("; ".join(f"{r['url']}: {r['error']}" for r in bad))
    return got.select(F.explode(F.from_json("body", MEETING)).alias("m")).select("m.*").dropDuplicates(["id"])


def meeting_work(meetings: DataFrame, committees: Sequence[int] = COMMITTEES) -> DataFrame:
    """Agenda documents of the selected meetings as work."""
    chosen = links.selected_meetings(meetings, committees)
    docs = chosen.select(F.col("id").alias("meeting"), "title", F.to_date(F.substring("dateTime", 1, 10)).alias("meeting_date"), F.posexplode("documentList").alias("pos", "d")).select("meeting", "title", "meeting_date", "pos", "d.*")
    best = links.agenda_documents(docs, "meeting", "pos")
    address = files.meeting_document_url(F.col("link"), F.col("compileOutputType"), F.col("templateId"), F.col("id"))
    return best.select(address.alias("url"), "title", F.col("meeting_date").cast("string").alias("meeting_date"), F.lit(None).cast("string").alias("body"))


def with_fallback(rows: DataFrame, method: str, other: Callable[[], DataFrame], other_method: str) -> DataFrame:
    """The rows with their method, or, if there are none, those of the other way; `other` is asked only then."""
    if not rows.isEmpty():
        return rows.withColumn("method", F.lit(method))
    return other().withColumn("method", F.lit(other_method))


def agenda_sections(spark: SparkSession, fetch: net.Fetcher, names: Mapping[str, str], data_url: str = AGENDA_DATA_URL, page: str = AGENDAS_PAGE) -> DataFrame:
    """body, label, agenda_date, url, method: by the data address; if it fails, is no list or has no good row, by the headings of the page."""
    told = asked(spark, fetch, [("", "", data_url)], tries=1).select(F.explode(F.from_json("body", AGENDA_ROW)).alias("r")).select("r.*")
    rows = links.api_agendas(told, names)

    def by_page() -> DataFrame:
        got = asked(spark, fetch, [("", "", page)])
        if bad := got.where("error is not null").first():
            raise RuntimeError(f"{bad['url']}: {bad['error']}")
        return links.heading_agendas(got.select(F.col("body").alias("html"))).drop("pos")

    return with_fallback(rows, API, by_page, STATIC)


def archive_timestamps(spark: SparkSession, fetch: net.Fetcher, first: date, last: date, days: int = 6, template: str = ARCHIVE_INDEX) -> DataFrame:
    """scope, timestamp of the archive's copies, thinned so that kept days lie at least so many days apart. The index comes a year a partition."""
    got = asked(spark, fetch, [(a.isoformat(), b.isoformat(), template.format(first=a, last=b)) for a, b in windows(first, last, 366)])
    if bad := got.where("error is not null").first():
        raise RuntimeError(f"{bad['url']}: {bad['error']}")
    rows = got.select(F.posexplode(F.from_json("body", "array<array<string>>")).alias("pos", "r")).where("pos > 0").select(F.lit("page").alias("scope"), F.col("r")[0].alias("timestamp")).distinct()
    by_day = rows.withColumn("day", F.to_timestamp(F.substring("timestamp", 1, 8), "yyyyMMdd")).groupBy("scope", "day").agg(F.min("timestamp").alias("timestamp"))
    return by_day.join(thin_snapshots(by_day, "scope", "day", days), ["scope", "day"]).select("scope", "timestamp")


def archived_links(spark: SparkSession, fetch: net.Fetcher, first: date, last: date, page: str = ARCHIVE_PAGE) -> DataFrame:
    """Links of the kept copies within the dates, one a url; copies that can't be got are passed over. The number of copies is bounded by the calendar."""
    stamps = [r["timestamp"] for r in archive_timestamps(spark, fetch, first, last).orderBy("timestamp").collect()]
    got = asked(spark, fetch, [("", "", page.format(timestamp=t)) for t in stamps])
    return links.distinct_snapshot_links(links.snapshot_links(got.where("body is not null").select(F.col("body").alias("html"))), first, last)


def current_links(spark: SparkSession, fetch: net.Fetcher, first: date, last: date, page: str = BOARD_PAGE) -> DataFrame:
    got = asked(spark, fetch, [("", "", page)])
    if bad := got.where("error is not null").first():
        raise RuntimeError(f"{bad['url']}: {bad['error']}")
    return links.distinct_snapshot_links(links.snapshot_links(got.select(F.col("body").alias("html"))), first, last)


def library_documents(spark: SparkSession, fetch: net.Fetcher, scopes: Sequence[str] | None, keywords: Sequence[str], most: int, page: str = DOCUMENTS_PAGE) -> DataFrame:
    """scope_id, document_id, title, url of a document library: of each scope the first `most` documents whose title holds a keyword."""
    if scopes is None:
        front = asked(spark, fetch, [("", "", page)])
        scopes = [r["scope_id"] for r in links.scope_tiles(front.select(F.coalesce("body", F.lit("")).alias("html"))).collect()]
    got = asked(spark, fetch, [(s, "", f"{page}?scope={s}") for s in scopes])
    cards = links.with_keywords(links.document_cards(got.where("body is not null").select(F.col("window_from").alias("scope_id"), F.col("body").alias("html"))), keywords)
    return first_n_per_scope(cards, "scope_id", [F.col("pos")], most).select("scope_id", "document_id", "title", F.concat(F.lit(f"{page}?id="), "document_id").alias("url"))


def search_all(spark: SparkSession, fetch: net.Fetcher, address: Callable[[int], str], rows_of: Callable[[DataFrame], DataFrame], key: Sequence[Column], at_once: int = 8, most_pages: int = 100_000) -> DataFrame:
    """All results of a paged search. Pages are asked a few at once, until a group of them brings nothing new. rows_of makes rows of answers
    (page, body); a result's identity is the first of `key` that is not blank (its id, else its address), and the first page that has it counts."""
    found: DataFrame | None = None
    for start in range(0, most_pages, at_once):
        got = asked(spark, fetch, [(str(p), "", address(p)) for p in range(start, start + at_once)])
        rows = rows_of(got.where("body is not null").select(F.col("window_from").cast("int").alias("page"), "body"))
        rows = first_per_key(rows.withColumn("identity", F.coalesce(*[F.nullif(F.trim(k), F.lit("")) for k in key])).where("identity is not null"), ["identity"], [F.col("page")])
        new = stepped(rows if found is None else rows.join(found.select("identity"), "identity", "left_anti"))
        if new.isEmpty():
            break
        found = new if found is None else stepped(found.unionByName(new))
    return found.drop("identity") if found is not None else rows.drop("identity")
