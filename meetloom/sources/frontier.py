"""Supporting documents: a frontier of links followed level by level.

A link leads to a document, or to a page whose best trusted link is followed, down to a depth. Chains are rows (start, at, path);
each level looks up the distinct addresses that no level has looked up before, so an address that many chains share, or meet again, is
fetched once. A chain never returns to an address that is on its own path. Links that can't be followed become review rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetloom.functions import files
from meetloom.sources import downloads, fetch, links
from meetloom.sources.steps import stepped

# Which links of an agenda are followed, what tells of documents, and the outcomes.
SKIPPED_DOMAINS = ("webex.com", "zoom.us", "teams.microsoft.com")
ALLOWED_FRAGMENTS = (
    "file.lacounty.gov/sdsinter/bos/supdocs/",
    "file.lacounty.gov/sdsinter/bos/bc/",
    "ftp.pw.lacounty.gov:8443/pub/bos/",
    "lacounty.sharepoint.com/:b:/",
)
SUPPORTING_LABEL = r"(?i)\b(Supporting Document|Attachments:)\b"
DIRECT, FOLLOWED, REVIEW, FAILED, UNLINKED = "direct_download", "followed_landing_page", "html_page_needs_review", "download_error", "supporting_labels_without_trusted_links"

#: Rows of looked-up addresses: url as asked, final_url, is_page, children (a page's links, absolute and in order), sha256, content_type, bytes_downloaded, error.
Lookup = Callable[[DataFrame], DataFrame]


def trusted(url: Column) -> Column:
    return links.is_trusted(url, SKIPPED_DOMAINS, ALLOWED_FRAGMENTS)


def page_links(content: Column, base: Column) -> Column:
    """Absolute distinct links of a page's bytes in order."""

    @F.udf("array<string>", useArrow=True)
    def found(content: bytes, base: str) -> list[str]:
        return fetch.page_links(bytes(content), base) if content is not None else []

    return found(content, base)


def fetched(fetcher: fetch.Fetcher, root: str, **options) -> Lookup:
    """A lookup that downloads addresses (kept below the root) and reads the links of pages."""

    def look(addresses: DataFrame) -> DataFrame:
        got = stepped(downloads.download(addresses, fetcher, root, **options))
        end = F.lower(F.regexp_extract(F.regexp_extract("final_url", "^[A-Za-z]+://[^/?#]*([^?#]*)", 1), r"(\.[A-Za-z0-9]+)$", 1))
        pages = got.withColumn("is_page", F.coalesce((F.lower("content_type") == "text/html") | end.isin(".html", ".htm"), F.lit(False)))
        read = downloads.contents(pages.where("is_page and sha256 is not null").select("url", "final_url", "sha256"), root).select("url", page_links(F.col("content"), F.col("final_url")).alias("children"))
        error = F.when(F.col("sha256").isNull(), F.coalesce("error", F.lit("")))
        return pages.join(read, "url", "left").select("url", "final_url", "is_page", "children", "sha256", "content_type", "bytes_downloaded", error.alias("error"))

    return look


def follow(starts: DataFrame, look: Lookup, follows: Callable[[Column], Column] = trusted, depth: int = 2) -> DataFrame:
    """start, outcome, hops, final_url, sha256, content_type, bytes_downloaded, error of each distinct start (column url)."""
    chains = stepped(starts.select(F.col("url").alias("start"), F.col("url").alias("at"), F.array("url").alias("path")).where("start is not null").distinct())
    seen: DataFrame | None = None
    ended: DataFrame | None = None
    for hops in range(depth + 1):
        ask = chains.select(F.col("at").alias("url")).distinct()
        got = stepped(look(ask if seen is None else ask.join(seen.select("url"), "url", "left_anti")))
        seen = got if seen is None else stepped(seen.unionByName(got))
        here = chains.join(seen.withColumnRenamed("url", "at"), "at")
        open_ = F.filter(F.coalesce("children", F.array().cast("array<string>")), lambda x: follows(x) & ~F.array_contains(F.col("path"), x))
        best = F.array_min(F.transform(open_, lambda x, i: F.struct(links.child_rank(x).alias("rank"), i.alias("nth"), x.alias("url"))))
        goes_on = F.col("error").isNull() & F.col("is_page") & F.col("child").isNotNull() & F.lit(hops < depth)
        here = stepped(here.withColumn("child", best["url"]).withColumn("goes_on", F.coalesce(goes_on, F.lit(False))))
        outcome = F.when(F.col("error").isNotNull(), FAILED).when(F.lit(hops > 0), FOLLOWED).when(F.col("is_page"), REVIEW).otherwise(DIRECT)
        done = here.where(~F.col("goes_on")).select("start", outcome.alias("outcome"), F.lit(hops).alias("hops"), "final_url", "sha256", "content_type", "bytes_downloaded", "error")
        ended = done if ended is None else ended.unionByName(done)
        chains = here.where("goes_on").select("start", F.col("child").alias("at"), F.array_append("path", F.col("child")).alias("path"))
        if chains.isEmpty():
            break
    return ended


def supporting_documents(agendas: DataFrame, look: Lookup, follows: Callable[[Column], Column] = trusted, depth: int = 2) -> tuple[DataFrame, DataFrame]:
    """(documents, review rows) of agendas (external_id, url, text, links in order). A link counts once an agenda, in the order of its first
    place, whether it can be got or not; pages without a link to follow are kept and reviewed as well."""
    listed = agendas.select("external_id", F.col("url").alias("agenda_url"), "text", F.filter(F.array_distinct(F.coalesce("links", F.array().cast("array<string>"))), follows).alias("kept"))
    wanted = listed.select("external_id", "agenda_url", F.posexplode("kept").alias("pos", "url"))
    ended = stepped(follow(wanted.select("url"), look, follows, depth))
    rows = wanted.join(ended, wanted["url"] == ended["start"]).drop("start")
    suffix = files.download_suffix(F.col("final_url"), F.coalesce("content_type", F.lit("")))
    mime = files.download_mime(F.col("content_type"), suffix)
    index = F.col("pos") + 1
    documents = rows.where("error is null").select(
        F.concat(F.lit("doc_"), F.substring(F.sha1(F.col("final_url").cast("binary")), 1, 16)).alias("document_id"), F.col("external_id").alias("parent_external_id"), F.col("final_url").alias("external_id"), F.col("url").alias("asked_url"), index.alias("index"),
        F.concat(files.supporting_filename(F.col("final_url"), index), suffix).alias("file_name"), mime.alias("mime_type"), files.supporting_type(F.col("final_url"), mime, suffix).alias("document_type"), "outcome", "sha256", "bytes_downloaded")
    failed = rows.where("error is not null").select("external_id", "agenda_url", F.col("url").alias("support_url"), F.concat(F.lit(f"{FAILED}: "), "error").alias("reason"))
    pages = rows.where(F.col("outcome") == REVIEW).select("external_id", "agenda_url", F.col("final_url").alias("support_url"), F.col("outcome").alias("reason"))
    bare = listed.where((F.size("kept") == 0) & F.coalesce(F.col("text").rlike(SUPPORTING_LABEL), F.lit(False))).select("external_id", "agenda_url", F.col("agenda_url").alias("support_url"), F.lit(UNLINKED).alias("reason"))
    return documents, failed.unionByName(pages).unionByName(bare)
