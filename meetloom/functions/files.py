"""Scalar functions about downloaded files: names, kinds, dates of listings, addresses and outcomes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meetloom.functions.exprs import blank_to_null, clean_text, date_iso, plain, sanitize_filename, slugify

# Suffixes, media types, addresses and names of kinds.
LISTED_SUFFIXES = [".pdf", ".xlsx", ".xls", ".doc", ".docx"]
MIME_OF_SUFFIX = {
    ".pdf": "application/pdf",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    ".xls": "application/vnd.ms-excel",
    ".doc": "application/msword",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
}
ANY_MIME = "application/octet-stream"
DOWNLOAD_SUFFIXES = [".pdf", ".html", ".htm", ".txt", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".csv"]
SUPPORTING_URL = "https://file.lacounty.gov/SDSInter/bos/supdocs/"
MEETING_SITE = "https://lacity.primegov.com"


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def basename(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)/*$", 1)


def suffix(name: Column) -> Column:
    """The last dot and what follows, lower-cased; '' for none and for names that begin with their only dot."""
    return F.lower(F.regexp_extract(name, r"[^.].*?(\.[^./]+)$", 1))


def listed_suffix(url: Column) -> Column:
    """Suffix of a listing's link, by its file name, else by its id parameter; .pdf unless it is a known one."""
    name = basename(url_path(F.url_decode(F.replace(url, F.lit("+"), F.lit("%2B")))))
    by_id = F.url_decode(F.regexp_extract(url, r"[?&]id=([^&#]*)", 1))
    found = suffix(F.when(name != "", name).otherwise(by_id))
    return F.when(found.isin(LISTED_SUFFIXES), found).otherwise(".pdf")


def listed_mime(suffix_: Column) -> Column:
    known = F.create_map(*[F.lit(x) for kv in MIME_OF_SUFFIX.items() for x in kv])
    return F.coalesce(F.element_at(known, suffix_), F.lit(ANY_MIME))


def download_suffix(url: Column, content_type: Column) -> Column:
    found = suffix(basename(url_path(url)))
    return F.when(found.isin(DOWNLOAD_SUFFIXES), found).when(content_type == "application/pdf", ".pdf").when(content_type == "text/html", ".html").when(content_type.startswith("text/"), ".txt").otherwise(".bin")


def download_mime(content_type: Column, suffix_: Column) -> Column:
    return F.coalesce(blank_to_null(content_type), F.when(suffix_ == ".pdf", "application/pdf").when(suffix_.isin(".html", ".htm"), "text/html").when(suffix_ == ".txt", "text/plain"), F.lit(ANY_MIME))


def supporting_type(url: Column, mime: Column, suffix_: Column) -> Column:
    low = F.lower(url)
    return (F.when(low.contains("/supdocs/") & (suffix_ == ".pdf"), "ceo_supporting_document_pdf").when((mime == "text/html") | suffix_.isin(".html", ".htm"), "ceo_supporting_document_page")
            .when(suffix_ == ".pdf", "ceo_supporting_document_pdf").otherwise("ceo_supporting_document_file"))


def supporting_filename(url: Column, index: Column) -> Column:
    """supporting_007_name from an address; the bare number where it has no file name."""
    name = F.regexp_replace(basename(url_path(url)), r"(?<=.)\.[^.]*$", "")
    return F.concat(F.lit("supporting_"), F.lpad(index.cast("string"), 3, "0"), F.when(name != "", F.concat(F.lit("_"), slugify(name, "agenda"))).otherwise(""))


def supporting_url(filename: Column) -> Column:
    """The address that a stored supporting file came from, for numbers and POCnn-nnnn names; else null."""
    token = F.regexp_extract(F.regexp_replace(basename(filename), r"(?<=.)\.[^.]*$", ""), r"(?i)^supporting_\d+_(.+)$", 1)
    return F.when(token.rlike(r"(?i)^(\d+|POC\d{2}-\d{4})$"), F.concat(F.lit(SUPPORTING_URL), token, F.lit(".pdf")))


def link_filename(url: Column, meeting_date: Column, text: Column, category: Column) -> Column:
    """A link's file name, else one from date and text."""
    made = F.concat(sanitize_filename(F.trim(F.coalesce(blank_to_null(meeting_date), F.lit("undated")))), F.lit("_"), sanitize_filename(F.trim(text)), F.when(category == "board_agenda_page", ".html").otherwise(".pdf"))
    name = basename(url_path(url))
    return F.when(name != "", sanitize_filename(F.trim(name))).otherwise(made)


def document_kind(text: Column, url: Column, category: Column) -> Column:
    words, low = F.lower(text), F.lower(url)
    return (F.when(category == "board_agenda_page", "board_agenda_page").when(low.contains("supdocs"), "board_supporting_document").when(words.contains("cluster") | low.contains("clusteragendas"), "cluster_agenda_packet")
            .when(words.contains("agenda"), "agenda_packet").otherwise("linked_pdf"))


def empty_to_null(c: Column) -> Column:
    return blank_to_null(plain(c))


def lenient_date(c: Column) -> Column:
    """yyyy-MM-dd from two forms, else the cleaned text as it is."""
    raw = empty_to_null(c)
    return F.coalesce(F.date_format(F.coalesce(F.try_to_date(raw, "yyyy-M-d"), F.try_to_date(raw, "M/d/yyyy")), "yyyy-MM-dd"), raw)


def lenient_datetime(c: Column) -> Column:
    """yyyy-MM-ddTHH:mm:ss from three forms, else the cleaned text as it is."""
    raw = empty_to_null(c)
    found = F.coalesce(F.try_to_timestamp(raw, F.lit("yyyy-M-d")), F.try_to_timestamp(F.upper(raw), F.lit("M/d/yyyy h:m:s a")), F.try_to_timestamp(raw, F.lit("M/d/yyyy")))
    return F.coalesce(F.date_format(found, "yyyy-MM-dd'T'HH:mm:ss"), raw)


def listing_date(c: Column) -> Column:
    """Of 'date, more' the date: as it is with a hyphen in it, else from m/d/yyyy; '' for none, null where it is neither."""
    raw = F.trim(F.split(F.trim(F.coalesce(c, F.lit(""))), ",")[0])
    return F.when(raw == "", "").when(raw.contains("-"), raw).otherwise(F.date_format(F.try_to_date(raw, "M/d/yyyy"), "yyyy-MM-dd"))


def meeting_document_url(link: Column, kind: Column, template_id: Column, document_id: Column) -> Column:
    """Address of a compiled meeting document: its own link, else by template, else by file; kind 3 is a page."""
    template = F.coalesce(template_id, F.lit(0)) > 0
    which = F.when(template, F.concat(F.lit("meetingTemplateId="), template_id.cast("string"))).otherwise(F.concat(F.lit("compiledMeetingDocumentFileId="), document_id.cast("string")))
    page = F.concat(F.lit(f"{MEETING_SITE}/Portal/Meeting?"), which, F.lit("&parentLink=newPublicPortal"))
    file = F.concat(F.lit(f"{MEETING_SITE}/Public/CompiledDocument?"), which, F.lit("&compileOutputType="), kind.cast("string"))
    return F.coalesce(blank_to_null(link), F.when(kind == 3, page).otherwise(file))


def meeting_external_id(committee: Column, meeting: Column, template_id: Column, document_id: Column, kind: Column) -> Column:
    which = F.when(F.coalesce(template_id, F.lit(0)) != 0, template_id).otherwise(document_id)
    return F.concat_ws(":", F.lit("primegov"), *[c.cast("string") for c in (committee, meeting, which, kind)])


def processing_status(suffix_: Column, extraction: Column) -> Column:
    """Struct of status and review: a PDF is ready only with its text, a page always."""
    pdf = F.lower(suffix_) == ".pdf"
    status = F.when(pdf & (extraction == "extracted"), "ready").when(pdf, "downloaded_without_text").when(F.lower(suffix_) == ".html", "ready").otherwise("downloaded")
    review = F.when(pdf & ~F.coalesce(extraction == "extracted", F.lit(False)), "needs_manual_review").otherwise("not_needed")
    return F.struct(status.alias("processing_status"), review.alias("review_status"))


def fetch_error(kind: Column, http_code: Column) -> Column:
    """Struct of code and retryable for a failed fetch; kind is http, missing, url or anything else."""
    code = F.when(kind == "http", F.concat(F.lit("http_"), http_code.cast("string"))).when(kind == "missing", "file_not_found").when(kind == "url", "url_error").otherwise("unexpected_fetch_error")
    again = F.when(kind == "http", (http_code >= 500) | http_code.isin(408, 429)).otherwise(F.coalesce(kind == "url", F.lit(False)))
    return F.struct(code.alias("code"), again.alias("retryable"))


def has_parser_warning(parser: Column) -> Column:
    from meetloom.functions.rules import NON_ITEM_PARSERS

    return F.coalesce(parser.isin(NON_ITEM_PARSERS), F.lit(False))


def legacy_manifest_row(row: dict[str, Column]) -> dict[str, Column]:
    """Fields of an older manifest's entry by chains of fallbacks; '' counts as lacking."""
    chain = {
        "requested_name": ("requested_name", "body_name"), "body_name": ("body_name", "requested_name"), "label": ("label",), "agenda_date": ("agenda_date", "meeting_date"),
        "url": ("url", "source_url", "external_id"), "file_path": ("file_path",), "sha256": ("sha256",), "external_id": ("external_id", "url"),
    }
    default = {"status": "downloaded", "document_type": "ceo_agenda_pdf", "mime_type": "application/pdf"}
    first = lambda names, other: F.coalesce(*[blank_to_null(row[n]) for n in names if n in row], F.lit(other))
    out = {k: first(names, "") for k, names in chain.items()} | {k: first((k,), v) for k, v in default.items()}
    made = F.concat(F.lit("doc_"), F.substring(F.sha1(out["external_id"].cast("binary")), 1, 16))
    return out | {"document_id": F.coalesce(blank_to_null(row["document_id"]), made) if "document_id" in row else made}


def label_date(c: Column) -> Column:
    """'Month d, yyyy' anywhere in a label, as yyyy-MM-dd."""
    return date_iso(clean_text(F.regexp_extract(c, r"([A-Za-z]+\s+\d{1,2},\s+\d{4})", 1)))
