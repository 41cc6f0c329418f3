"""Mail notices as DataFrames: links, kinds, dates and bodies from subjects; built-in expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meetloom.functions.exprs import date_iso, html_to_text, plain, title_case, unescaped

_TEXT = T.StringType()
_ATTACHMENT = T.StructType([T.StructField(n, _TEXT) for n in ("filename", "mime_type", "content")])
MESSAGE = T.StructType([T.StructField("id", _TEXT), T.StructField("from_", _TEXT), T.StructField("to", T.ArrayType(_TEXT)), *[T.StructField(n, _TEXT) for n in ("subject", "body", "email_ts")], T.StructField("attachments", T.ArrayType(_ATTACHMENT))])

# How links, subjects and senders are told apart.
MARKDOWN_LINK = r"\[([^\]]+)\]\(((?:https?|file)://[^)]+)\)"
SUBJECT_DATE = r"([A-Za-z]+\s+\d{1,2},\s+\d{4})"
SUBJECT_PREFIX = r"(?i)^\s*(\d{1,2}/\d{1,2}/\d{4})\s+(\d{1,2}:\d{2}\s*[AP]M)\s*-\s*"
COUNTY_KINDS = [("cluster meeting agendas", "cluster_meeting_agendas"), ("supplemental agenda", "supplemental_board_agenda"), ("agenda spotlight", "agenda_spotlight"), ("agenda for the board meeting", "board_agenda"), ("agendas for the board meetings", "board_agenda")]
CITY_KINDS = [("cancelled", "meeting_cancellation_notice"), ("agenda", "agenda_notice")]
DOWNLOADED = ["direct_pdf", "board_agenda_page"]


#: Message files as they come, under any of the names that from_aliases knows.
_RAW_ATTACHMENT = T.StructType([T.StructField(n, _TEXT) for n in ("filename", "name", "mime_type", "mimeType", "content", "body", "text", "content_text", "attachment_id", "attachmentId", "path", "file_path")])
RAW_MESSAGE = T.StructType([T.StructField("id", _TEXT), T.StructField("from_", _TEXT), T.StructField("to", T.ArrayType(_TEXT)), *[T.StructField(n, _TEXT) for n in ("subject", "body", "text", "content_text", "email_ts")], T.StructField("attachments", T.ArrayType(_RAW_ATTACHMENT))])


def read_messages(spark, path: str) -> DataFrame:
    """Message files, one JSON object each, whatever names their fields have."""
    return from_aliases(spark.read.schema(RAW_MESSAGE).option("multiLine", True).json(path))


def kind_of(subject: Column, kinds: Sequence[tuple[str, str]]) -> Column:
    low = F.lower(subject)
    return F.coalesce(*[F.when(low.contains(word), name) for word, name in kinds], F.lit("unknown"))


def is_relevant(sender: Column, patterns: Sequence[str]) -> Column:
    low, out = F.lower(sender), F.lit(False)
    for x in patterns:
        out = out | low.contains(x.lower())
    return out


def resolved_url(url: Column) -> Column:
    """Tracking links hold the target as an encoded path part; others stay."""
    host = F.regexp_extract(url, "^[a-z]+://([^/?#]*)", 1)
    part = F.regexp_extract(url, r"/(https?:%2F%2F[^/?#]*)", 1)
    return F.when(host.contains("govdelivery.com") & (part != ""), F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))).otherwise(url)


def category_of(url: Column) -> Column:
    host, path = F.lower(F.regexp_extract(url, "^[a-z]+://([^/?#]*)", 1)), F.lower(F.regexp_extract(url, "^[a-z]+://[^/?#]*([^?#;]*)", 1))
    board = host == "bos.lacounty.gov"
    return (F.when(path.endswith(".pdf"), "direct_pdf").when(board & path.contains("live-broadcast"), "live_board_page").when(board & path.contains("board-meeting-agendas"), "board_agenda_page")
            .when(host.contains("publiccomment.bos.lacounty.gov"), "public_comment_page").when(host.endswith("lacounty.gov"), "lacounty_page").otherwise("external_page"))


def message_links(messages: DataFrame) -> DataFrame:
    """id, pos, text, original_url, resolved_url, category: the Markdown links of each body in order."""
    pairs = F.arrays_zip(F.regexp_extract_all("body", F.lit(MARKDOWN_LINK), 1).alias("text"), F.regexp_extract_all("body", F.lit(MARKDOWN_LINK), 2).alias("url"))
    links = messages.select("id", F.posexplode(pairs).alias("pos", "l"))
    return links.select("id", "pos", F.trim("l.text").alias("text"), F.col("l.url").alias("original_url"), resolved_url(F.col("l.url")).alias("resolved_url")).withColumn("category", category_of(F.col("resolved_url")))


def download_targets(links: DataFrame) -> DataFrame:
    """The first link of each url that is worth fetching, per message."""
    from meetloom.operators.ranking import first_per_key

    return first_per_key(links.where(F.col("category").isin(DOWNLOADED)), ["id", "resolved_url"], [F.col("pos")])


def assess(messages: DataFrame, patterns: Sequence[str], kinds: Sequence[tuple[str, str]] = tuple(COUNTY_KINDS)) -> DataFrame:
    """id, message_type, meeting_date, relevant."""
    date = F.coalesce(date_iso(F.regexp_extract("subject", SUBJECT_PREFIX, 1)), date_iso(F.regexp_extract("subject", SUBJECT_DATE, 1)))
    return messages.select("id", kind_of(F.col("subject"), kinds).alias("message_type"), date.alias("meeting_date"), is_relevant(F.col("from_"), patterns).alias("relevant"))


def body_of_subject(subject: Column) -> Column:
    """What is left of a notice's subject without date, time, and the words that say what it is; null if nothing is."""
    t = F.regexp_replace(subject, SUBJECT_PREFIX, "")
    t = F.regexp_replace(t, " - CANCELL?ED - ", " ")
    t = F.regexp_replace(F.regexp_replace(t, r"\s+", " "), r"(?i)\b(?:Agenda|Meeting)\b", "")
    return F.nullif(F.regexp_replace(t, "^[ -]+|[ -]+$", ""), F.lit(""))


PAGE_URL = r"(?i)(https://(?:lacity|portal-lacity)\.primegov\.com/Portal/Meeting\?meetingTemplateId=(\d+))"


def notices(messages: DataFrame) -> DataFrame:
    """One row per HTML attachment with content, in order: what the notice says of body, time, place on the web, and cancellation."""
    a = messages.select("id", "subject", F.posexplode("attachments").alias("pos", "a")).select("id", "subject", "pos", "a.*")
    a = a.where((F.lower("filename").rlike(r"\.html?$") | (F.lower("mime_type") == "text/html")) & (F.trim(F.coalesce("content", F.lit(""))) != ""))
    text = F.when(F.col("content").contains("<") & F.col("content").contains(">"), html_to_text(F.col("content"))).otherwise(plain(unescaped(F.col("content"))))
    a = a.withColumn("text", text)
    day, clock = F.regexp_extract("subject", SUBJECT_PREFIX, 1), F.upper(F.regexp_extract("subject", SUBJECT_PREFIX, 2))
    instant = F.try_to_timestamp(F.concat(day, F.lit(" "), F.regexp_replace(clock, r"\s", "")), F.lit("M/d/yyyy h:mma"))
    shouted = F.filter(F.transform(F.split("text", "\n"), lambda x: F.regexp_replace(x, "^[ -]+|[ -]+$", "")), lambda x: x.rlike(r"\p{L}") & (F.upper(x) == x) & F.lower(x).rlike("city council|committee"))
    found = F.replace(title_case(F.get(shouted, 0)), F.lit("La"), F.lit("LA"))
    return a.select(
        "id", "pos", "filename", "mime_type", F.coalesce(found, body_of_subject(F.col("subject"))).alias("body_name"), date_iso(day).alias("meeting_date"), F.nullif(F.replace(clock, F.lit("  "), F.lit(" ")), F.lit("")).alias("meeting_time"),
        F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss").alias("meeting_datetime"), (F.lower("subject").contains("cancelled") | F.lower("text").contains("notice of cancellation")).alias("is_cancellation"),
        F.nullif(F.regexp_extract("content", PAGE_URL, 1), F.lit("")).alias("page_url"), F.nullif(F.regexp_extract("content", PAGE_URL, 2), F.lit("")).alias("page_template_id"), F.substring("text", 1, 400).alias("text_excerpt"),
    )


def notice_links(found: DataFrame) -> DataFrame:
    """The first notice of each meeting page of a message as a link."""
    from meetloom.operators.ranking import first_per_key

    named = found.where("page_url is not null").select("id", "page_url", "pos", F.coalesce("body_name", F.lit("LA City agenda")).alias("text"))
    return first_per_key(named, ["id", "page_url"], [F.col("pos")]).withColumn("category", F.lit("primegov_meeting_page"))


def city_assessments(messages: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """id, message_type, meeting_date, relevant: the subject's date, else the first notice's."""
    first = notices(messages).where("meeting_date is not null").groupBy("id").agg(F.min_by("meeting_date", "pos").alias("noticed"))
    mine = messages.select("id", kind_of(F.col("subject"), CITY_KINDS).alias("message_type"), date_iso(F.regexp_extract("subject", SUBJECT_PREFIX, 1)).alias("said"), is_relevant(F.col("from_"), patterns).alias("relevant"))
    return mine.join(first, "id", "left").select("id", "message_type", F.coalesce("said", "noticed").alias("meeting_date"), "relevant")


def notice_documents(messages: DataFrame) -> DataFrame:
    """Notices with the content of the attachment of that name (the last of equals), ready to be stored."""
    held = messages.select("id", F.posexplode("attachments").alias("at", "a")).groupBy("id", F.col("a.filename").alias("filename")).agg(F.max_by(F.col("a.content"), "at").alias("content"))
    return notices(messages).join(held, ["id", "filename"], "left").withColumn("external_id", F.concat_ws(":", F.lit("gmail_notice"), "id", "filename"))


def from_aliases(raw: DataFrame) -> DataFrame:
    """Messages whose fields come under other names in the names used here. An attachment's name, type and content are the first of their names that
    is not blank; one without a name is called 'attachment'."""
    have = set(raw.columns)
    pick = lambda *names: F.coalesce(*[F.col(n) for n in names if n in have], F.lit(None).cast("string"))
    kept = [c for c in ("id", "from_", "to", "subject", "email_ts", "attachments") if c in have]
    out = raw.select(*kept, pick("body", "text", "content_text").alias("body"))
    if "attachments" not in have:
        return out
    inner = raw.schema["attachments"].dataType.elementType.names
    of = lambda a, *names: F.coalesce(*[F.when(F.trim(a[n]) != "", a[n]) for n in names if n in inner], F.lit(None).cast("string"))
    fixed = F.transform("attachments", lambda a: F.struct(F.coalesce(of(a, "filename", "name"), F.lit("attachment")).alias("filename"), of(a, "mime_type", "mimeType").alias("mime_type"), of(a, "content", "body", "text", "content_text").alias("content")))
    return out.withColumn("attachments", fixed)
