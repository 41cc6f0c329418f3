"""All queries of the document engine and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meetloom.functions import exprs, files, rules
from meetloom.operators import findings as fnd
from meetloom.operators import health
from meetloom.operators import items as itm
from meetloom.operators import ranking
from meetloom.plans.crosswalk import ITEMS_SQL, items, table, tags_sql, topics
from meetloom.sources import downloads, fetch, frontier, jobs, ledger, links, mail, manifests, registry_log, screening, store

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


TAGGED_SQL = f"i AS ({ITEMS_SQL}), t AS (SELECT *, {tags_sql()} AS tags FROM i)"
ITEM_ORDER = "coalesce(meeting_date_iso, meeting_date) DESC NULLS LAST, cluster_name NULLS FIRST, section_number NULLS FIRST, item_label NULLS FIRST, agenda_item_id"
FOLDED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = items(spark, sf_dir)
    return rows.withColumn("topic_tags", exprs.topic_tags(F.col("text_block"), rules.DEMO_RULES))


def _fetch(spark: SparkSession, sf_dir: str, **filters) -> DataFrame:
    rows = items(spark, sf_dir)
    return itm.fetch_items(rows, topics(rows), itm.ItemFilters(**filters))


def _listed(df: DataFrame) -> DataFrame:
    return df.select("agenda_item_id", "source_id", "cluster_name", "meeting_date", "section_number", "item_label", F.array_join("topic_tags", ",").alias("tags"))


@query(f"""WITH {TAGGED_SQL} SELECT agenda_item_id, source_id, cluster_name, meeting_date, section_number, item_label, array_to_string(tags, ',') AS tags FROM t
WHERE list_contains(tags, 'origin') AND ({FOLDED.format('title')} LIKE '%th_re%' OR {FOLDED.format('text_block')} LIKE '%th_re%') ORDER BY {ITEM_ORDER} LIMIT 50""")
def items_filtered_topic_search(spark, sf_dir):
    return _listed(_fetch(spark, sf_dir, topic="origin", search="Th_re"))


@query(f"""WITH {TAGGED_SQL} SELECT agenda_item_id, source_id, cluster_name, meeting_date, section_number, item_label, array_to_string(tags, ',') AS tags FROM t
WHERE source_id = 'src3' AND cluster_name = 'en' ORDER BY {ITEM_ORDER} LIMIT 100""")
def items_equality_filters(spark, sf_dir):
    return _listed(_fetch(spark, sf_dir, source_id="src3", cluster_name="en", meeting_date="", limit=100))


@query(f"WITH {TAGGED_SQL}, l AS (SELECT * FROM t ORDER BY {ITEM_ORDER} LIMIT 500) SELECT tag AS topic_tag, count(*)::BIGINT AS items FROM (SELECT unnest(tags) AS tag FROM l) GROUP BY tag")
def topic_summary_limited(spark, sf_dir):
    return itm.count_by_topic(_fetch(spark, sf_dir, limit=500))


@query(f"WITH {TAGGED_SQL}, l AS (SELECT * FROM t ORDER BY {ITEM_ORDER} LIMIT 500) SELECT coalesce(nullif(cluster_name, ''), 'Unknown Cluster') AS body, count(*)::BIGINT AS items FROM l GROUP BY 1")
def body_summary_limited(spark, sf_dir):
    return itm.count_by_body(_fetch(spark, sf_dir, limit=500))


@query("""SELECT count(CASE WHEN source <> '' THEN 1 END)::BIGINT AS with_motion, count(CASE WHEN lang <> '' THEN 1 END)::BIGINT AS with_second, 0::BIGINT AS with_action, count(quality)::BIGINT AS with_vote,
count(CASE WHEN coalesce(toxic, 0) = 0 AND quality IS NOT NULL THEN 1 END)::BIGINT AS unanimous, count(CASE WHEN quality IS NOT NULL AND coalesce(toxic, 0) <> 0 THEN 1 END)::BIGINT AS split
FROM documents LEFT JOIN labels USING (doc_id)""")
def vote_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return itm.parliamentary_counts(rows.select(F.col("source").alias("motion_by"), F.col("lang").alias("second_by"), F.lit("").alias("final_action"), F.col("quality").alias("ayes_count"), F.col("toxic").alias("noes_count"), F.lit(None).cast("int").alias("abstain_count")))


@query("SELECT source AS value, count(*)::BIGINT AS items FROM documents WHERE source <> '' GROUP BY 1")
def movers_ranked(spark, sf_dir):
    return itm.ranked(items(spark, sf_dir), "source_id")


@query(f"WITH {TAGGED_SQL}, l AS (SELECT * FROM t ORDER BY {ITEM_ORDER} LIMIT 100) SELECT agenda_item_id, array_to_string(tags, ',') AS tags FROM l WHERE list_has_any(tags, ['contact', 'licence']) ORDER BY {ITEM_ORDER} LIMIT 10")
def digest_high_signal(spark, sf_dir):
    return itm.high_signal(_fetch(spark, sf_dir, limit=100), ["contact", "licence"]).select("agenda_item_id", F.array_join("topic_tags", ",").alias("tags"))


@query(f"WITH {TAGGED_SQL} SELECT agenda_item_id, array_to_string(tags, ',') AS tags FROM t")
def topic_tags(spark, sf_dir):
    return _tagged(spark, sf_dir).select("agenda_item_id", F.array_join("topic_tags", ",").alias("tags"))


def _has(word: str, *columns: str) -> str:
    return " OR ".join(f"contains({c}, '{word}')" for c in columns or ("low",))


_ACTION_SQL = "CASE " + " ".join(f"WHEN contains(low, '{w}') THEN '{a}'" for w, a in rules.ACTION_RULES) + " WHEN contains(lower(section_title), 'presentation') THEN 'discussion_item' ELSE 'informational_item' END"
_SCORE_SQL = "2 * len(list_intersect(tags, ['contact', 'licence', 'origin'])) + (action IN ('contract_amendment', 'contract_award', 'sole_source_contract'))::INT" + "".join(f" + contains(low, '{w}')::INT" for w in rules.HIGH_PRIORITY_KEYWORDS)
_TREND_SQL = "CASE WHEN " + " OR ".join(f"contains(low, '{w}')" for w in rules.TREND_KEYWORDS) + " THEN 'recurring_vendor_or_contract_pattern' WHEN list_has_any(tags, ['contact', 'licence', 'origin']) THEN 'policy_watch' WHEN action IN ('board_approval', 'contract_award', 'policy_adoption') THEN 'board_decision' ELSE 'routine_monitoring' END"
_DEMO_WHY = {"contact": "it names somebody", "licence": "it grants a right", "origin": "it tells a source"}
_WHY_SQL = "CASE WHEN len(told) > 0 THEN 'This matters because ' || array_to_string(told[1:2], ' and ') || '.' ELSE '" + rules.NO_EXPLANATION + "' END || CASE priority_level " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.PRIORITY_SENTENCES.items()) + " END"
FINDINGS_SQL = f"""{TAGGED_SQL}, a AS (SELECT *, lower(coalesce(title, '') || ' ' || coalesce(text_block, '')) AS low FROM t), b AS (SELECT *, {_ACTION_SQL} AS action FROM a),
s AS (SELECT *, {_SCORE_SQL} AS score, {_TREND_SQL} AS trend_signal FROM b), p AS (SELECT *, CASE WHEN score >= 5 THEN 'high' WHEN score >= 2 THEN 'medium' ELSE 'low' END AS priority_level,
list_filter(list_transform(tags, lambda x: CASE x {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _DEMO_WHY.items())} END), lambda x: x IS NOT NULL) AS told FROM s),
f AS (SELECT 'finding_' || substr(sha1(agenda_item_id::VARCHAR), 1, 16) AS finding_id, agenda_item_id, source_id, cluster_name, meeting_date, title, priority_level, action AS action_classification, trend_signal,
coalesce(nullif(cluster_name, ''), 'Unknown cluster') || ' item ' || coalesce(nullif(item_label, ''), '?') || ' is a ' || replace(action, '_', ' ') || ' covering ' || coalesce(title, '') || '.' AS summary_plain,
{_WHY_SQL} AS why_it_matters, tags FROM p)"""


def _findings(spark, sf_dir) -> DataFrame:
    return fnd.generate_findings(_tagged(spark, sf_dir), rules.DEMO_HIGH, _DEMO_WHY)


@query(f"WITH {FINDINGS_SQL} SELECT finding_id, agenda_item_id, summary_plain, why_it_matters, array_to_string(tags, ',') AS tags FROM f")
def finding_rows(spark, sf_dir):
    return _findings(spark, sf_dir).select("finding_id", "agenda_item_id", "summary_plain", "why_it_matters", F.array_join("topic_tags", ",").alias("tags"))


@query(f"WITH {FINDINGS_SQL} SELECT action_classification, priority_level, trend_signal, count(*)::BIGINT AS findings FROM f GROUP BY ALL")
def action_priority_trend(spark, sf_dir):
    return _findings(spark, sf_dir).groupBy("action_classification", "priority_level", "trend_signal").agg(F.count(F.lit(1)).alias("findings"))


_FINDING_ORDER = "CASE priority_level WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, meeting_date DESC NULLS LAST, cluster_name NULLS FIRST, title NULLS FIRST, finding_id"


@query(f"WITH {FINDINGS_SQL} SELECT finding_id, priority_level, meeting_date, source_id FROM f WHERE list_contains(tags, 'origin') AND ({FOLDED.format('title')} LIKE '%he%' OR {FOLDED.format('summary_plain')} LIKE '%he%' OR {FOLDED.format('why_it_matters')} LIKE '%he%') ORDER BY {_FINDING_ORDER} LIMIT 50")
def findings_read(spark, sf_dir):
    return fnd.fetch_findings(_findings(spark, sf_dir), fnd.FindingFilters(topic="origin", search="HE")).select("finding_id", "priority_level", "meeting_date", "source_id")


@query(f"""WITH {FINDINGS_SQL} SELECT finding_id, source_id, cluster_name AS body_name, meeting_date, title, summary_plain, priority_level, trend_signal FROM f
ORDER BY CASE priority_level WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, meeting_date DESC NULLS LAST, source_id NULLS FIRST, title NULLS FIRST, finding_id LIMIT 10""")
def top_findings10(spark, sf_dir):
    return fnd.top_findings(_findings(spark, sf_dir))


def _display(c):
    day = F.col("o_orderdate")
    forms = [F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "MMMM d, yyyy"), F.date_format(day, "EEEE, MMMM d, yyyy"), F.date_format(day, "M/d/yyyy")]
    case = F.when(c % 5 == 0, forms[0])
    for i, f in enumerate(forms[1:], 1):
        case = case.when(c % 5 == i, f)
    return case.otherwise("to be announced")


_DISPLAY_SQL = "CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%B %-d, %Y') WHEN 2 THEN strftime(o_orderdate, '%A, %B %-d, %Y') WHEN 3 THEN strftime(o_orderdate, '%-m/%-d/%Y') ELSE 'to be announced' END"
_ISO_SQL = "CASE WHEN o_orderkey % 5 < 4 THEN strftime(o_orderdate, '%Y-%m-%d') END"


@query(f"SELECT o_orderkey, {_DISPLAY_SQL} AS display, {_ISO_SQL} AS iso, CASE WHEN o_orderkey % 5 = 3 THEN strftime(o_orderdate, '%B %-d, %Y') END AS slash FROM orders")
def date_normalise(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", _display(F.col("o_orderkey")).alias("display"))
    return o.select("o_orderkey", "display", exprs.date_iso(F.col("display")).alias("iso"), exprs.slash_date(F.col("display")).alias("slash"))


@query(f"""WITH b AS (SELECT o_orderkey, {_DISPLAY_SQL} AS meeting_date, CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '1999-01-01' END AS old, {_ISO_SQL} AS meeting_date_iso FROM orders)
SELECT o_orderkey, meeting_date_iso, nullif(old, '') IS DISTINCT FROM meeting_date_iso AS changed FROM b""")
def backfill_dates(spark, sf_dir):
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", _display(k).alias("meeting_date"), F.when(k % 3 == 0, "").when(k % 3 == 1, "1999-01-01").alias("meeting_date_iso"))
    return store.backfill_dates(o).select("o_orderkey", "meeting_date_iso", "changed")


_BOARD_URL_SQL = """u AS (SELECT page_id, CASE page_id % 8 WHEN 0 THEN 'https://bos.lacounty.gov/executive-office/live-broadcast/' WHEN 1 THEN 'https://BOS.lacounty.gov/board-meeting-agendas/' WHEN 2 THEN 'https://publiccomment.bos.lacounty.gov/x'
WHEN 3 THEN 'https://ceo.lacounty.gov/x' WHEN 4 THEN 'https://file.lacounty.gov/SDSInter/bos/supdocs/' || page_id || '.PDF?x=1' WHEN 5 THEN 'https://host.example/docs/' || page_id || '.docx' WHEN 6 THEN 'https://host.example/?id=' || page_id || '.xlsx' ELSE url END AS url FROM pages),
p AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM u),
s AS (SELECT *, lower(regexp_extract(path, '[^/.][^/]*?([.][^./]+)$', 1)) AS own, lower(regexp_extract(CASE WHEN regexp_extract(path, '([^/]*)/*$', 1) <> '' THEN regexp_extract(path, '([^/]*)/*$', 1) ELSE regexp_extract(url, '[?&]id=([^&#]*)', 1) END, '[^.].*?([.][^./]+)$', 1)) AS listed FROM p)"""


def _board_urls(spark, sf_dir) -> DataFrame:
    k, out = F.col("page_id"), F.col("url")
    made = ["https://bos.lacounty.gov/executive-office/live-broadcast/", "https://BOS.lacounty.gov/board-meeting-agendas/", "https://publiccomment.bos.lacounty.gov/x", "https://ceo.lacounty.gov/x"]
    numbered = [("https://file.lacounty.gov/SDSInter/bos/supdocs/", ".PDF?x=1"), ("https://host.example/docs/", ".docx"), ("https://host.example/?id=", ".xlsx")]
    for i, u in enumerate([*map(F.lit, made), *(F.concat(F.lit(a), k.cast("string"), F.lit(b)) for a, b in numbered)]):
        out = F.when(k % 8 == i, u).otherwise(out)
    return table(spark, sf_dir, "pages").select("page_id", out.alias("url"))


@query(f"""WITH {_BOARD_URL_SQL} SELECT page_id, host, CASE WHEN ends_with(lower(path), '.pdf') THEN 'direct_pdf' WHEN host = 'bos.lacounty.gov' AND contains(path, 'live-broadcast') THEN 'live_board_page' WHEN host = 'bos.lacounty.gov' AND contains(path, 'board-meeting-agendas') THEN 'board_agenda_page'
WHEN contains(host, 'publiccomment.bos.lacounty.gov') THEN 'public_comment_page' WHEN ends_with(host, 'lacounty.gov') THEN 'lacounty_page' ELSE 'external_page' END AS category FROM p""")
def url_parts_and_category(spark, sf_dir):
    return _board_urls(spark, sf_dir).select("page_id", exprs.url_parts(F.col("url"))["host"].alias("host"), mail.category_of(F.col("url")).alias("category"))


@query(f"""WITH {_BOARD_URL_SQL} SELECT page_id, CASE WHEN listed IN ('.pdf', '.xlsx', '.xls', '.doc', '.docx') THEN listed ELSE '.pdf' END AS listed_suffix,
CASE WHEN own IN ('.pdf', '.html', '.htm', '.txt', '.doc', '.docx', '.xls', '.xlsx', '.ppt', '.pptx', '.csv') THEN own WHEN page_id % 3 = 0 THEN '.pdf' WHEN page_id % 3 = 1 THEN '.html' ELSE '.txt' END AS download_suffix,
CASE WHEN contains(lower(url), '/supdocs/') THEN 'board_supporting_document' WHEN page_id % 5 = 0 THEN 'cluster_agenda_packet' WHEN page_id % 5 = 1 THEN 'agenda_packet' ELSE 'linked_pdf' END AS kind FROM s""")
def file_kinds(spark, sf_dir):
    u, k = F.col("url"), F.col("page_id")
    sent = F.when(k % 3 == 0, "application/pdf").when(k % 3 == 1, "text/html").otherwise("text/plain")
    text = F.when(k % 5 == 0, "Cluster Agenda").when(k % 5 == 1, "The Agenda").otherwise("x")
    return _board_urls(spark, sf_dir).select("page_id", files.listed_suffix(u).alias("listed_suffix"), files.download_suffix(u, sent).alias("download_suffix"), files.document_kind(text, u, F.lit("direct_pdf")).alias("kind"))


@query(r"""WITH d AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%-m/%-d/%Y') WHEN 2 THEN '  to be  <b>announced</b> ' ELSE '' END AS raw, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN iso WHEN o_orderkey % 4 = 2 THEN 'to be announced' END AS lenient, CASE WHEN o_orderkey % 4 < 2 THEN iso || 'T00:00:00' WHEN o_orderkey % 4 = 2 THEN 'to be announced' END AS instant, CASE WHEN o_orderkey % 4 < 2 THEN iso WHEN o_orderkey % 4 = 3 THEN '' END AS listed FROM d""")
def listing_dates(spark, sf_dir):
    day, k = F.col("o_orderdate"), F.col("o_orderkey")
    raw = F.when(k % 4 == 0, F.date_format(day, "yyyy-MM-dd")).when(k % 4 == 1, F.date_format(day, "M/d/yyyy")).when(k % 4 == 2, "  to be  <b>announced</b> ").otherwise("")
    o = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    return o.select("o_orderkey", files.lenient_date(F.col("raw")).alias("lenient"), files.lenient_datetime(F.col("raw")).alias("instant"), files.listing_date(F.when(k % 4 < 2, F.concat("raw", F.lit(", 9 am"))).otherwise(F.col("raw"))).alias("listed"))


@query("SELECT source AS value, count(*)::BIGINT AS rows FROM documents GROUP BY source")
def counts_by_key(spark, sf_dir):
    return itm.count_by(table(spark, sf_dir, "documents"), "source")


_RESULTS_SQL = """r AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.html' ELSE '.bin' END AS suffix, page_id % 2 = 0 AS got_text, CASE page_id % 10 WHEN 0 THEN 'http' WHEN 1 THEN 'url' WHEN 2 THEN 'missing' WHEN 3 THEN 'other' END AS kind, CASE page_id % 4 WHEN 0 THEN 404 WHEN 1 THEN 408 WHEN 2 THEN 429 ELSE 503 END AS code FROM pages),
e AS (SELECT *, CASE kind WHEN 'http' THEN 'http_' || code WHEN 'missing' THEN 'file_not_found' WHEN 'url' THEN 'url_error' WHEN 'other' THEN 'unexpected_fetch_error' END AS error_code, kind IS NOT NULL AND (kind = 'url' OR kind = 'http' AND (code >= 500 OR code IN (408, 429))) AS retryable FROM r),
p AS (SELECT page_id, error_code, CASE WHEN retryable THEN 'needs_retry' WHEN kind IS NOT NULL THEN 'download_failed' WHEN suffix = '.pdf' AND NOT got_text THEN 'downloaded_without_text' WHEN suffix = '.bin' THEN 'downloaded' ELSE 'ready' END AS processing_status,
CASE WHEN kind IS NULL AND suffix = '.pdf' AND NOT got_text THEN 'needs_manual_review' ELSE 'not_needed' END AS review_status FROM e)"""


def _results(spark, sf_dir) -> DataFrame:
    k = F.col("page_id")
    kind = F.when(k % 10 == 0, "http").when(k % 10 == 1, "url").when(k % 10 == 2, "missing").when(k % 10 == 3, "other")
    code = F.when(k % 4 == 0, 404).when(k % 4 == 1, 408).when(k % 4 == 2, 429).otherwise(503)
    suffix = F.when(k % 3 == 0, ".pdf").when(k % 3 == 1, ".html").otherwise(".bin")
    r = table(spark, sf_dir, "pages").select("page_id", kind.alias("kind"), files.processing_status(suffix, F.when(k % 2 == 0, "extracted").otherwise("failed")).alias("done"), files.fetch_error(kind, code).alias("bad"))
    failed = F.col("kind").isNotNull()
    return r.select("page_id", F.when(failed, F.col("bad.code")).alias("error_code"), F.when(failed & F.col("bad.retryable"), "needs_retry").when(failed, "download_failed").otherwise(F.col("done.processing_status")).alias("processing_status"), F.when(failed, "not_needed").otherwise(F.col("done.review_status")).alias("review_status"))


@query(f"WITH {_RESULTS_SQL} SELECT * FROM p")
def processing_states(spark, sf_dir):
    return _results(spark, sf_dir)


@query(f"""WITH {_RESULTS_SQL}, b AS (SELECT CASE WHEN processing_status IN ('ready', 'needs_retry') THEN processing_status WHEN review_status = 'needs_manual_review' THEN review_status WHEN processing_status = 'download_failed' THEN processing_status END AS b FROM p)
SELECT count(*)::BIGINT AS total, count(*) FILTER (b = 'ready')::BIGINT AS ready, count(*) FILTER (b = 'needs_retry')::BIGINT AS needs_retry, count(*) FILTER (b = 'needs_manual_review')::BIGINT AS needs_manual_review, count(*) FILTER (b = 'download_failed')::BIGINT AS download_failed FROM b""")
def result_counts(spark, sf_dir):
    return fetch.status_counts(_results(spark, sf_dir))


@query("""WITH f AS (SELECT 'f' || l_orderkey || '-' || l_linenumber AS finding_id, l_orderkey AS item FROM lineitem), t AS (SELECT DISTINCT finding_id, l_returnflag AS topic_tag FROM f JOIN lineitem ON f.finding_id = 'f' || l_orderkey || '-' || l_linenumber)
SELECT finding_id, topic_tag FROM t WHERE NOT CAST(substr(split_part(finding_id, '-', 1), 2) AS BIGINT) % 3 = 0""")
def findings_cascade(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.concat(F.lit("f"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("finding_id"), F.col("l_returnflag").alias("topic_tag")).distinct()
    gone_items = li.where("l_orderkey % 3 = 0").select("l_orderkey").distinct()
    gone = li.join(gone_items, "l_orderkey", "left_semi").select("finding_id")
    return store.without(li.select("finding_id", "topic_tag"), gone, "finding_id")


@query("""SELECT o_orderkey AS agenda_item_id, CASE WHEN o_orderkey % 2 = 0 THEN 'new' ELSE o_orderstatus END AS topic_tag FROM orders UNION ALL SELECT o_orderkey, 'more' FROM orders WHERE o_orderkey % 2 = 0""")
def topic_replace(spark, sf_dir):
    old = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("agenda_item_id"), F.col("o_orderstatus").alias("topic_tag"))
    batch = old.where("agenda_item_id % 2 = 0").select("agenda_item_id", F.explode(F.array(F.lit("new"), F.lit("more"))).alias("topic_tag"))
    return store.replace_children(old, batch, "agenda_item_id", ["agenda_item_id", "topic_tag"])


@query("""WITH b AS (SELECT 'b' || o_orderkey AS document_id, o_orderstatus AS source_id, 'f' || (o_orderkey % 500) AS file_path FROM orders WHERE o_orderkey % 2 = 0),
k AS (SELECT source_id, file_path, min(document_id) AS known FROM (SELECT 'a' || o_orderkey AS document_id, o_orderstatus AS source_id, 'f' || (o_orderkey % 500) AS file_path FROM orders WHERE o_orderkey % 4 = 0) GROUP BY ALL)
SELECT coalesce(known, document_id) AS document_id, source_id, file_path FROM b LEFT JOIN k USING (source_id, file_path)""")
def known_document_ids(spark, sf_dir):
    rows = lambda start, keep: table(spark, sf_dir, "orders").where(keep).select(F.concat(F.lit(start), F.col("o_orderkey").cast("string")).alias("document_id"), F.col("o_orderstatus").alias("source_id"), F.concat(F.lit("f"), (F.col("o_orderkey") % 500).cast("string")).alias("file_path"))
    return jobs.with_known_ids(rows("a", "o_orderkey % 4 = 0"), rows("b", "o_orderkey % 2 = 0"))


@query(r"""SELECT p_partkey, coalesce(nullif(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'document') AS slug,
coalesce(nullif(trim(regexp_replace(p_name || ' #1', '[^A-Za-z0-9._-]+', '_', 'g'), '._'), ''), 'document') AS filename,
replace(trim(regexp_replace(lower(replace(p_type, '&', 'and')), '[^a-z0-9]+', '-', 'g'), '-'), '-', '_') AS document_type FROM part""")
def slug_and_filename(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", exprs.slugify(F.col("p_name")).alias("slug"), exprs.sanitize_filename(F.concat("p_name", F.lit(" #1"))).alias("filename"), exprs.document_type(F.col("p_type")).alias("document_type"))


@query(r"""WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS href, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) AS label, generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1), 1) - 1 AS pos FROM pages)
SELECT page_id, pos::INT AS pos, href, label FROM a""")
def html_links(spark, sf_dir):
    pattern = F.lit('<a href="([^"]*)">([^<]*)</a>')
    p = table(spark, sf_dir, "pages").select("page_id", F.posexplode(F.arrays_zip(F.regexp_extract_all("html", pattern, 1).alias("href"), F.regexp_extract_all("html", pattern, 2).alias("label"))).alias("pos", "l"))
    return p.select("page_id", "pos", "l.href", "l.label")


@query()
def html_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", exprs.html_to_text(F.col("html")).alias("text"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents),
f AS (SELECT *, sum((length(line) < 12)::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM l)
SELECT doc_id, island::BIGINT AS island, count(*)::BIGINT AS lines, sum(length(line))::BIGINT AS chars FROM f WHERE island > 0 GROUP BY ALL""")
def line_islands(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(exprs.lines_of(F.col("text"))).alias("pos", "line"))
    starts = F.sum((F.char_length("line") < 12).cast("int")).over(Window.partitionBy("doc_id").orderBy("pos"))
    return lines.withColumn("island", starts).where("island > 0").groupBy("doc_id", "island").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.char_length("line")).cast("long").alias("chars"))


@query("SELECT conv_id, count(*)::BIGINT AS item_count, arg_min_null(role, turn) AS role, arg_min_null(text, turn) AS text, arg_max_null(text, turn) AS last_text FROM conversations GROUP BY conv_id")
def message_first_last(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    last = c.groupBy("conv_id").agg(F.max_by("text", "turn").alias("last_text"))
    return ranking.document_summaries(c, "conv_id", "turn", ["role", "text"]).join(last, "conv_id")


@query(r"""SELECT doc_id, CASE WHEN contains(n, 'statement of proceedings') OR regexp_matches(n, '\b(minutes|draft minutes)\b') THEN 'minutes' WHEN regexp_matches(n, '\b(slide deck|presentation)\b') THEN 'presentation'
WHEN regexp_matches(n, '\b(bylaws|charter|membership slate|meeting dates)\b') THEN 'governance_doc' WHEN contains(n, 'board letter') THEN 'board_letter' WHEN contains(n, 'resolution') THEN 'resolution'
WHEN regexp_matches(n, '\b(agreement|amendment)\b') THEN 'agreement' WHEN contains(n, 'motion') THEN 'motion' WHEN regexp_matches(n, '\b(report|spending plan|strategic plan|workplan|work plan|metrics|dashboard)\b') THEN 'report'
WHEN contains(path, 'supporting_docs') OR contains(path, 'supporting-docs') THEN 'supporting_document' ELSE 'attachment' END AS role
FROM (SELECT doc_id, lower(text || CASE doc_id % 12 WHEN 0 THEN ' draft minutes' WHEN 1 THEN ' slide deck' WHEN 2 THEN ' slides' WHEN 3 THEN ' governance' WHEN 4 THEN ' Membership Slate' WHEN 5 THEN ' amendment' WHEN 6 THEN ' Work Plan' WHEN 7 THEN ' Statement of Proceedings' WHEN 8 THEN ' MOTION' ELSE '' END) AS n,
CASE WHEN doc_id % 3 = 0 THEN '/in/x/supporting-docs/' ELSE '/in/' END || doc_id AS path FROM documents)""")
def document_role(spark, sf_dir):
    k, added = F.col("doc_id"), F.lit("")
    for i, words in enumerate((" draft minutes", " slide deck", " slides", " governance", " Membership Slate", " amendment", " Work Plan", " Statement of Proceedings", " MOTION")):
        added = F.when(k % 12 == i, words).otherwise(added)
    path = F.concat(F.when(k % 3 == 0, "/in/x/supporting-docs/").otherwise("/in/"), k.cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", exprs.document_role(F.concat("text", added), path).alias("role"))


_PATHS_SQL = """p AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN '/in/supporting_docs/' WHEN 1 THEN '/in/Canceled-' WHEN 2 THEN '/in/a_HTML-' WHEN 3 THEN '/in/Supporting-Docs/x/Notice-of-Cancellation' WHEN 4 THEN '/cancelled/supporting_docs_old/' ELSE '/in/a_pdf-' END || page_id AS path FROM pages),
n AS (SELECT *, lower(regexp_extract(path, '[^/]*$')) AS name FROM p),
r AS (SELECT *, CASE WHEN contains(name, 'cancelled') OR contains(name, 'canceled') OR contains(name, 'notice-of-cancellation') THEN 'cancellation_notice'
WHEN list_has_any(string_split(lower(path), '/'), ['supporting_docs', 'supporting-docs']) THEN 'supporting_material' WHEN NOT contains(name, '_html-') THEN 'non_canonical_companion' ELSE 'included' END AS reason FROM n)"""


def _paths(spark, sf_dir) -> DataFrame:
    out = F.lit("/in/a_pdf-")
    for i, start in enumerate(("/in/supporting_docs/", "/in/Canceled-", "/in/a_HTML-", "/in/Supporting-Docs/x/Notice-of-Cancellation", "/cancelled/supporting_docs_old/")):
        out = F.when(F.col("page_id") % 6 == i, start).otherwise(out)
    return table(spark, sf_dir, "pages").select("page_id", F.concat(out, F.col("page_id").cast("string")).alias("path"))


@query(f"WITH {_PATHS_SQL} SELECT reason, count(*)::BIGINT AS paths FROM r WHERE reason <> 'included' GROUP BY reason")
def screening_breakdown(spark, sf_dir):
    return screening.screening_breakdown(_paths(spark, sf_dir), parser=rules.PAGE_PARSER)


@query(f"WITH {_PATHS_SQL} SELECT page_id, reason FROM r")
def screening_reasons(spark, sf_dir):
    return screening.screened(_paths(spark, sf_dir), parser=rules.PAGE_PARSER).select("page_id", "reason")


@query(f"WITH {_PATHS_SQL} SELECT page_id FROM r WHERE list_has_any(string_split(lower(path), '/'), ['supporting_docs', 'supporting-docs']) AND reason <> 'cancellation_notice'")
def supporting_files(spark, sf_dir):
    return screening.supporting_files(_paths(spark, sf_dir)).select("page_id")


@query("""SELECT e.event_id, e.event_type FROM events e LEFT JOIN (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN value + 1 ELSE value END AS v FROM events WHERE event_id % 3 <> 0) s USING (event_id)
WHERE s.event_id IS NULL OR s.v IS DISTINCT FROM e.value""")
def changed_since_state(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    state = e.where("event_id % 3 <> 0").select("event_id", F.when(F.col("event_id") % 7 == 0, F.col("value") + 1).otherwise(F.col("value")).alias("value"))
    return screening.changed_files(e, state, "event_id", ("value",)).select("event_id", "event_type")


@query("""WITH RECURSIVE k AS (SELECT event_type, min(ts) AS ts FROM events WHERE ts IS NOT NULL GROUP BY event_type
UNION ALL SELECT k.event_type, min(e.ts) FROM k JOIN events e ON e.event_type = k.event_type AND e.ts >= k.ts + INTERVAL 6 DAYS GROUP BY k.event_type)
SELECT event_type, ts FROM k""")
def snapshot_thinning(spark, sf_dir):
    return ranking.thin_snapshots(table(spark, sf_dir, "events").select("event_type", "ts"), "event_type", "ts")


@query("""SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders""")
def upsert_merge(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    base, even = o.where("o_orderkey % 4 <> 2"), o.where("o_orderkey % 2 = 0")
    batch = even.withColumn("pos", F.lit(1)).unionByName(even.withColumns({"pos": F.lit(2), "o_totalprice": F.col("o_totalprice") + 1}))
    return store.upsert(base, store.last_per_key(batch, ["o_orderkey"], "pos"), ["o_orderkey"])


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 4 = 2 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice FROM orders""")
def meeting_partial_upsert(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    batch = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus"), (-F.col("o_totalprice")).alias("o_totalprice"))
    return store.upsert(o.where("o_orderkey % 4 <> 2"), batch, ["o_orderkey"], update=["o_totalprice"])


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_orderkey % 3 = 0 AND l_linenumber % 2 = 0)")
def stale_children_delete(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    batch = li.where("l_orderkey % 3 = 0 AND l_linenumber % 2 <> 0")
    only_even = li.where("l_orderkey % 3 = 0 AND l_linenumber % 2 = 0").select("l_orderkey", F.lit(-1).alias("l_linenumber"))
    gone = store.stale_children(li, batch.unionByName(only_even), "l_orderkey", "l_linenumber")
    return store.without(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), gone, ["l_orderkey", "l_linenumber"])


_HEALTH_SQL = """h AS (SELECT n_nationkey, n_name, coalesce(c, 0)::BIGINT AS customers, coalesce(s, 0)::BIGINT AS suppliers, coalesce(o, 0)::BIGINT AS orders, latest FROM nation
LEFT JOIN (SELECT c_nationkey, count(*) AS c FROM customer GROUP BY 1) ON n_nationkey = c_nationkey LEFT JOIN (SELECT s_nationkey, count(*) AS s FROM supplier GROUP BY 1) ON n_nationkey = s_nationkey
LEFT JOIN (SELECT c_nationkey AS k, count(*) AS o, max(strftime(o_orderdate, '%Y-%m-%d')) AS latest FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) ON n_nationkey = k)"""


def _health(spark, sf_dir) -> DataFrame:
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    ordered = table(spark, sf_dir, "orders").select("o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("iso"), F.lit("").alias("display")).join(customers.select(F.col("c_custkey").alias("o_custkey"), "n_nationkey"), "o_custkey")
    rollups = [
        health.per_source(customers, "n_nationkey", customers=F.count(F.lit(1))),
        health.per_source(table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "n_nationkey"), "n_nationkey", suppliers=F.count(F.lit(1))),
        health.per_source(ordered, "n_nationkey", orders=F.count(F.lit(1)), latest=health.latest_date("iso", "display")),
    ]
    return health.source_health(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "n_nationkey", rollups, ["customers", "suppliers", "orders"])


@query(f"WITH {_HEALTH_SQL} SELECT * FROM h")
def source_health(spark, sf_dir):
    return _health(spark, sf_dir)


@query(f"WITH {_HEALTH_SQL} SELECT count(*)::BIGINT AS sources, sum(customers)::BIGINT AS total_customers, sum(orders)::BIGINT AS total_orders, count(CASE WHEN suppliers > 0 THEN 1 END)::BIGINT AS active, count(CASE WHEN latest IS NULL THEN 1 END)::BIGINT AS silent FROM h")
def dashboard_totals(spark, sf_dir):
    return health.totals(_health(spark, sf_dir), ["customers", "orders"], {"active": F.col("suppliers") > 0, "silent": F.col("latest").isNull()})


@query("""SELECT document_id, meeting_date_iso, source_id FROM (SELECT o_orderkey AS document_id, CASE WHEN o_orderkey % 10 = 0 THEN ' ' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS meeting_date_iso, o_orderstatus AS source_id, o_orderpriority AS cluster_name, '' AS meeting_date FROM orders)
ORDER BY CASE WHEN trim(meeting_date_iso) <> '' THEN 0 ELSE 1 END, meeting_date_iso DESC NULLS LAST, meeting_date DESC NULLS LAST, source_id NULLS FIRST, cluster_name NULLS FIRST, document_id LIMIT 10""")
def recent_top10(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("document_id"), F.when(F.col("o_orderkey") % 10 == 0, " ").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("meeting_date_iso"), F.lit("").alias("meeting_date"), F.col("o_orderstatus").alias("source_id"), F.col("o_orderpriority").alias("cluster_name"))
    return health.recent_agendas(o).select("document_id", "meeting_date_iso", "source_id")


@query("""SELECT 'unknown reference' AS problem, c_custkey::VARCHAR AS subject FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey < 20)
UNION ALL SELECT 'repeated name', c_mktsegment FROM customer GROUP BY c_mktsegment HAVING count(*) > 1""")
def registry_validation(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation").where("n_nationkey < 20")
    return registry_log.unknown_references(c, "c_nationkey", "c_custkey", n, "n_nationkey").unionByName(registry_log.repeated(c, "c_mktsegment"))


@query("SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS n FROM documents) WHERE n <= 3")
def first_n_per_scope(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return ranking.first_n_per_scope(d, "source", [F.desc("n_chars"), F.col("doc_id")], 3).select("doc_id", "source")


@query(r"""WITH p AS (SELECT lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) AS host, url, lower(url) AS low, regexp_extract(lower(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1)), '([.][a-z0-9]+)$', 1) AS suffix FROM pages),
r AS (SELECT *, CASE WHEN contains(low, '/supdocs/') THEN 0 WHEN suffix = '.pdf' THEN 1 WHEN suffix IN ('.doc', '.docx', '.xls', '.xlsx', '.ppt', '.pptx', '.csv') THEN 2
WHEN contains(low, 'download') OR contains(low, 'attachment') OR contains(low, 'support') OR contains(low, 'supdoc') OR contains(low, 'boardletter') THEN 10 WHEN suffix IN ('.html', '.htm', '') THEN 20 ELSE 30 END AS rank FROM p)
SELECT host, lower(arg_min(url, {'rank': rank, 'low': low})) AS url FROM r GROUP BY host""")
def best_link(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select(exprs.url_parts(F.col("url"))["host"].alias("host"), "url")
    return links.best_child(p, "host").select("host", F.lower("url").alias("url"))


_RECORDS_SQL = """SELECT 'n' || n_nationkey AS source_id, n_name AS source_name, CASE WHEN n_nationkey % 3 = 0 THEN 'paused' ELSE 'active' END AS status, 'high' AS priority_level, NULL::VARCHAR AS download_root, NULL::VARCHAR AS structured_output_dir,
coalesce(r.n, 0)::BIGINT AS raw_documents, coalesce(d.n, 0)::BIGINT AS structured_documents, coalesce(i.n, 0)::BIGINT AS structured_items, coalesce(f.n, 0)::BIGINT AS findings, coalesce(f.high, 0)::BIGINT AS high_priority_findings,
r.latest AS latest_document_date, coalesce(d.iso, d.display) AS latest_structured_date, s.latest AS latest_refresh_recorded_at, coalesce(q.retry, 0)::BIGINT AS retry_queue_items, coalesce(q.review, 0)::BIGINT AS manual_review_items, n_nationkey = 7 AS has_parser_config_warning
FROM nation LEFT JOIN (SELECT s_nationkey AS k, count(*) AS n, max(CASE WHEN s_suppkey % 4 > 0 THEN s_name END) AS latest FROM supplier GROUP BY 1) r ON r.k = n_nationkey
LEFT JOIN (SELECT c_nationkey AS k, count(*) AS n, max(CASE WHEN c_nationkey % 2 = 0 AND c_custkey % 2 = 0 THEN c_name END) AS iso, max(c_mktsegment) AS display FROM customer WHERE c_custkey % 5 > 0 GROUP BY 1) d ON d.k = n_nationkey
LEFT JOIN (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_nationkey > 2 GROUP BY 1) i ON i.k = n_nationkey
LEFT JOIN (SELECT c_nationkey AS k, count(*) AS n, count(*) FILTER (c_mktsegment = 'BUILDING') AS high FROM customer GROUP BY 1) f ON f.k = n_nationkey
LEFT JOIN (SELECT c_nationkey AS k, max(c_name) AS latest FROM customer GROUP BY 1) s ON s.k = n_nationkey
LEFT JOIN (SELECT s_nationkey AS k, sum(2) FILTER (s_suppkey % 3 = 0) AS retry, sum(1) FILTER (s_suppkey % 3 = 1) AS review FROM supplier GROUP BY 1) q ON q.k = n_nationkey"""


def _records(spark, sf_dir) -> DataFrame:
    of = lambda c: F.concat(F.lit("n"), F.col(c).cast("string")).alias("source_id")
    k, none = F.col("n_nationkey"), F.lit(None).cast("string")
    sources = table(spark, sf_dir, "nation").select(of("n_nationkey"), F.col("n_name").alias("source_name"), F.when(k % 3 == 0, "paused").otherwise("active").alias("status"), F.lit("high").alias("priority_level"), none.alias("download_root"), none.alias("structured_output_dir"), F.when(k == 7, rules.NON_ITEM_PARSERS[0]).alias("parser"))
    s, c = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    raw = s.select(of("s_nationkey"), F.when(F.col("s_suppkey") % 4 > 0, F.col("s_name")).otherwise("  ").alias("meeting_date"))
    documents = c.where("c_custkey % 5 > 0").select(of("c_nationkey"), F.when((F.col("c_nationkey") % 2 == 0) & (F.col("c_custkey") % 2 == 0), F.col("c_name")).otherwise("").alias("meeting_date_iso"), F.col("c_mktsegment").alias("meeting_date"))
    found = c.select(of("c_nationkey"), F.when(F.col("c_mktsegment") == "BUILDING", "high").otherwise("low").alias("priority_level"))
    queues = s.select(of("s_nationkey"), F.when(F.col("s_suppkey") % 3 == 0, "/q/retry_queue.json").when(F.col("s_suppkey") % 3 == 1, "/q/manual_review_queue.json").otherwise("/q/other.json").alias("path"), F.when(F.col("s_suppkey") % 3 == 0, "[1, {}]").otherwise("[[]]").alias("value"))
    return health.health_records(sources, raw, documents, c.where("c_nationkey > 2").select(of("c_nationkey")), found, c.select(of("c_nationkey"), F.col("c_name").alias("recorded_at")), health.queue_lengths(queues))


@query(_RECORDS_SQL)
def health_records(spark, sf_dir):
    return _records(spark, sf_dir)


@query(f"""SELECT count(*)::BIGINT AS source_count, count(*) FILTER (status = 'active')::BIGINT AS active_source_count, {', '.join(f'sum({c})::BIGINT AS {c}' for c in health.HEALTH_COUNTS)}, count(*) FILTER (has_parser_config_warning)::BIGINT AS sources_with_parser_config_warnings FROM ({_RECORDS_SQL})""")
def health_totals(spark, sf_dir):
    return health.health_totals(_records(spark, sf_dir))


HREF = r'(?i)<a[^>]+href="([^"]+)"'
_PAGE_WEB = f"""p AS (SELECT page_id, list_distinct(regexp_extract_all(html, '{HREF}', 1)) AS found, regexp_extract_all(html, '{HREF}', 1) AS children FROM pages),
web AS (SELECT children[-1] AS url, arg_min(children, page_id) AS children, min(page_id) AS page_id FROM p WHERE len(children) > 0 GROUP BY children[-1]),
starts AS (SELECT DISTINCT unnest(found) AS url FROM p)"""
_RANKED = "list_sort(list_transform(list_filter({children}, lambda x: NOT list_contains({path}, x)), lambda x, i: {{'rank': CASE WHEN contains(lower(x), '/supdocs/') THEN 0 WHEN regexp_matches(lower(x), 'download|attachment|support|supdoc|boardletter') THEN 10 ELSE 20 END, 'low': lower(x), 'i': i, 'x': x}}))[1].x"


@query(f"""WITH RECURSIVE {_PAGE_WEB},
chain(start, here, path, hops) AS (
  SELECT url, url, [url], 0 FROM starts
  UNION ALL
  SELECT c.start, {_RANKED.format(children='w.children', path='c.path')}, list_append(c.path, {_RANKED.format(children='w.children', path='c.path')}), c.hops + 1
  FROM chain c JOIN web w ON w.url = c.here WHERE c.hops < 2 AND w.page_id % 4 <> 0 AND len(list_filter(w.children, lambda x: NOT list_contains(c.path, x))) > 0),
ends AS (SELECT start, max(hops) AS hops, arg_max(here, hops) AS here FROM chain GROUP BY start)
SELECT e.start, e.hops::INT AS hops, e.here AS final_url, w.page_id AS page_id,
  CASE WHEN w.url IS NULL THEN 'download_error' WHEN e.hops > 0 THEN 'followed_landing_page' WHEN w.page_id % 4 <> 0 THEN 'html_page_needs_review' ELSE 'direct_download' END AS outcome
FROM ends e LEFT JOIN web w ON w.url = e.here""")
def link_frontier(spark, sf_dir):
    """Links of all pages followed two levels deep. A page stands at the address that its last link names; of four pages one is a document."""
    found = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract_all("html", F.lit(HREF), 1).alias("children")).where("size(children) > 0")
    web = found.groupBy(F.element_at("children", -1).alias("url")).agg(F.min_by("children", "page_id").alias("children"), F.min("page_id").alias("page_id"))
    pages = web.select("url", F.col("url").alias("final_url"), (F.col("page_id") % 4 != 0).alias("is_page"), "children", F.col("page_id").cast("string").alias("sha256"), F.lit("text/html").alias("content_type"), F.lit(0).cast("long").alias("bytes_downloaded"))

    def look(addresses: DataFrame) -> DataFrame:
        got = addresses.join(pages, "url", "left")
        return got.withColumns({"error": F.when(F.col("final_url").isNull(), "no page"), "final_url": F.coalesce("final_url", "url"), "is_page": F.coalesce("is_page", F.lit(False))})

    ended = frontier.follow(found.select(F.explode("children").alias("url")), look, follows=lambda u: F.lit(True))
    return ended.select("start", "hops", "final_url", F.col("sha256").cast("long").alias("page_id"), "outcome")


@query("""WITH h AS (SELECT l_partkey AS path, min(l_linenumber)::VARCHAR AS held FROM lineitem GROUP BY 1), s AS (SELECT c_custkey AS path, min(c_nationkey)::VARCHAR AS said FROM customer GROUP BY 1)
SELECT coalesce(s.path, h.path) AS path, CASE WHEN h.path IS NULL THEN 'missing' WHEN s.path IS NULL THEN 'orphaned' WHEN said <> held THEN 'changed' ELSE 'matched' END AS state, said, held FROM s FULL JOIN h ON s.path = h.path""")
def manifest_reconcile(spark, sf_dir):
    """Customers as a manifest's entries, line items as the files of a folder."""
    said = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("path"), F.col("c_nationkey").cast("string").alias("mark"))
    held = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("path"), F.col("l_linenumber").cast("string").alias("mark"))
    return manifests.reconcile(said, held, "path", "mark")


COUNTED = ("documents", "pages", "conversations", "labels", "events", "orders", "lineitem", "customer")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*)::BIGINT AS table_rows FROM {t}" for t in COUNTED))
def table_counts(spark, sf_dir):
    return manifests.table_counts({t: table(spark, sf_dir, t) for t in COUNTED})


_HOST_SQL = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"


@query(f"""SELECT url, host, nth::BIGINT AS nth FROM (SELECT url, {_HOST_SQL} AS host, row_number() OVER (PARTITION BY {_HOST_SQL} ORDER BY page_id % 3, page_id::VARCHAR, url) AS nth FROM pages) WHERE nth <= 2""")
def host_wave(spark, sf_dir):
    """The first wave of a ledger that holds all pages: two addresses a host, those with the fewest tries first."""
    rows = table(spark, sf_dir, "pages").select("url", downloads.host_of(F.col("url")).alias("host"), (F.col("page_id") % 3).alias("tries"), F.col("page_id").cast("string").alias("window_from"), F.lit("s").alias("source_id"))
    taken = ledger.wave(rows, 2)
    order = Window.partitionBy("host").orderBy("tries", "window_from", "url")
    return taken.select("url", "host", F.row_number().over(order).cast("long").alias("nth"))


@query("""SELECT user_id::VARCHAR AS source_id, event_type AS url, arg_max(ts, event_id) AS at, arg_max(value, event_id) AS value, max(event_id) AS seq FROM events GROUP BY ALL""")
def ledger_states(spark, sf_dir):
    """The last event of each user and type, as a ledger's states."""
    e = table(spark, sf_dir, "events")
    return ledger.states(e.select(F.col("user_id").cast("string").alias("source_id"), F.col("event_type").alias("url"), F.col("ts").alias("at"), "value", F.col("event_id").alias("seq")))


@query("""WITH base AS (SELECT c_custkey AS source_id, c_mktsegment AS status, c_nationkey::VARCHAR AS notes, 'first' AS created_at, 'first' AS updated_at FROM customer),
batch AS (SELECT s_suppkey AS source_id, n_name AS status, s_nationkey::VARCHAR AS notes FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION ALL SELECT c_custkey, c_mktsegment, c_nationkey::VARCHAR FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier) UNION ALL SELECT -n_nationkey - 1, n_name, NULL FROM nation)
SELECT coalesce(a.source_id, b.source_id) AS source_id, CASE WHEN b.source_id IS NULL THEN a.status ELSE b.status END AS status, CASE WHEN b.source_id IS NULL THEN a.notes ELSE b.notes END AS notes, coalesce(a.created_at, 'second') AS created_at,
CASE WHEN b.source_id IS NULL THEN a.updated_at WHEN a.source_id IS NOT NULL AND a.status IS NOT DISTINCT FROM b.status AND a.notes IS NOT DISTINCT FROM b.notes THEN a.updated_at ELSE 'second' END AS updated_at
FROM base a FULL JOIN batch b ON a.source_id = b.source_id""")
def sources_stamped(spark, sf_dir):
    """Customers as stored sources; a batch of all of them, some as suppliers say they are, and new ones."""
    c, s, n = (table(spark, sf_dir, t) for t in ("customer", "supplier", "nation"))
    base = c.select(F.col("c_custkey").alias("source_id"), F.col("c_mktsegment").alias("status"), F.col("c_nationkey").cast("string").alias("notes"), F.lit("first").alias("created_at"), F.lit("first").alias("updated_at"))
    told = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(F.col("s_suppkey").alias("source_id"), F.col("n_name").alias("status"), F.col("s_nationkey").cast("string").alias("notes"))
    same = base.join(told, "source_id", "left_anti").select("source_id", "status", "notes")
    new = n.select((-F.col("n_nationkey") - 1).cast("long").alias("source_id"), F.col("n_name").alias("status"), F.lit(None).cast("string").alias("notes"))
    return store.upsert_stamped(base, told.unionByName(same).unionByName(new), ["source_id"], F.lit("second"))


@query(r"""WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?i)<(?:a|iframe|embed)[^>]+(?:href|src)=["'']([^"'']+)["'']', 1)) AS href, generate_subscripts(regexp_extract_all(html, '(?i)<(?:a|iframe|embed)[^>]+(?:href|src)=["'']([^"'']+)["'']', 1), 1) AS pos FROM pages),
j AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') || href AS link, min(pos) AS pos FROM a GROUP BY ALL)
SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1)::INT AS pos, link FROM j""")
def landing_page_links(spark, sf_dir):
    """Absolute links of pages as the frontier reads them (all links of these pages start at their site's root)."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.posexplode(frontier.page_links(F.col("html").cast("binary"), F.col("url"))))
    return pages.select("page_id", "pos", F.col("col").alias("link"))
