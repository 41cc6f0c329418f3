"""Scalar functions as plain Column expressions. All stay in the JVM but for character references and title case."""

from __future__ import annotations

import html
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from meetloom.functions import rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def is_non_blank(c: Column) -> Column:
    """Not null and more than U+0020 spaces."""
    return c.isNotNull() & (F.trim(c) != "")


def or_label(c: Column, label: str) -> Column:
    """The label for null and for ''."""
    return F.coalesce(blank_to_null(c), F.lit(label))


def clean_text(c: Column) -> Column:
    """Unicode white space collapsed to one space and cut from both ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def contains_like(c: Column, needle: str) -> Column:
    """LIKE %needle% with A-Z folded only, % and _ live, and no escape character."""
    folded = needle.translate(str.maketrans(UPPER, LOWER)).replace("\\", "\\\\")
    return ascii_lower(c).like(f"%{folded}%")


def stable_id(prefix: str, *parts: Column) -> Column:
    """prefix and the first 16 hex digits of SHA-1 over the parts joined by '|'. Null parts count as ''."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha1(text.cast("binary")), 1, 16))


def slugify(c: Column, default: str = "document") -> Column:
    """Lower case, letters and digits kept, all else one '-', none at the ends."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "-"), "^-|-$", "")
    return F.coalesce(blank_to_null(slug), F.lit(default))


def sanitize_filename(c: Column, default: str = "document") -> Column:
    safe = F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9._-]+", "_"), r"^[._]+|[._]+$", "")
    return F.coalesce(blank_to_null(safe), F.lit(default))


def document_type(c: Column) -> Column:
    return F.translate(slugify(F.replace(c, F.lit("&"), F.lit("and"))), "-", "_")


def date_iso(c: Column) -> Column:
    """Display dates of four forms to yyyy-MM-dd; null if none fits. A leading weekday is accepted unchecked. A cheap look at the text picks the one form to parse."""
    squeezed = F.trim(F.regexp_replace(c, r"\s+", " "))
    bare = F.regexp_replace(squeezed, f"(?i)^(?:{'|'.join(rules.WEEKDAYS)}), (?=[A-Za-z])", "")
    parsed = F.when(squeezed.contains("/"), F.try_to_date(squeezed, "M/d/yyyy")).when(squeezed.contains(","), F.try_to_date(bare, "MMMM d, yyyy")).when(squeezed.contains("-"), F.try_to_date(squeezed, "yyyy-M-d"))
    return F.date_format(parsed, "yyyy-MM-dd")


def slash_date(c: Column) -> Column:
    """The first m/d/yyyy in a text as 'Month d, yyyy'; null if there is none or the month is none."""
    part = [F.regexp_extract(c, r"(\d{1,2})/(\d{1,2})/(\d{4})", i) for i in (1, 2, 3)]
    month = F.get(F.array(*map(F.lit, rules.MONTHS)), part[0].try_cast("int") - 1)
    return F.concat(month, F.lit(" "), part[1].try_cast("int").cast("string"), F.lit(", "), part[2])


def url_parts(url: Column) -> dict[str, Column]:
    """host, path and suffix of an http(s) url; '' where absent."""
    host = ascii_lower(F.regexp_extract(url, r"^https?://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^https?://[^/?#]*([^?#]*)", 1)
    return {"host": host, "path": path, "suffix": F.regexp_extract(path, r"(\.[A-Za-z0-9]+)$", 1)}


def url_basename(url: Column) -> Column:
    return F.regexp_extract(url_parts(url)["path"], "([^/]*)/?$", 1)


def lines_of(c: Column) -> Column:
    return F.split(c, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]")


def unescaped(c: Column) -> Column:
    """Character references of the whole HTML5 table decoded. Only texts with an ampersand go through Python."""

    @F.arrow_udf("string")
    def decode(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else html.unescape(t) for t in texts.to_pylist()], pa.string())

    return F.coalesce(decode(F.when(c.contains("&"), c)), c)


def html_to_text(c: Column) -> Column:
    """Line breaks for <br> and closing block tags, other tags a space, character references decoded, blank lines dropped."""
    t = F.regexp_replace(c, r"(?i)<br\s*/?>|</(?:p|div|tr|li|table|tbody|td|h\d|u|strong|span)>", "\n")
    t = unescaped(F.regexp_replace(t, "<[^>]+>", " "))
    return F.array_join(F.filter(F.transform(F.split(t, "\n"), clean_text), lambda x: x != ""), "\n")


def plain(fragment: Column) -> Column:
    """Tags and character references out of a fragment, white space squeezed."""
    return clean_text(unescaped(F.regexp_replace(fragment, "<[^>]+>", " ")))


def title_case(c: Column) -> Column:
    """A capital after every character that is no letter, as in "Children'S"."""

    @F.arrow_udf("string")
    def title(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else t.title() for t in texts.to_pylist()], pa.string())

    return title(c)


def topic_tags(text: Column, topic_rules: Mapping[str, Sequence[str]] = rules.TOPIC_RULES) -> Column:
    """Sorted distinct tags of which any keyword is a substring of the lowered text: one pass, no join."""
    lowered = F.lower(text)
    hits = []
    for tag in sorted(topic_rules):
        found = F.lit(False)
        for word in topic_rules[tag]:
            found = found | lowered.contains(word)
        hits.append(F.when(found, F.lit(tag)))
    return F.array_compact(F.array(*hits))


def lowered(title: Column, text: Column) -> Column:
    """What the classifiers look at; compute it once as a column of its own."""
    return F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(text, F.lit(""))))


def action_class(low: Column, section: Column) -> Column:
    """The first rule whose word occurs; presentations are discussed, the rest informs."""
    fits = [F.when(low.contains(word), name) for word, name in rules.ACTION_RULES]
    return F.coalesce(*fits, F.when(F.lower(section).contains("presentation"), "discussion_item"), F.lit("informational_item"))


def priority(low: Column, tags: Column, action: Column, high: Sequence[str] = rules.HIGH_PRIORITY_TOPICS, keywords: Sequence[str] = rules.HIGH_PRIORITY_KEYWORDS) -> Column:
    score = 2 * F.size(F.array_intersect(tags, F.array(*map(F.lit, high)))) + action.isin(rules.CONTRACT_ACTIONS).cast("int")
    for word in keywords:
        score = score + low.contains(word).cast("int")
    return F.when(score >= 5, "high").when(score >= 2, "medium").otherwise("low")


def trend_signal(low: Column, tags: Column, action: Column, high: Sequence[str] = rules.HIGH_PRIORITY_TOPICS, keywords: Sequence[str] = rules.TREND_KEYWORDS) -> Column:
    pattern = F.lit(False)
    for word in keywords:
        pattern = pattern | low.contains(word)
    return F.when(pattern, "recurring_vendor_or_contract_pattern").when(F.arrays_overlap(tags, F.array(*map(F.lit, high))), "policy_watch").when(action.isin(rules.DECISION_ACTIONS), "board_decision").otherwise("routine_monitoring")


def summary_plain(cluster: Column, label: Column, action: Column, title: Column) -> Column:
    return F.concat(or_label(cluster, "Unknown cluster"), F.lit(" item "), or_label(label, "?"), F.lit(" is a "), F.translate(action, "_", " "), F.lit(" covering "), F.coalesce(title, F.lit("")), F.lit("."))


def why_it_matters(tags: Column, level: Column, explanations: Mapping[str, str] = rules.TOPIC_EXPLANATIONS) -> Column:
    """The first two explanations in the tags' order, a default without any, and a sentence for the priority."""
    of = F.create_map(*[F.lit(x) for kv in explanations.items() for x in kv])
    told = F.slice(F.filter(F.transform(tags, lambda t: F.element_at(of, t)), lambda e: e.isNotNull()), 1, 2)
    base = F.when(F.size(told) > 0, F.concat(F.lit("This matters because "), F.array_join(told, " and "), F.lit("."))).otherwise(rules.NO_EXPLANATION)
    ends = F.create_map(*[F.lit(x) for kv in rules.PRIORITY_SENTENCES.items() for x in kv])
    return F.concat(base, F.element_at(ends, level))


def document_role(text: Column, path: Column | None = None) -> Column:
    """Role of a supporting document by its text, first rule that fits, else by its path."""
    low = F.lower(text)
    fits = [F.when(low.rlike(pattern), role) for pattern, role in rules.DOCUMENT_ROLES]
    if path is not None:
        there = F.lit(False)
        for part in rules.SUPPORTING_PARTS:
            there = there | F.lower(path).contains(part)
        fits.append(F.when(there, rules.ROLE_OF_PATH))
    return F.coalesce(*fits, F.lit(rules.ROLE_OF_REST))


def is_cancellation(path: Column) -> Column:
    name, out = F.lower(F.regexp_extract(path, "([^/]*)$", 1)), F.lit(False)
    for token in rules.CANCELLATION_TOKENS:
        out = out | name.contains(token)
    return out


def is_supporting(path: Column) -> Column:
    """A whole part of the path says so, not a substring."""
    return F.arrays_overlap(F.split(F.lower(path), "/"), F.array(*map(F.lit, rules.SUPPORTING_PARTS)))


def screening(path: Column, parser: Column | None = None) -> Column:
    """Why a path is screened out, in order of precedence, or 'included'. Of pages that exist in several renditions, the page parser takes one."""
    page = F.lower(F.regexp_extract(path, "([^/]*)$", 1)).contains(rules.PAGE_NAME_TOKEN)
    companion = F.coalesce(parser == rules.PAGE_PARSER, F.lit(False)) & ~page if parser is not None else F.lit(False)
    return F.when(is_cancellation(path), "cancellation_notice").when(is_supporting(path), "supporting_material").when(companion, "non_canonical_companion").otherwise("included")
