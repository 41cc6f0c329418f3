"""URL filtering by pattern rules that are indexed by their rarest literal token.

A rule holds a regular expression and the literal tokens that every url it fits must
hold whole. One grouped count over the urls tells how rare each rule token is; a rule is
filed under its rarest. A url's own tokens then fetch its candidate rules, and only those
run as regular expressions. The longest fitting rule of the first class that fits wins.

DataFrame functions only. Up to IN_ROW_RULES rules travel as one literal map, so a row
meets its candidates without a join or shuffle, however hot its host. Larger rule sets
are a table joined on the token; as a verdict depends on the url alone, that path works on
distinct urls and a hot url costs one row.

Null urls and urls without '://' have an empty host and path, fit no rule and are allowed.
Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetloom.llm.common import ascii_lower

IN_ROW_RULES = 2_000


@dataclass(frozen=True)
class UrlRule:
    """rank: classes of rules, the highest that fits decides; within one the longest text wins, then the first text in order."""

    text: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    rank: int = 0
    named: bool = True
    length: int = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "length", len(self.text))


def host_rule(host: str, path: str, verdict: str, rank: int = 1) -> UrlRule:
    """Fits the host and its subdomains where the url's path starts with path."""
    text = host + path
    # A run of letters and digits is a whole token of every fitting url if the rule's text goes on behind it.
    whole = re.findall(r"[A-Za-z0-9]+(?=[^A-Za-z0-9])", text)
    return UrlRule(text, verdict, rf"(?s)^(?:[^/]*\.)?{_quoted(text)}", tuple(whole), rank)


def pattern_rule(pattern: str, verdict: str = "block", rank: int = 0) -> UrlRule:
    """A host and path with * for any run of characters, found at the start of a host label."""
    parts = pattern.split("*")
    whole = [t for p in parts for t in re.findall(r"(?<=[^A-Za-z0-9])[A-Za-z0-9]+(?=[^A-Za-z0-9])", p)]
    whole += re.findall(r"^[A-Za-z0-9]+(?=[^A-Za-z0-9])", parts[0])
    return UrlRule(pattern, verdict, r"(?s)^(?:[^/]*\.)?" + ".*".join(map(_quoted, parts)), tuple(whole), rank, named=False)


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9])", r"\\\1", text)


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(target: Column) -> Column:
    return F.array_distinct(F.split(target, "[^A-Za-z0-9]+"))


def rarest_tokens(urls: DataFrame, rules: Sequence[UrlRule]) -> dict[UrlRule, str | None]:
    """Each rule's token that the fewest urls hold (one count per rule token comes to the driver); None if it has no whole token."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return dict.fromkeys(rules)
    held = urls.select(F.explode(F.array_intersect(_tokens(F.col("target")), F.array(*map(F.lit, wanted)))).alias("t")).groupBy("t").count()
    count = {r["t"]: r["count"] for r in held.collect()}
    return {r: min(r.tokens, key=lambda t: (count.get(t, 0), t), default=None) for r in rules}


def judge_urls(pages: DataFrame, rules: Sequence[UrlRule], id_col: str = "page_id", url_col: str = "url", default: str = "allow", in_row_rules: int = IN_ROW_RULES) -> DataFrame:
    """page_id, host, path, rule (text of a deciding named rule, else null), verdict: one row per row of pages."""
    rules = list(dict.fromkeys(rules))
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url")).select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")).withColumn("target", F.concat("host", "path"))
    if not rules:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    filed = rarest_tokens(rows, rules)
    best = _judged_in_row(rows, filed) if len(rules) <= in_row_rules else _judged_by_join(rows, filed)
    hit = F.col("hit")
    return best.select("page_id", "host", "path", F.when(hit["named"], hit["text"]).alias("rule"), F.coalesce(hit["verdict"], F.lit(default)).alias("verdict"))


def _as_struct(r: UrlRule) -> Column:
    return F.struct(F.lit(r.rank).alias("rank"), F.lit(r.length).alias("length"), F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"), F.lit(r.named).alias("named"), F.lit(r.regex).alias("regex"))


def _judged_in_row(rows: DataFrame, filed: dict[UrlRule, str | None]) -> DataFrame:
    by_token: dict[str, list[UrlRule]] = {}
    for r, t in filed.items():
        by_token.setdefault(t or "", []).append(r)  # '' files the rules without a token; every url has it
    index = F.create_map(*[x for t, rs in sorted(by_token.items()) for x in (F.lit(t), F.array(*map(_as_struct, rs)))])
    keys = F.array_intersect(F.array_union(_tokens(F.col("target")), F.array(F.lit(""))), F.array(*map(F.lit, sorted(by_token))))
    fetched = F.flatten(F.transform(keys, lambda t: F.element_at(index, t)))
    return rows.withColumn("hit", F.array_max(F.filter(fetched, lambda r: F.regexp(F.col("target"), r["regex"]))))


def _judged_by_join(rows: DataFrame, filed: dict[UrlRule, str | None]) -> DataFrame:
    spark = rows.sparkSession
    table = spark.createDataFrame([(t or "", r.rank, r.length, r.text, r.verdict, r.named, r.regex) for r, t in filed.items()], "token string, rank int, length int, text string, verdict string, named boolean, regex string")
    urls = rows.select("target").distinct()
    candidates = urls.select("target", F.explode(F.array_union(_tokens(F.col("target")), F.array(F.lit("")))).alias("token")).join(table, "token")
    fit = candidates.where(F.regexp(F.col("target"), F.col("regex"))).groupBy("target").agg(F.max(F.struct("rank", "length", "text", "verdict", "named", "regex")).alias("hit"))
    return rows.join(fit, "target", "left")


#: The method's own rules: hosts that name what they sell, and mirror farms.
SPAM_RULES = tuple(pattern_rule(p) for p in ("spam-farm.*", "cheap-pills.*", "free-casino.*", "*/wp-login.php*", "*/affiliate/*"))
