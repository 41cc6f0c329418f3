"""Language identification by Bayesian evidence fusion.

Four kinds of evidence meet in one posterior per row:
- the text: a byte-trigram likelihood for each language, learned on a bounded labelled
  sample, tempered so that a long text counts as at most TEXT_WEIGHT independent trigrams;
- the language that markup declares, with reliabilities learned from the corpus;
- the address suffix, and
- the host, whose prior is smoothed towards its domain's, that towards its suffix's, that
  towards the corpus'. These are grouped sums of the texts' own soft votes, over all rows,
  pre-aggregated before they are shuffled; a row's own vote is taken out of its host's.

A row is kept if its best language has at least LEAST_POSTERIOR and there is any evidence
of its own (a trigram or a known declaration); otherwise its language is 'und'.

Null or empty text gives no text evidence, a null host or declaration none of its kind.
Ties go to the language first in order. Without labelled texts everything is 'und'.
Repeated rows give repeated results; filters leave columns unchanged, else other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meetloom.llm.common import ascii_lower, saved, small_batches, stored, text_udf

SAMPLE_DOCS, SAMPLE_BYTES = 3_000, 24 << 20
BUCKETS, TEXT_WEIGHT, SMOOTHING = 1 << 16, 64.0, 4.0
#: Votes that stand for a right and for each wrong declaration before the corpus is counted.
DECLARED_RIGHT, DECLARED_WRONG = 4.0, 0.25
LEAST_POSTERIOR = 0.5
BROADCAST_HOSTS = 50_000


@dataclass
class TextModel:
    """langs in order; table[bucket, i] = log P(trigram | langs[i])."""

    langs: list[str]
    table: np.ndarray

    def evidence(self, text: str | None) -> tuple[list[float], int]:
        """Tempered log-likelihoods (their maximum is 0) and the number of trigrams."""
        h = trigrams(text)
        if not len(h):
            return [0.0] * len(self.langs), 0
        ll = np.zeros(len(self.langs))
        for at in range(0, len(h), 1 << 16):
            ll += self.table[h[at : at + (1 << 16)]].sum(0, dtype=np.float64)
        ll /= 1 + len(h) / TEXT_WEIGHT
        return (ll - ll.max()).tolist(), len(h)


def trigrams(text: str | None) -> np.ndarray:
    """Hashed byte trigrams of the text with A-Z lower-cased and white space made one space; only those with a letter (a byte from 'a' up)."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint32)
    b = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
    return (h >> np.uint32(16))[(b[:-2] >= 97) | (b[1:-1] >= 97) | (b[2:] >= 97)]


def fit_text(samples: list[tuple[str, str]]) -> TextModel:
    langs = sorted({lang for _, lang in samples})
    counts = np.full((BUCKETS, max(1, len(langs))), 0.1)
    for text, lang in samples:
        counts[:, langs.index(lang)] += np.bincount(trigrams(text), minlength=BUCKETS)
    return TextModel(langs, np.log(counts / counts.sum(0)).astype(np.float32)[:, : len(langs)])


def labelled_sample(docs: DataFrame) -> list[tuple[str, str]]:
    """At most SAMPLE_DOCS texts with their languages, each of another id, in the order of a hash of the id, and SAMPLE_BYTES of UTF-8 text. Of an id's
    rows the first in order of language and text stands for it, so an id that is repeated takes one place."""
    labelled = docs.where("text is not null and lang is not null and doc_id is not null")
    ids = labelled.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    rows = labelled.select("doc_id", "text", "lang").join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("row"))
    out, size = [], 0
    for r in rows.select("doc_id", "row.text", "row.lang").orderBy(F.xxhash64("doc_id"), "doc_id").toLocalIterator():
        n = len(r["text"].encode("utf-8", "replace"))
        if size + n > SAMPLE_BYTES:  # a text that does not fit leaves room for those after it
            continue
        size += n
        out.append((r["text"], r["lang"]))
    return out


def page_text(html: Column) -> Column:
    """What a reader sees of a page: no scripts, styles, comments or tags."""
    return F.regexp_replace(F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", " "), r"<[^>]*>", " ")


def declared_language(html: Column) -> Column:
    """The two-letter language of the html tag, else null."""
    return ascii_lower(F.nullif(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2})", 1), F.lit("")))


def url_host(url: Column) -> Column:
    return ascii_lower(F.nullif(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def text_evidence_column(spark, model: TextModel):
    """An Arrow UDF of the text: struct of ll (tempered log-likelihoods) and n (trigrams)."""
    shared = spark.sparkContext.broadcast(model)
    small_batches(spark)
    kind = pa.struct([("ll", pa.list_(pa.float64())), ("n", pa.int64())])
    return text_udf("struct<ll: array<double>, n: bigint>", lambda found: pa.array([{"ll": ll, "n": n} for ll, n in found], kind), lambda: shared.value.evidence)


class Fusion:
    """Corpus statistics of rows with columns host, declared, ev (text evidence), and the posterior they give."""

    def __init__(self, rows: DataFrame, langs: list[str]):
        self.langs = langs
        votes = rows.select(*_levels(F.col("host")), self._known(F.col("declared")).alias("declared"), *[v.alias(f"v{i}") for i, v in enumerate(self._votes())], (F.col("ev.n") > 0).cast("int").alias("n"))
        sums = [F.sum(f"v{i}").alias(f"v{i}") for i in range(len(langs))] + [F.sum("n").alias("n")]
        by_host = saved(votes.groupBy("host", "domain", "suffix").agg(*sums))
        spoken = votes.where("declared is not null").groupBy("declared").agg(*sums).collect()  # a row for each known language and 'other'
        total = by_host.agg(*sums).first()
        n = total["n"] or 0
        overall = [((total[f"v{i}"] or 0) + 1) / (n + len(langs)) for i in range(len(langs))]
        self.declared = {}
        for d in [*langs, "other"]:
            got = next((r for r in spoken if r["declared"] == d), None)
            trust = [DECLARED_RIGHT if d == lang else DECLARED_WRONG for lang in langs]
            self.declared[d] = [((got[f"v{i}"] if got else 0) + trust[i]) / (sum(r[f"v{i}"] for r in spoken) + DECLARED_RIGHT + len(langs) * DECLARED_WRONG) for i in range(len(langs))]
        at_suffix = self._smoothed(by_host.groupBy("suffix").agg(*sums), [F.lit(x) for x in overall])
        at_domain = self._smoothed(by_host.groupBy("domain", "suffix").agg(*sums).join(at_suffix, "suffix"), [F.col(f"p{i}") for i in range(len(langs))])
        table = by_host.join(at_domain.drop("suffix"), "domain").select("host", *[F.col(f"v{i}").alias(f"h{i}") for i in range(len(langs))], F.col("n").alias("hn"), *[F.col(f"p{i}").alias(f"d{i}") for i in range(len(langs))])
        self.table = saved(table)
        self.small = self.table.count() <= BROADCAST_HOSTS

    def _known(self, declared: Column) -> Column:
        return F.when(declared.isin(self.langs), declared).when(declared.isNotNull(), F.lit("other"))

    def _votes(self) -> list[Column]:
        """Posterior of the text alone; nothing from rows without text."""
        e = [F.exp(F.col("ev.ll")[i]) for i in range(len(self.langs))]
        return [F.when(F.col("ev.n") > 0, x / sum(e[1:], e[0])).otherwise(0.0) for x in e]

    def _smoothed(self, sums: DataFrame, parent: list[Column]) -> DataFrame:
        keep = [c for c in sums.columns if c in ("domain", "suffix")]
        return sums.select(*keep, *[((F.col(f"v{i}") + SMOOTHING * parent[i]) / (F.col("n") + SMOOTHING)).alias(f"p{i}") for i in range(len(self.langs))])

    def judge(self, rows: DataFrame) -> DataFrame:
        """Adds `judged` (lang, posterior, text_lang, keep) to rows with host, declared and ev. Hosts beyond a broadcast's bound are joined by a shuffle whose hot keys AQE splits."""
        k = range(len(self.langs))
        table = self.table.withColumnRenamed("host", "__host")
        rows = rows.join(F.broadcast(table) if self.small else table, _levels(F.col("host"))[0].eqNullSafe(F.col("__host")), "left")
        own = self._votes()
        says = F.create_map(*[x for d, p in self.declared.items() for x in (F.lit(d), F.array(*map(F.lit, p)))])
        said = F.element_at(says, self._known(F.col("declared")))
        mine = (F.col("ev.n") > 0).cast("int")
        logs = []
        for i in k:
            prior = (F.greatest(F.lit(0.0), F.col(f"h{i}") - own[i]) + SMOOTHING * F.col(f"d{i}")) / (F.greatest(F.lit(0), F.col("hn") - mine) + SMOOTHING)
            logs.append(F.col("ev.ll")[i] + F.log(F.coalesce(prior, F.lit(1.0 / len(self.langs)))) + F.coalesce(F.log(said[i]), F.lit(0.0)))
        rows = rows.withColumns({f"__s{i}": logs[i] for i in k})
        top = F.greatest(*[F.col(f"__s{i}") for i in k]) if len(self.langs) > 1 else F.col("__s0")
        total = sum((F.exp(F.col(f"__s{i}") - top) for i in k), F.lit(0.0))
        best = F.coalesce(*[F.when(F.col(f"__s{i}") == top, F.lit(lang)) for i, lang in enumerate(self.langs)])
        text_best = F.coalesce(*[F.when((F.col("ev.n") > 0) & (F.col("ev.ll")[i] == 0), F.lit(lang)) for i, lang in enumerate(self.langs)])
        told = (F.col("ev.n") > 0) | F.coalesce(F.col("declared").isin(self.langs), F.lit(False))
        keep = told & (1 / total >= LEAST_POSTERIOR)
        judged = F.struct(F.when(keep, best).otherwise("und").alias("lang"), (1 / total).alias("posterior"), text_best.alias("text_lang"), keep.alias("keep"))
        return rows.withColumn("judged", judged).drop("__host", "hn", *[f"{c}{i}" for c in ("h", "d", "__s") for i in k])


def _levels(host: Column) -> list[Column]:
    """host, its last two labels, its last label ('' for names without a dot and for null)."""
    host = F.coalesce(host, F.lit(""))
    labels = F.split(host, r"\.")
    return [host.alias("host"), F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), F.lit(2)), ".").alias("domain"), F.when(F.size(labels) > 1, F.element_at(labels, -1)).otherwise("").alias("suffix")]


def identify_languages(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """doc_id, page_id, host, declared, lang, posterior, text_lang, keep: a row for each document (host: its source; nothing declared) and each page."""
    spark = docs.sparkSession
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang"), docs["source"].cast("string").alias("source"))
    model = fit_text(labelled_sample(docs))
    none = F.lit(None)
    rows = docs.select("doc_id", none.cast("long").alias("page_id"), F.col("source").alias("host"), none.cast("string").alias("declared"), "text")
    rows = rows.unionByName(pages.select(none.cast("long").alias("doc_id"), pages["page_id"].cast("long").alias("page_id"), url_host(pages["url"]).alias("host"), declared_language(pages["html"]).alias("declared"), page_text(pages["html"]).alias("text")))
    if not model.langs:
        return rows.select("doc_id", "page_id", "host", "declared", F.lit("und").alias("lang"), F.lit(0.0).alias("posterior"), none.cast("string").alias("text_lang"), F.lit(False).alias("keep"))
    seen = saved(rows.select("doc_id", "page_id", "host", "declared", text_evidence_column(spark, model)("text").alias("ev")))
    return Fusion(seen, model.langs).judge(seen).select("doc_id", "page_id", "host", "declared", "judged.*")


def keep_identified(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The rows of docs (doc_id, text, lang, source, ...), columns unchanged, whose language is told with enough certainty."""
    model = fit_text(labelled_sample(labelled or docs))
    if not model.langs:
        return docs.limit(0)
    evidence = text_evidence_column(docs.sparkSession, model)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["source"].cast("string").alias("host"), F.lit(None).cast("string").alias("declared"), evidence(docs["text"].cast("string")).alias("ev"))
    rows = stored(rows, "language-evidence")  # texts are judged once: read again by the corpus' sums and by the posteriors
    return Fusion(rows.select("host", "declared", "ev"), model.langs).judge(rows).where("judged.keep").select("row.*")
