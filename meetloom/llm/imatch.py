"""I-Match document fingerprints over randomised lexicons.

The lexicon keeps the terms whose share of documents (of large groups of copies one) lies in a band: neither so common
that they say nothing nor so rare that one edit moves them. A fingerprint hashes a text's
sorted distinct lexicon terms once for each of LEVELS * PER_LEVEL random subsets of the
lexicon; subsets of a level hold a quarter as many terms as those of the level above, so
texts of any length meet subsets that catch a term or two. Likeness of two fingerprints is
the share of agreeing hashes among the subsets that either text meets, on the levels
fine enough for the longer of the two.

The band bounds the lexicon: a term needs BAND[0] of these documents, so there are at most
(mean distinct terms of a document) / BAND[0] of them. That is checked before broadcasting;
beyond MAX_BROADCAST_TERMS the lexicon is joined by a shuffle. DataFrame functions only.

Each text meets its successor (descending doc_id, cyclic) in one shuffle: ids are cut at
SEGMENTS quantiles, each segment into equal ranges, each range is one window, and the last
row of a range is sent along to the next range as a guest. So outliers stretch only their
own segment, and a range has more than a few hundred rows only where ids repeat or cluster
inside one segment; rows of one id, or without one, are always one window, which Spark
spills. Null text counts as empty. Null ids order below all others, equal ids by text;
repeated rows are neighbours of each other. A table of one row is its own successor. Ids
may span the whole range of a long. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meetloom.llm.common import saved

BAND = (0.0005, 0.02)
LEVELS, PER_LEVEL = 5, 8
SUBSETS = LEVELS * PER_LEVEL
MAX_BROADCAST_TERMS = 1_000_000
#: Rows of a range on average; beyond ROWS_PER_RANGE * MAX_RANGES rows, ranges grow instead of their number.
ROWS_PER_RANGE, MAX_RANGES, SEGMENTS = 64, 1 << 20, 256
#: Runs of ASCII that are neither letters nor digits part the terms.
APART = r"[\x00-/:-@\[-`{-\x7F]+"
EMPTY = "0000"


def terms_of(text: Column) -> Column:
    return F.array_distinct(F.split(F.lower(text), APART))


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """term, mask: the band's terms; bit i of mask says that subset i holds the term. Copies of a text that make up BAND[0] of all rows or more
    count once, so a large group of copies doesn't lift its terms above the band. There are at most 1 / BAND[0] such texts."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("print", F.md5(F.col("text").cast("binary")))
    n = texts.count()
    copied = saved(texts.groupBy("print").agg(F.count(F.lit(1)).alias("copies")).where((F.col("copies") > 1) & (F.col("copies") >= band[0] * n)))
    held = copied.agg(F.count(F.lit(1)).alias("texts"), F.coalesce(F.sum("copies"), F.lit(0)).alias("rows")).first()
    total = n - held["rows"] + held["texts"]
    prints = F.broadcast(copied.select("print"))
    once = texts.join(prints, "print", "left_anti").select("text").unionByName(texts.join(prints, "print", "left_semi").select("text").distinct())
    counted = once.select(F.explode(terms_of(F.col("text"))).alias("term")).where("term <> ''").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    kept = counted.where((F.col("df") >= band[0] * total) & (F.col("df") <= band[1] * total)).select("term")
    mask = F.lit(0).cast("long")
    for i in range(SUBSETS):
        draw = F.conv(F.substring(F.md5(F.concat("term", F.lit(f":{i}")).cast("binary")), 1, 3), 16, 10).cast("int")
        mask = mask.bitwiseOR(F.when(draw < 4096 >> 2 * (i // PER_LEVEL + 1), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return saved(kept.select("term", mask.alias("mask")))


def _by_level(rows: DataFrame, terms: str) -> DataFrame:
    """Adds {terms}_0 .. {terms}_4: the terms that any subset of that level or a finer one holds. Finer subsets then look through few terms."""
    for level in range(LEVELS):
        of = F.col(f"{terms}_{level - 1}" if level else terms)
        rows = rows.withColumn(f"{terms}_{level}", F.filter(of, _any_of(((1 << SUBSETS) - 1) ^ ((1 << level * PER_LEVEL) - 1))))
    return rows


def _any_of(bits: int):
    return lambda t: t["mask"].bitwiseAND(F.lit(bits).cast("long")) != 0


def fingerprint(terms: str, all_terms: Column) -> Column:
    """8 hex digits for the number of lexicon terms, 8 hashed from all terms (compared where there are none), 4 for each subset. terms: a column of sorted structs of term, mask, split by _by_level."""

    def subset(held: Column) -> Column:
        return F.when(F.size(held) > 0, F.substring(F.md5(F.array_join(F.transform(held, lambda t: t["term"]), " ").cast("binary")), 1, 4)).otherwise(EMPTY)

    def level(k: int) -> Column:  # one expression for the level's subsets: forty of their own would make huge generated code
        bits = F.array(*[F.lit(1 << i).cast("long") for i in range(k * PER_LEVEL, (k + 1) * PER_LEVEL)])
        return F.array_join(F.transform(bits, lambda bit: subset(F.filter(F.col(f"{terms}_{k}"), lambda t: t["mask"].bitwiseAND(bit) != 0))), "")

    return F.concat(F.lpad(F.lower(F.hex(F.size(terms))), 8, "0"), all_terms, *map(level, range(LEVELS)))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1. Texts without lexicon terms are alike only if all their terms agree."""
    most = F.greatest(F.conv(F.substring(a, 1, 8), 16, 10).cast("int"), F.conv(F.substring(b, 1, 8), 16, 10).cast("int"))
    limits = F.array(*[F.lit(2 * 4 ** (i // PER_LEVEL + 1) if i // PER_LEVEL < LEVELS - 1 else 1 << 30) for i in range(SUBSETS)])
    both = F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda i: F.struct(F.get(limits, i).alias("limit"), F.substring(a, 17 + 4 * i, F.lit(4)).alias("x"), F.substring(b, 17 + 4 * i, F.lit(4)).alias("y")))
    met = F.filter(both, lambda s: (most <= s["limit"]) & ((s["x"] != EMPTY) | (s["y"] != EMPTY)))
    agree = F.filter(met, lambda s: s["x"] == s["y"])
    return F.when(F.size(met) > 0, F.size(agree) / F.size(met)).otherwise((F.substring(a, 1, 16) == F.substring(b, 1, 16)).cast("double"))


def _range_of(doc_id: Column, cuts: list[int], ranges: int) -> Column:
    """The range of an id: its segment between cuts, and an equal part of that, in decimals that no difference of longs overflows. -1 for null."""
    wide = lambda c: F.lit(c).cast("decimal(20,0)")
    segment = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts[1:-1]]), lambda c: c <= doc_id))
    low = F.get(F.array(*map(wide, cuts[:-1])), segment)
    high = F.get(F.array(*map(wide, cuts[1:])), segment)
    inside = F.floor((doc_id.cast("decimal(20,0)") - low) * F.lit(ranges) / (high - low + 1)).cast("long")
    return F.when(doc_id.isNull(), F.lit(-1).cast("long")).otherwise(segment * F.lit(ranges).cast("long") + F.greatest(F.lit(0).cast("long"), F.least(inside, F.lit(ranges - 1).cast("long"))))


def with_next_text(docs: DataFrame) -> DataFrame:
    """Rows (part, nth, guest, doc_id, text, next_text), hash-partitioned by part; guests only lead in their range."""
    about = docs.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.expr(f"percentile_approx(doc_id, array({', '.join(f'{i / SEGMENTS}D' for i in range(1, SEGMENTS))}), 4096)").alias("cuts"), F.max_by(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256), F.when(F.col("doc_id").isNull(), F.coalesce("text", F.lit("")))).alias("last_null")).first()
    n = about["n"]
    cuts = sorted({x for x in (about["low"], *(about["cuts"] or []), about["high"]) if x is not None}) or [0]
    step = -(-len(cuts) // max(1, min(SEGMENTS, n // ROWS_PER_RANGE)))
    cuts = [*(cuts[:-1:step] or cuts), cuts[-1]]
    ranges = max(1, min(MAX_RANGES, n // ROWS_PER_RANGE) // (len(cuts) - 1))
    rows = docs.select(_range_of(F.col("doc_id"), cuts, ranges).alias("own"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # At most MAX_RANGES + 1 rows: the largest id of each range and the range that comes next, cyclic.
    last = rows.select("own", "doc_id").groupBy("own").agg(F.max("doc_id").alias("last_id"))
    around = last.agg(F.min("own").alias("first_part")).collect()[0]["first_part"] if n else 0
    last = last.withColumn("then", F.coalesce(F.lead("own").over(Window.orderBy("own")), F.lit(around)))
    placed = rows.join(F.broadcast(last), "own")
    is_last = F.when(F.col("doc_id").isNull(), F.sha2(F.col("text").cast("binary"), 256) == F.lit(about["last_null"] or "")).otherwise(F.col("doc_id") == F.col("last_id"))
    at_home = F.struct(F.col("own").alias("part"), F.lit(False).alias("guest"))
    placed = placed.select(F.explode(F.when(is_last, F.array(at_home, F.struct(F.col("then").alias("part"), F.lit(True).alias("guest")))).otherwise(F.array(at_home))).alias("p"), "doc_id", "text").select("p.part", "p.guest", "doc_id", "text")
    order = Window.partitionBy("part").orderBy(F.desc("guest"), F.asc_nulls_first("doc_id"), "text")
    return placed.withColumns({"nth": F.row_number().over(order), "next_text": F.lag("text").over(order)})


def imatch_fingerprints(docs: DataFrame, band: tuple[float, float] = BAND, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_terms."""
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    words = lexicon(docs, band)
    if words.count() <= MAX_BROADCAST_TERMS:
        words = F.broadcast(words)
    n = F.char_length("text")
    taken = F.expr("char_length(text) div 3").cast("int")
    rows = with_next_text(docs).withColumns({"n_chars": n.cast("long"), "edited": F.concat(F.substring("text", F.lit(1), n - taken), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), taken))})
    body = F.struct(F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "doc_id", "n_chars", "guest")
    sides = rows.select("part", "nth", body.alias("about"), F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("body")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("body")))).alias("s"))
    sides = sides.select("part", "nth", "about", "s.side", terms_of(F.col("s.body")).alias("terms"))
    sides = sides.withColumn("about", F.struct(F.substring(F.md5(F.array_join(F.array_sort("terms"), " ").cast("binary")), 1, 8).alias("all_terms"), "about"))
    # The empty term leads: it stands for the text itself, so that no row is lost, and alone carries what is known of it.
    met = sides.select("part", "nth", "side", "about", F.explode(F.array_union(F.array(F.lit("")), F.col("terms"))).alias("term")).join(words, "term", "left").where("mask is not null or term = ''")
    met = met.select("part", "nth", "side", F.when(F.col("term") == "", F.col("about")).alias("about"), F.when(F.col("term") != "", F.struct("term", "mask")).alias("held"))
    folded = met.groupBy("part", "nth").agg(*[f(side) for side in (0, 1) for f in (
        lambda s: F.sort_array(F.collect_list(F.when(F.col("side") == s, F.col("held")))).alias(f"terms{s}"),
        lambda s: F.max(F.when(F.col("side") == s, F.col("about"))).alias(f"about{s}"),
    )])
    folded = _by_level(_by_level(folded, "terms0"), "terms1")
    prints = folded.select("part", "nth", "about0.about.*", fingerprint("terms0", F.col("about0.all_terms")).alias("fingerprint"), fingerprint("terms1", F.col("about1.all_terms")).alias("edited_fingerprint"), F.size("terms0").alias("n_terms"))
    order = Window.partitionBy("part").orderBy("nth")
    prints = prints.withColumn("next_print", F.lag("fingerprint").over(order)).where("not guest")
    return prints.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"), F.col("n_terms").cast("long").alias("n_terms"))
