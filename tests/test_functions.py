"""Scalar functions on hand-made values."""

import pytest
from pyspark.sql import functions as F

from meetloom.functions import exprs


def values(spark, f, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r["y"] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_clean_text(spark):
    assert values(spark, exprs.clean_text, " a \n b\t", "", None) == ["a b", "", None]


def test_dates(spark):
    got = values(spark, exprs.date_iso, "2026-05-20", "May 20, 2026", "Wednesday, May 21, 2025", "5/7/2026", "  May  1, 2026 ", "May 2026", "Wednesday,May 1, 2026", "", None, "2/30/2026")
    assert got == ["2026-05-20", "2026-05-20", "2025-05-21", "2026-05-07", "2026-05-01", None, None, None, None, None]


def test_slash_dates(spark):
    assert values(spark, exprs.slash_date, "on 05/07/2026 at", "13/1/2026", "0/1/2026", "none", None) == ["May 7, 2026", None, None, None, None]


def test_slugs(spark):
    assert values(spark, exprs.slugify, " Fire & Rescue!", "--", None, "Ñandú 7") == ["fire-rescue", "document", "document", "ñandú-7"]
    assert values(spark, exprs.sanitize_filename, "..a b/c.pdf_", "///") == ["a_b_c.pdf", "document"]


def test_search_folds_ascii_only_and_keeps_wildcards(spark):
    assert values(spark, lambda c: exprs.contains_like(c, "É_X"), "aÉbx", "aébx", "É\\x", None) == [True, False, True, None]
    assert values(spark, lambda c: exprs.contains_like(c, "\\"), "a\\b", "ab") == [True, False]


def test_tags_are_substring_hits(spark):
    assert values(spark, exprs.topic_tags, "A REFUND for tenants", "nothing", "")[0] == ["budget", "housing"]
    assert values(spark, exprs.topic_tags, "nothing", "") == [[], []]


def test_screening_precedence(spark):
    got = values(spark, exprs.screening, "/a/supporting_docs/Cancelled.txt", "/a/supporting-docs/x.txt", "/a/supporting_docs_old/x.txt", "/cancelled/x.txt")
    assert got == ["cancellation_notice", "supporting_material", "included", "included"]
    got = values(spark, lambda c: exprs.screening(c, F.lit("la_city_primegov_html")), "/a/x_HTML-1.txt", "/a/x_pdf-1.txt", "/a_html-/x.txt")
    assert got == ["included", "non_canonical_companion", "non_canonical_companion"]


def test_html_text(spark):
    assert values(spark, exprs.html_to_text, "<p>a&nbsp;<b>b</b></p> <p></p>c<br/>d &amp;lt;") == ["a b\nc\nd &lt;"]
    assert values(spark, exprs.plain, "<b>&#8217;caf&eacute;&rarr;</b> x", "a & b", None) == ["\u2019caf\u00e9\u2192 x", "a & b", None]
    assert values(spark, exprs.title_case, "children's o'NEIL", None) == ["Children'S O'Neil", None]


def test_document_roles(spark):
    texts = ["Draft Minutes of", "slides", "slide deck", "governance", "Membership slate", "the amendment", "a motion in report", "dashboard", "nothing"]
    assert values(spark, exprs.document_role, *texts) == ["minutes", "attachment", "presentation", "attachment", "governance_doc", "agreement", "motion", "report", "attachment"]
    assert values(spark, lambda c: exprs.document_role(F.lit("x"), c), "/a/Supporting-Docs/x") == ["supporting_document"]
    from meetloom.extract.kernels import supporting_role

    assert [supporting_role(t, "") for t in texts] == values(spark, exprs.document_role, *texts)


@pytest.mark.parametrize(("title", "want"), [("Sole source amendment", "sole_source_contract"), ("Extend and award", "contract_amendment"), ("adopt", "policy_adoption"), ("x", "discussion_item")])
def test_actions(spark, title, want):
    df = spark.createDataFrame([(title, "", "Presentations")], "t string, x string, s string")
    assert df.select(exprs.action_class(exprs.lowered(F.col("t"), F.col("x")), F.col("s")).alias("a")).first()["a"] == want
