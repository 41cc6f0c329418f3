"""The labelled samples keep what fits after a text that does not."""

from meetloom.llm import langid, toxicity


def test_a_text_over_the_budget_does_not_end_the_sample(spark, monkeypatch):
    for module in (langid, toxicity):
        monkeypatch.setattr(module, "SAMPLE_BYTES", 1000)
    docs = spark.createDataFrame([(i, "long " * 400 if i < 20 else f"text {i}", "en") for i in range(40)], "doc_id long, text string, lang string")
    assert len(langid.labelled_sample(docs)) == 20
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    short = [t for t, _ in toxicity.labelled_sample(docs, labels, parts=1)]
    assert len(short) == 20 and max(map(len, short)) < 10
