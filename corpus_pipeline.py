"""A training corpus from raw documents: each stage applies one operator to all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meetloom.llm import bpe, decontaminate, langid, similar, toxicity
from meetloom.llm.common import stored
from meetloom.llm.queries import TOKENIZER, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the toxicity classifier scores below its threshold."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is told with enough certainty."""
    return langid.keep_identified(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are 0.8 alike or more."""
    return similar.keep_one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return decontaminate.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the text decoded from them."""
    return bpe.bpe_digests(docs, TOKENIZER)


STAGES = [("toxicity", drop_toxic), ("language ID", keep_identified), ("SimHash near-dedup", keep_one_of_each), ("benchmark decontamination", drop_leaks), ("BPE", encode)]

#: Classifiers and edit distances have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
