"""Listing, screening and incremental state of input files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meetloom.functions.exprs import is_cancellation, is_supporting, screening
from meetloom.functions.names import free


def list_files(spark: SparkSession, root: str, pattern: str = "*.txt") -> DataFrame:
    """path, modified, length of all files below root; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path", F.col("modificationTime").alias("modified"), "length")


def screened(paths: DataFrame, column: str = "path", parser: str | None = None) -> DataFrame:
    """Adds the reason; parser names the source's own, which decides about companions."""
    return paths.withColumn("reason", screening(F.col(column), F.lit(parser).cast("string")))


def screening_breakdown(paths: DataFrame, column: str = "path", parser: str | None = None) -> DataFrame:
    """Why paths were left out, and how many."""
    return screened(paths, column, parser).where("reason <> 'included'").groupBy("reason").agg(F.count(F.lit(1)).alias("paths"))


def supporting_files(paths: DataFrame, column: str = "path") -> DataFrame:
    """Supporting material that is no cancellation."""
    return paths.where(is_supporting(F.col(column)) & ~is_cancellation(F.col(column)))


def changed_files(listing: DataFrame, state: DataFrame, key: str = "path", marks: tuple[str, ...] = ("modified", "length")) -> DataFrame:
    """Rows of the listing that the state lacks or has with other marks."""
    was = [free(f"was_{m}", listing.columns) for m in marks]
    known = free("known", listing.columns)
    old = state.select(F.col(key), *[F.col(m).alias(w) for m, w in zip(marks, was, strict=True)], F.lit(True).alias(known))
    same = F.col(known).isNotNull()
    for m, w in zip(marks, was, strict=True):
        same = same & F.col(m).eqNullSafe(F.col(w))
    return listing.join(old, key, "left").where(~same).select(*listing.columns)
