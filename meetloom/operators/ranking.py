"""First-wins, first-n, best-of and thinning operators over explicit positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meetloom.functions.names import free
from meetloom.sources.steps import stepped


def first_per_key(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in order: an aggregate that combines before the shuffle, for orders of plain columns."""
    at, row = free("at", rows.columns), free("row", rows.columns)
    kept = rows.withColumn(at, F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]))
    others = [c for c in rows.columns if c not in key]
    return kept.groupBy(*key).agg(F.min_by(F.struct(*others), F.col(at)).alias(row)).select(*key, f"{row}.*")


def first_n_per_scope(rows: DataFrame, scope: str | list[str], order: list[Column], n: int) -> DataFrame:
    """At most n rows a scope; Spark cuts each task's rows to n before the shuffle."""
    nth = free("nth", rows.columns)
    return rows.withColumn(nth, F.row_number().over(Window.partitionBy(scope).orderBy(*order))).where(F.col(nth) <= n).drop(nth)


def document_summaries(items: DataFrame, key: str, position: str, columns: list[str]) -> DataFrame:
    """Per document: the item count, and the other columns from its first row (nulls included)."""
    return items.groupBy(key).agg(F.count(F.lit(1)).alias("item_count"), *[F.min_by(c, position).alias(c) for c in columns])


def next_instants(instants: DataFrame, days: int, bucket_seconds: int = 3_600) -> DataFrame:
    """Distinct instants (scope, at in microseconds) with `then`, the scope's first instant at least so many days later (null: none). It
    lies in the bucket of time asked for, or is the first of the next bucket that has any. So windows hold one bucket of a scope, or one
    row a bucket, whose number a calendar bounds; both run from late to early, which is one pass."""
    step, size = days * 86_400_000_000, bucket_seconds * 1_000_000
    rows = instants.select("scope", "at", F.lit(None).cast("long").alias("asked")).unionByName(instants.select("scope", (F.col("at") + step).alias("at"), F.col("at").alias("asked")))
    rows = rows.withColumn("bucket", F.floor(F.col("at") / size))
    there = F.when(F.col("asked").isNull(), F.col("at"))
    inside = Window.partitionBy("scope", "bucket").orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy("scope").orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    same = rows.withColumn("same", F.min(there).over(inside)).where("asked is not null")
    onward = rows.groupBy("scope", "bucket").agg(F.min(there).alias("first")).select("scope", "bucket", F.min("first").over(after).alias("onward"))
    return same.join(onward, ["scope", "bucket"]).select("scope", F.col("asked").alias("at"), F.coalesce("same", "onward").alias("then"))


def thin_snapshots(rows: DataFrame, scope: str, ts: str, days: int = 6) -> DataFrame:
    """Greedy thinning per scope: the first instant, then each that lies at least so many days after the last kept. Each instant points to the
    one that would be kept after it; pointers are doubled, and what is kept grows by doubled steps from the first instants. No
    scope is gathered in a row: k kept instants take log2 k rounds of joins. A null scope or instant is left out."""
    kind = rows.schema[ts].dataType
    instants = rows.where(F.col(ts).isNotNull() & F.col(scope).isNotNull()).select(F.col(scope).alias("scope"), F.unix_micros(F.col(ts).cast("timestamp")).alias("at")).distinct()
    jumps = stepped(next_instants(instants, days).where("then is not null"))
    kept = instants.groupBy("scope").agg(F.min("at").alias("at"))
    while True:
        ahead = kept.join(jumps, ["scope", "at"], "left").select("scope", F.explode(F.array_compact(F.array("at", "then"))).alias("at"))
        kept = stepped(ahead.distinct())
        on = jumps.select("scope", F.col("at").alias("then"), F.col("then").alias("next"))
        jumps = stepped(jumps.join(on, ["scope", "then"]).select("scope", "at", F.col("next").alias("then")))
        if jumps.isEmpty():
            return kept.select(F.col("scope").alias(scope), F.timestamp_micros("at").cast(kind).alias(ts))
