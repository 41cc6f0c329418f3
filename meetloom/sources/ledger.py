"""A ledger of downloads: what is planned, who holds it until when, and what became of it.

The ledger is a log of events that is only added to; an address's state is its last event. So planning, leasing and
settling write their own rows and nothing else, whatever the ledger's size. Jobs take waves of addresses on lease, a host's share
of a wave bounded by its budget of requests, so a host with a third of all addresses is worked off over many waves instead of
in one task. A job that is killed leaves leases, which it takes up again under its own name at once and others when they have run out;
receipts of downloads tell what it had fetched, so no address is fetched twice. Two writers that lease at once collide in the
store, and the second tries again on what is left.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meetloom.operators.ranking import first_n_per_scope
from meetloom.sources import downloads, fetch, store

PLANNED, LEASED, DONE, FAILED, AGAIN = "planned", "leased", "done", "failed", "again"
EVENTS = T.StructType([T.StructField(n, T.StringType()) for n in ("source_id", "url", "host", "window_from", "window_to", "state", "job", "sha256", "final_url", "outcome", "error_code")] + [T.StructField("at", T.TimestampType()), T.StructField("until", T.TimestampType()), T.StructField("seq", T.LongType()), T.StructField("tries", T.IntegerType())])
TABLE = "download_events"
#: Tries of an address whose failures pass; requests of a host in a wave.
MOST_TRIES, HOST_SHARE = 5, 1_000


def states(events: DataFrame) -> DataFrame:
    """The last event of each source and address."""
    others = [c for c in events.columns if c not in ("source_id", "url")]
    return events.groupBy("source_id", "url").agg(F.max_by(F.struct(*others), "seq").alias("last")).select("source_id", "url", "last.*")


def plan(tables: store.Store, work: DataFrame, now: datetime | None = None) -> None:
    """Add addresses (source_id, url, window_from, window_to) that the ledger lacks; of one that comes twice the first window stays."""
    known = tables.read(TABLE, EVENTS).select("source_id", "url").distinct()
    first = work.where("url is not null").groupBy("source_id", "url").agg(F.min_by("window_to", "window_from").alias("window_to"), F.min("window_from").alias("window_from"))
    new = first.join(known, ["source_id", "url"], "left_anti").withColumns({"host": downloads.host_of(F.col("url")), "state": F.lit(PLANNED), "seq": F.lit(0), "tries": F.lit(0), "at": F.lit(now or _now())})
    tables.commit({}, added={TABLE: store.conform(new, EVENTS)})


def open_work(current: DataFrame, job: str, now: datetime) -> DataFrame:
    """States that may be leased: planned or to be tried again, held by this job, or held by another whose lease has run out."""
    waiting = F.col("state").isin(PLANNED, AGAIN)
    return current.where(waiting | (F.col("state") == LEASED) & ((F.col("job") == job) | (F.col("until") <= F.lit(now))))


def wave(rows: DataFrame, host_share: int) -> DataFrame:
    """At most host_share rows of each host, those with the fewest tries and earliest windows first."""
    order = [F.col("tries"), F.col("window_from").asc_nulls_last(), F.col("source_id"), F.col("url")]
    return first_n_per_scope(rows, "host", order, host_share)


def lease(tables: store.Store, job: str, seconds: int = 3_600, host_share: int = HOST_SHARE, now: datetime | None = None, tries: int = 5) -> DataFrame:
    """Take a wave and return it as it is stored."""
    now = now or _now()
    for left in reversed(range(tries)):
        rows = wave(open_work(states(tables.read(TABLE, EVENTS)), job, now), host_share)
        mine = tables.staged(store.conform(rows.withColumns({"state": F.lit(LEASED), "job": F.lit(job), "at": F.lit(now), "until": F.lit(now + timedelta(seconds=seconds)), "seq": F.col("seq") + 1}), EVENTS))
        if mine.isEmpty():
            return mine
        try:
            tables.commit({}, added={TABLE: mine})
            return mine
        except RuntimeError:
            if not left:
                raise
    return mine


def settle(tables: store.Store, leased: DataFrame, receipts: DataFrame, now: datetime | None = None) -> None:
    """Note what became of leased addresses. Without a receipt they may be tried again, as are failures that pass, up to MOST_TRIES."""
    got = fetch.processed(receipts).select("url", F.col("sha256").alias("got"), F.col("final_url").alias("led_to"), F.col("outcome").alias("how"), F.col("error_code").alias("code"), "retryable", F.lit(True).alias("told"))
    rows = leased.drop("sha256", "final_url", "outcome", "error_code").join(got, "url", "left")
    tried = F.col("tries") + 1
    state = F.when(F.col("told").isNull(), AGAIN).when(F.col("got").isNotNull(), DONE).when(F.col("retryable") & (tried < MOST_TRIES), AGAIN).otherwise(FAILED)
    out = rows.withColumns({"state": state, "tries": tried, "sha256": F.col("got"), "final_url": F.col("led_to"), "outcome": F.col("how"), "error_code": F.col("code"), "until": F.lit(None).cast("timestamp"), "at": F.lit(now or _now()), "seq": F.col("seq") + 1})
    tables.commit({}, added={TABLE: store.conform(out, EVENTS)})


def work_off(tables: store.Store, job: str, fetcher: fetch.Fetcher, root: str, host_share: int = HOST_SHARE, requests_a_second: float | None = None, waves: int | None = None) -> dict[str, int]:
    """Wave after wave until nothing is open, or so many; the ledger's counts by state come back."""
    done = 0
    while waves is None or done < waves:
        mine = lease(tables, job, host_share=host_share)
        if mine.isEmpty():
            break
        got = downloads.download(mine, fetcher, root, run=f"{job}-{uuid.uuid4().hex}", requests_a_second=requests_a_second)
        settle(tables, mine, got)
        done += 1
    return counts(tables)


def counts(tables: store.Store) -> dict[str, int]:
    return {r["state"]: r["count"] for r in states(tables.read(TABLE, EVENTS)).groupBy("state").count().collect()}


def compact(tables: store.Store) -> None:
    """Rewrite the log as one event an address."""
    tables.commit({TABLE: store.conform(states(tables.read(TABLE, EVENTS)), EVENTS)})


def _now() -> datetime:
    return datetime.now(timezone.utc)
