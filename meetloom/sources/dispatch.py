"""Online checks: each source's window, its adapter's plan, and one union of all plans in the ledger. A failing source stops no other."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meetloom.sources import fetch as net
from meetloom.sources import ledger, links, listings, store

# Adapters by the names that source logs use, and the days back where a log names none.
LOOKBACK, MOST_PER_SCOPE = 14, 20
PORTAL, DATA, CURRENT, LIBRARY = "la_city_primegov_online", "la_county_ceo_agendas_archive", "la_county_bos_current_page", "lahsa_document_library"

Plan = Callable[[SparkSession, net.Fetcher, Mapping[str, Any], date, date], DataFrame]


def window_of(entry: Mapping[str, Any], today: date) -> tuple[date, date]:
    schedule = entry.get("schedule") if isinstance(entry.get("schedule"), Mapping) else {}
    return today - timedelta(days=int(schedule.get("lookback_days") or LOOKBACK)), today + timedelta(days=int(schedule.get("lookahead_days") or 0))


def by_portal(spark: SparkSession, fetch: net.Fetcher, entry: Mapping[str, Any], first: date, last: date) -> DataFrame:
    return listings.meeting_work(listings.archived_meetings(spark, fetch, first, last)).select("url")


def by_data(spark: SparkSession, fetch: net.Fetcher, entry: Mapping[str, Any], first: date, last: date) -> DataFrame:
    bodies = entry.get("tracked_body_names")
    if not isinstance(bodies, list) or not bodies:
        raise ValueError(f"{entry.get('source_ref')} must define tracked_body_names")
    return links.requested_links(listings.agenda_sections(spark, fetch, {}).drop("method"), [str(b) for b in bodies], {}, first, last).select("url")


def by_page(spark: SparkSession, fetch: net.Fetcher, entry: Mapping[str, Any], first: date, last: date) -> DataFrame:
    return listings.current_links(spark, fetch, first, last).select("url")


def by_library(spark: SparkSession, fetch: net.Fetcher, entry: Mapping[str, Any], first: date, last: date) -> DataFrame:
    texts = lambda k: [str(x) for x in entry[k]] if isinstance(entry.get(k), list) else None
    return listings.library_documents(spark, fetch, texts("tracked_scope_ids"), texts("tracked_keywords") or [], int(entry.get("max_documents_per_scope") or MOST_PER_SCOPE)).select("url")


ADAPTERS: dict[str, Plan] = {PORTAL: by_portal, DATA: by_data, CURRENT: by_page, LIBRARY: by_library}


def plan_of(spark: SparkSession, fetch: net.Fetcher, entry: Mapping[str, Any], today: date, adapters: Mapping[str, Plan] = ADAPTERS) -> DataFrame:
    """source_id, url, window_from, window_to of one entry of a source log."""
    if not isinstance(entry.get("current_source_id"), str):
        raise ValueError(f"{entry.get('source_ref')} does not define current_source_id")
    if entry.get("adapter_candidate") not in adapters:
        raise NotImplementedError(f"no online check for adapter_candidate: {entry.get('adapter_candidate')}")
    first, last = window_of(entry, today)
    rows = adapters[entry["adapter_candidate"]](spark, fetch, entry, first, last)
    return rows.select(F.lit(entry["current_source_id"]).alias("source_id"), "url", F.lit(first.isoformat()).alias("window_from"), F.lit(last.isoformat()).alias("window_to"))


def plan_all(tables: store.Store, fetch: net.Fetcher, entries: list[Mapping[str, Any]], today: date, adapters: Mapping[str, Plan] = ADAPTERS) -> list[dict]:
    """Put the work of all entries into the ledger in one commit; what failed is told beside the others' windows."""
    plans, said = [], []
    for entry in entries:
        first, last = window_of(entry, today)
        row = {"source_ref": entry.get("source_ref"), "source_id": entry.get("current_source_id"), "from_date": first.isoformat(), "to_date": last.isoformat(), "error": None}
        try:
            plans.append(tables.staged(plan_of(tables.spark, fetch, entry, today, adapters)))
        except Exception as e:  # noqa: BLE001 - the row tells
            row["error"] = f"{type(e).__name__}: {e}".splitlines()[0]
        said.append(row)
    if plans:
        work = plans[0]
        for p in plans[1:]:
            work = work.unionByName(p)
        ledger.plan(tables, work)
    return said


def check_online(tables: store.Store, fetch: net.Fetcher, entries: list[Mapping[str, Any]], today: date, root: str, job: str, adapters: Mapping[str, Plan] = ADAPTERS, requests_a_second: float | None = None) -> dict:
    """Plan all entries, work the ledger off, and tell each source's window and the ledger's counts."""
    return {"sources": plan_all(tables, fetch, entries, today, adapters), "downloads": ledger.work_off(tables, job, fetch, root, requests_a_second=requests_a_second)}
