"""The log of sources and bodies: listing, validation and status, from YAML on the driver (a registry is small by nature)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meetloom.sources.config import load_yaml

# What an entry must have, and which fields have named values.
SOURCE_FIELDS = ["source_ref", "status", "collection_role", "activation_stage", "access_model"]
BODY_FIELDS = ["body_id", "sources"]
ENUMS = {"status": "source_status_values", "collection_role": "collection_role_values", "activation_stage": "activation_stage_values", "access_model": "access_model_values"}


def load(path: str) -> dict[str, Any]:
    return load_yaml(path)


def problems(log: Mapping[str, Any]) -> list[tuple[str, str]]:
    """(severity, message) of everything that is wrong."""
    out: list[tuple[str, str]] = []
    parts: dict[str, list] = {}
    for name in ("sources", "bodies", "activation_queue"):
        value = log.get(name, [] if name == "activation_queue" else None)
        parts[name] = value if isinstance(value, list) else []
        if not isinstance(value, list):
            out.append(("error", f"{name} must be a list"))

    def entries(name: str, key: str, fields: list[str]):
        for i, e in enumerate(parts[name]):
            if not isinstance(e, dict):
                out.append(("error", f"{name}[{i}] must be a mapping"))
                continue
            if lacks := sorted(set(fields) - set(e)):
                out.append(("error", f"{e.get(key, f'{name}[{i}]')} lacks {', '.join(lacks)}"))
            yield e

    sources = list(entries("sources", "source_ref", SOURCE_FIELDS))
    bodies = list(entries("bodies", "body_id", BODY_FIELDS))
    known = {s.get("source_ref") for s in sources}
    for rows, key in ((sources, "source_ref"), (bodies, "body_id")):
        out += [("error", f"repeated {key}: {k}") for k, n in Counter(r.get(key) for r in rows).items() if n > 1 and k]
    for s in sources:
        for name, enum in ENUMS.items():
            if isinstance(log.get(enum), list) and s.get(name) not in log[enum]:
                out.append(("error", f"{s.get('source_ref')} has an unknown {name}: {s.get(name)}"))
        if not s.get("public_urls"):
            out.append(("warning", f"{s.get('source_ref')} has no public_urls"))
        if isinstance(s.get("schedule"), dict) and "cadence" not in s["schedule"]:
            out.append(("warning", f"{s.get('source_ref')} has a schedule without cadence"))
    linked = [(b.get("body_id"), x.get("source_ref") if isinstance(x, dict) else None) for b in bodies for x in b.get("sources") or []]
    linked += [("activation_queue", q.get("source_ref")) for q in entries("activation_queue", "source_ref", [])]
    return out + [("error", f"{who} names an unknown source: {ref}") for who, ref in linked if ref not in known]


def listing(spark: SparkSession, log: Mapping[str, Any], **equal: str | None) -> DataFrame:
    """The sources that match the given fields; None means any."""
    own = ["source_ref", "source_name", "current_source_id", "status", "activation_stage", "collection_role", "access_model"]
    nested = {"cadence": "schedule", "latest_imported_meeting_date": "freshness", "last_failure": "freshness"}

    def of(source: Mapping[str, Any], group: str) -> Mapping[str, Any]:
        return source[group] if isinstance(source.get(group), dict) else {}

    text = lambda v: None if v is None else str(v)
    sources = [s for s in log.get("sources") or [] if isinstance(s, dict) and all(not v or s.get(k) == v for k, v in equal.items())]
    rows = [(*(text(s.get(f)) for f in own), *(text(of(s, group).get(f)) for f, group in nested.items())) for s in sources]
    return spark.createDataFrame(rows, ", ".join(f"{f} string" for f in [*own, *nested]))


def unknown_references(rows: DataFrame, reference: str, subject: str, known: DataFrame, key: str) -> DataFrame:
    """problem, subject: rows whose reference no known row has; a null reference is unknown too."""
    lost = rows.join(known.select(F.col(key).alias(reference)).distinct(), reference, "left_anti")
    return lost.select(F.lit("unknown reference").alias("problem"), F.col(subject).cast("string").alias("subject"))


def repeated(rows: DataFrame, column: str) -> DataFrame:
    """problem, subject: non-null values that more than one row has."""
    twice = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.select(F.lit("repeated name").alias("problem"), F.col(column).cast("string").alias("subject"))


def counts(log: Mapping[str, Any]) -> dict[str, Any]:
    """The validation as one record: whether it is valid, its errors and warnings, and how many entries there are."""
    found = problems(log)
    said = {kind: [m for s, m in found if s == kind] for kind in ("error", "warning")}
    size = lambda name: len(log[name]) if isinstance(log.get(name), list) else 0
    return {"valid": not said["error"], "errors": said["error"], "warnings": said["warning"], "source_count": size("sources"), "body_count": size("bodies"), "activation_queue_count": size("activation_queue")}
