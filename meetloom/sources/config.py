"""Source registry: YAML files read on the driver (a registry is small by nature) as rows, and their edits from the source log."""

from __future__ import annotations

import os
from collections.abc import Mapping
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "source_id string, source_name string, jurisdiction string, government_level string, body_name string, source_type string, base_url string, meeting_frequency string, collection_method string, adapter string, parser string, priority_level string, status string, notes string, download_root string, structured_output_dir string, email_sender_patterns array<string>"
FIELDS = [f.split()[0] for f in SCHEMA.split(", ")]


def scalar(text: str) -> Any:
    """A YAML scalar: quoted text, number, boolean, null, an inline list, or plain text."""
    text = text.strip()
    if len(text) > 1 and text[0] == text[-1] and text[0] in "'\"":
        return text[1:-1]
    if text.startswith("[") and text.endswith("]"):
        return [scalar(x) for x in text[1:-1].split(",") if x.strip()]
    if text == "{}":
        return {}
    if (low := text.lower()) in ("", "null", "~", "true", "false"):
        return {"true": True, "false": False}.get(low)
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def parse_yaml(text: str) -> Any:
    """Nested mappings and lists of block YAML, which is what the registry's files use; for machines without a YAML library."""
    lines = [(len(x) - len(x.lstrip()), x.strip()) for x in text.splitlines() if x.strip() and not x.lstrip().startswith("#") and x.strip() != "---"]
    at = 0

    def block(indent: int) -> Any:
        nonlocal at
        if lines[at][1] == "-" or lines[at][1].startswith("- "):
            out: list[Any] = []
            while at < len(lines) and lines[at][0] == indent and (lines[at][1] == "-" or lines[at][1].startswith("- ")):
                rest = lines[at][1][1:].strip()
                if rest and _is_entry(rest):
                    inner = indent + len(lines[at][1]) - len(rest)
                    lines[at] = (inner, rest)
                    out.append(block(inner))
                elif rest:
                    out.append(scalar(rest))
                    at += 1
                else:
                    at += 1
                    out.append(block(lines[at][0]) if at < len(lines) and lines[at][0] > indent else None)
            return out
        made: dict[str, Any] = {}
        while at < len(lines) and lines[at][0] == indent and _is_entry(lines[at][1]):
            key, _, rest = lines[at][1].partition(":")
            at += 1
            if rest.strip():
                made[key.strip().strip("'\"")] = scalar(rest.split(" #")[0])
            else:
                deeper = at < len(lines) and (lines[at][0] > indent or lines[at][0] == indent and lines[at][1].startswith("- "))
                made[key.strip().strip("'\"")] = block(lines[at][0]) if deeper else None
        return made

    return block(lines[0][0]) if lines else None


def _is_entry(text: str) -> bool:
    return text[:1] not in "'\"[" and (": " in text or text.endswith(":"))


def load_yaml(path: str | os.PathLike) -> dict[str, Any]:
    """A file that must hold a mapping."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml
    except ImportError:
        out = parse_yaml(text)
    else:
        out = yaml.safe_load(text)
    if not isinstance(out, dict):
        raise ValueError(f"{path} holds no mapping")
    return out


def load_configs(folder: str | os.PathLike) -> list[dict[str, Any]]:
    """All source files of a folder in order of their names."""
    return [load_yaml(p) for p in sorted(Path(folder).glob("*.y*ml"))]


def config_of(folder: str | os.PathLike, source_id: str) -> dict[str, Any]:
    for c in load_configs(folder):
        if c.get("source_id") == source_id:
            return c
    raise KeyError(f"unknown source: {source_id}")


def config_rows(spark: SparkSession, configs: list[Mapping[str, Any]]) -> DataFrame:
    text = lambda v: v if v is None or isinstance(v, (str, list)) else str(v)
    return spark.createDataFrame([tuple(text(c.get(f)) for f in FIELDS) for c in configs], SCHEMA)


def set_scalars(path: str | os.PathLike, updates: Mapping[str, str]) -> None:
    """Rewrite top-level scalar lines of a file; keys that it lacks are appended."""
    left = dict(updates)
    lines = []
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        key = line.split(":", 1)[0] if ":" in line and not line.startswith(" ") else None
        lines.append(f"{key}: {left.pop(key)}" if key in left else line)
    Path(path).write_text("\n".join([*lines, *(f"{k}: {v}" for k, v in left.items())]) + "\n", encoding="utf-8")


def sync_from_log(log: Mapping[str, Any], folder: str | os.PathLike, source_ref: str, write: bool = False) -> dict[str, Any]:
    """What a source's file would take over from its log entry (its first public address), and, with write, takes over."""
    entry = next((s for s in log.get("sources", []) if s.get("source_ref") == source_ref), None)
    if entry is None:
        raise KeyError(f"unknown source_ref: {source_ref}")
    path = next((p for p in sorted(Path(folder).glob("*.y*ml")) if load_yaml(p).get("source_id") == entry.get("current_source_id")), None)
    if path is None:
        return {"source_ref": source_ref, "path": None, "changes": {}, "written": False}
    urls = entry.get("public_urls") or []
    wanted = urls[0].get("url") if urls and isinstance(urls[0], dict) else urls[0] if urls else None
    changes = {"base_url": wanted} if wanted and load_yaml(path).get("base_url") != wanted else {}
    if write and changes:
        set_scalars(path, changes)
    return {"source_ref": source_ref, "path": str(path), "changes": changes, "written": bool(write and changes)}


def activate(log: Mapping[str, Any], folder: str | os.PathLike, source_ref: str, write: bool = False) -> dict[str, Any]:
    """Make the download folder and take over the log's address; only looks unless `write`. An invalid log activates nothing."""
    from meetloom.sources.registry_log import problems

    if errors := [m for s, m in problems(log) if s == "error"]:
        return {"source_ref": source_ref, "activated": False, "errors": errors}
    entry = next((s for s in log.get("sources", []) if s.get("source_ref") == source_ref), None)
    if entry is None:
        raise KeyError(f"unknown source_ref: {source_ref}")
    root = entry.get("local_download_root")
    if root and write:
        os.makedirs(root, exist_ok=True)
    synced = sync_from_log(log, folder, source_ref, write) if entry.get("current_source_id") else None
    return {"source_ref": source_ref, "activated": write, "download_root": root, "sync": synced}
