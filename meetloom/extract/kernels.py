"""Line-oriented extraction of agenda items, as typed Python kernels that run inside mapInPandas.

A parser labels every line once (section, item start, end, noise or text) and a single
pass folds the labels into items, so the formats differ in their labelling only.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field
from datetime import datetime
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import DataFrame

from meetloom.extract import patterns as p
from meetloom.functions.rules import DOCUMENT_ROLES, MONTHS, ROLE_OF_PATH, ROLE_OF_REST, SUPPORTING_PARTS, TOPIC_RULES

DEFAULT, PRIMEGOV, PROCEEDINGS, SUPPORTING = "la_county_cluster_text", "la_city_primegov_html", "la_county_bos_sop_text", "supporting_document_text"


@dataclass
class Item:
    section_number: str
    section_title: str
    item_label: str
    item_type: str
    title: str
    text_block: str
    speakers: list[str] = field(default_factory=list)
    topic_tags: list[str] = field(default_factory=list)
    action_text_raw: str | None = None
    vote_text_raw: str | None = None
    final_action: str | None = None
    motion_by: str | None = None
    second_by: str | None = None
    ayes_count: int | None = None
    noes_count: int | None = None
    abstain_count: int | None = None
    absent_count: int | None = None
    ayes_members: list[str] = field(default_factory=list)
    noes_members: list[str] = field(default_factory=list)
    abstain_members: list[str] = field(default_factory=list)
    absent_members: list[str] = field(default_factory=list)


@dataclass
class Document:
    parser: str
    body_name: str | None
    meeting_date: str | None
    document_role: str
    items: list[Item]


def squeeze(text: str) -> str:
    return " ".join(text.split())


def normalised(text: str, join_wraps: bool = True) -> str:
    """Known mojibake repaired; words wrapped between letters of one case joined without a space; at most one blank line."""
    for bad, good in p.MOJIBAKE:
        text = text.replace(bad, good)
    if join_wraps:
        for case in ("[A-Z]", "[a-z]"):  # letters are consumed, so a line of one letter joins on one side only
            text = re.sub(f"({case})\n({case})", r"\1\2", text)
    return re.sub(r"\n{3,}", "\n\n", text)


def tags_of(text: str) -> list[str]:
    low = text.lower()
    return sorted(t for t, words in TOPIC_RULES.items() if any(w in low for w in words))


def iso_date(text: str | None) -> str | None:
    text = squeeze(text or "")
    for form in ("%Y-%m-%d", "%B %d, %Y", "%A, %B %d, %Y", "%m/%d/%Y"):
        try:
            return datetime.strptime(text, form).date().isoformat()
        except ValueError:
            pass
    return None


def header_date(text: str) -> str | None:
    m = p.DATE_LINE.search(text)
    return m and ", ".join(squeeze(x).rstrip(",") for x in m.groups() if x)


def cluster_in(line: str) -> str | None:
    m = p.CLUSTER.search(line)
    if not m:
        return None
    name = re.sub(r"(?i)^Members of the Public may address(?: the)?\s+", "", squeeze(m[0]))
    name = name.strip(" -")
    return name if 0 < len(name) <= 120 else None


def cluster_name(text: str) -> str | None:
    """Near 'Board of Supervisors' first, else the first line that names a cluster."""
    lines = [x for x in map(squeeze, text.splitlines()) if x]
    near = [c for i, x in enumerate(lines) if "Board of Supervisors" in x for c in lines[i : i + 6] if "Cluster" in c and "address" not in c.lower()]
    return next((n for n in map(cluster_in, [*near, *lines]) if n), None)


def split_names(text: str) -> list[str]:
    return [x for x in map(squeeze, text.replace(" and ", ", ").split(",")) if x]


def letter_block(lines: list[str]) -> tuple[str, list[str], str]:
    """Title, speakers and type of an item's lines. Speakers may go on as bullets; a first line may name the type."""
    speakers, body, listening = [], [], False
    for line in lines:
        if p.BOILERPLATE.match(squeeze(line)):
            break
        if m := p.SPEAKERS.match(line):
            listening = True
            speakers += split_names(m[1] or "")
        elif listening and (m := p.BULLET.match(line)):
            speakers.append(squeeze(m[1]))
        elif line.strip():
            listening = False
            body.append(squeeze(line))
    kind = "other"
    for start, name in (("BOARD LETTER", "board_letter"), ("BOARD BRIEFING", "board_briefing"), ("MOTION", "board_motion")):
        if body and body[0].upper().startswith(start):
            kind, body = name, body[1:]
            break
    return squeeze(" ".join(body)), speakers, kind


def motion_block(lines: list[str]) -> tuple[str, list[str], str]:
    kept = [x for x in map(squeeze, lines) if x and x.upper() not in ("MOTION", "MOTIONS", "MOTIONS:")]
    return re.sub(r"^[•-]\s*", "", squeeze(" ".join(kept))), [], "board_motion"


def _is_boundary(line: str) -> bool:
    low = squeeze(line).lower()
    return bool(p.NUMBER_ONLY.match(line)) or low in ("board of", "supervisors") or low.startswith("board of supervisors")


def parse_cluster_agenda(text: str, path: str) -> Document:
    """Lettered items and district motions under numbered sections. A section header is looked for first, so letters that are
    Roman digits open sections. Agendas of regional bodies, told by both of their markers, have a layout of their own."""
    from meetloom.extract import meetings

    if meetings.REGIONAL_MARKER.search(text) and meetings.REGIONAL_OPENING in text:
        return meetings.parse_regional(text, path)
    text = normalised(text)
    items: list[Item] = []
    section: tuple[str, str] | None = None
    start: tuple[str, str] | None = None  # kind and label of the open item
    held: list[str] = []

    def close() -> None:
        nonlocal start, held
        if start and section:
            title, speakers, kind = (letter_block if start[0] == "letter" else motion_block)(held)
            block = squeeze(" ".join(held))
            if title.lower() not in ("none", "none."):
                items.append(Item(*section, start[1], kind, title, block, speakers, tags_of(block)))
        start, held = None, []

    for line in text.splitlines():
        ends = bool(p.STOP.match(line) or p.BOILERPLATE.match(squeeze(line)))
        if m := p.SECTION.match(line):
            close()
            section = m[1], squeeze(m[2])
        elif section and (m := p.LETTER_ITEM.match(line)):
            close()
            start, held = ("letter", m[1].upper()), [m[2]]
        elif section and (not start or start[0] != "letter") and (m := p.DISTRICT_ITEM.match(line)):
            close()
            start, held = ("motion", squeeze(m[1].upper().replace(" ", ""))), [m[2]] if m[2] else []
        elif section and (not start or start[0] == "bare" or start[0] == "motion" and section[1].lower().startswith("motions")) and (m := p.DISTRICT_ONLY.match(line)):
            close()
            start, held = ("bare", squeeze(m[1].upper())), []
        elif start and (ends or start[0] != "letter" and _is_boundary(line)):
            close()
        elif start and line.strip():
            held.append(line.strip())
    close()
    return Document(DEFAULT, cluster_name(text), header_date(text), "agenda", items)


def fragment_text(fragment: str) -> str:
    t = re.sub(r"(?i)<br\s*/?>|</(?:p|div|tr|li|table|tbody|td|h\d|u|strong|span)>", "\n", fragment)
    t = normalised(html.unescape(re.sub(r"<[^>]+>", " ", t)))
    return "\n".join(x for x in map(squeeze, t.splitlines()) if x)


def cut_at(pattern: re.Pattern[str], text: str) -> list[str]:
    """The text from each match to the next."""
    starts = [m.start() for m in pattern.finditer(text)]
    return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)], strict=True)]


def slash_date(text: str) -> str | None:
    m = re.search(r"(\d{1,2})/(\d{1,2})/(\d{4})", text)
    return f"{MONTHS[int(m[1]) - 1]} {int(m[2])}, {m[3]}" if m and int(m[1]) <= 12 else None


def html_body_and_date(text: str) -> tuple[str | None, str | None]:
    if m := p.HTML_HEADING.search(text):
        return squeeze(html.unescape(m[1])), squeeze(m[2])
    for title in reversed([squeeze(html.unescape(t)) for t in p.HTML_TITLE.findall(text)]):
        parts = [x for x in map(squeeze, title.split(" - ")) if x]
        if parts and title.lower() != "meeting":
            return parts[0], (slash_date(parts[1]) or parts[1]) if len(parts) > 1 else None
    return None, None


def parse_meeting_html(text: str, path: str) -> Document:
    """Sections and items of a meeting page; an item needs a label, a file number and a description."""
    text = normalised(text)
    items = []
    for section in cut_at(p.HTML_SECTION, text):
        named = p.HTML_SECTION_TITLE.search(section)
        title = squeeze(fragment_text(named[1])) if named else ""
        for block in cut_at(p.HTML_ITEM, section) if title else []:
            label, file, about = (x.search(block) for x in (p.HTML_LABEL, p.HTML_FILE, p.HTML_DESCRIPTION))
            description = squeeze(fragment_text(about[1])) if label and file and about else ""
            if not description:
                continue
            parts = [f"Council File: {squeeze(fragment_text(file[1]))}", description]
            for name, pattern in (("Fiscal", p.HTML_FISCAL), ("Community", p.HTML_COMMUNITY)):
                if (m := pattern.search(block)) and (value := squeeze(fragment_text(m[1]))):
                    parts.append(f"{name} Impact Statement: {value}")
            block_text = squeeze(" ".join(parts))
            items.append(Item(title, title, label[1], "primegov_agenda_item", description, block_text, [], tags_of(f"{title} {block_text}")))
    return Document(PRIMEGOV, *html_body_and_date(text), "agenda", items)


def member(name: str) -> str:
    return squeeze(p.ROLE_PREFIX.sub("", name.strip())).strip(" .;-")


def final_action(text: str) -> str | None:
    m = p.ACTION.search(text)
    if not m:
        return None
    did = m[1].lower()
    return "received_and_filed" if "received" in did else "continued" if did.startswith("continued") else "approved" if did == "duly carried" else did


def parliamentary(lines: list[str]) -> dict:
    """Mover, seconder, action and votes. A vote line counts on its own; the last of a kind wins, and no members count as unknown."""
    lines = [x for x in map(squeeze, lines) if x]
    joined = " ".join(lines)
    out: dict = {}
    if m := p.MOTION.search(joined):
        out = {"motion_by": member(m[1]), "second_by": member(m[2]), "action_text_raw": squeeze(m[0]), "final_action": final_action(m[3])}
    elif led := joined if joined.lower().startswith(p.LEAD_INS) else next((x for x in lines if x.lower().startswith(p.LEAD_INS)), None):
        out = {"action_text_raw": led, "final_action": final_action(led)}
    votes = [(m[1].lower(), m[0], m[2]) for m in map(p.VOTE.match, lines) if m]
    for label, _, names in votes:
        kind = "abstain" if label.startswith("abst") else label
        out[f"{kind}_members"] = [n for n in map(member, split_names(re.sub(r"\b\d+\s*-\s*$", "", names))) if n]
        out[f"{kind}_count"] = len(out[f"{kind}_members"]) or None
    out["vote_text_raw"] = squeeze(" ".join(v[1] for v in votes)) or None
    return out


def parse_supporting(text: str, path: str) -> Document:
    """One item for the whole document; its role decides type and section."""
    role = supporting_role(text, path)
    lines = [x for x in map(squeeze, text.splitlines()) if x]
    usable = (x for x in lines[:25] if len(x) <= 180 and not x.lower().startswith(("page ", "attachments:", "public comment", "opportunity for members")) and not p.BOILERPLATE.match(x) and not (role == "minutes" and "statement of proceedings" in x.lower()))
    stem = re.sub(r"^supporting_\d+_", "", PurePosixPath(path).stem) if path else "supporting document"
    title = next(usable, "").strip(" -") or squeeze(re.sub(r"[-_]", " ", stem).title()) or "Supporting Document"
    block = squeeze(text)
    date = p.LONG_DATE.search(text)
    when = squeeze(f"{date[1]}, {date[2]}") if date else header_date(text)
    item = Item("SUPPORTING", squeeze(role.replace("_", " ").title()), "DOC", f"supporting_{role}", title, block, [], tags_of(f"{title} {block}"))
    parts = PurePosixPath(path).parts if path else ()
    above = next((parts[i - 1] for i, x in enumerate(parts) if x.lower() in SUPPORTING_PARTS and i), None)
    return Document(SUPPORTING, cluster_name(text) or (squeeze(above.replace("-", " ").title()) if above else None), when, role, [item])


def supporting_role(text: str, path: str) -> str:
    """The same rules as exprs.document_role."""
    low = text.lower()
    by_text = next((role for pattern, role in DOCUMENT_ROLES if re.search(pattern, low)), None)
    return by_text or (ROLE_OF_PATH if any(x in (path or "").lower() for x in SUPPORTING_PARTS) else ROLE_OF_REST)


PARSERS: dict[str, Callable[[str, str], Document]] = {DEFAULT: parse_cluster_agenda, PRIMEGOV: parse_meeting_html, SUPPORTING: parse_supporting}


def detect_parser(text: str, path: str) -> str:
    if any(x in SUPPORTING_PARTS for x in PurePosixPath((path or "").lower()).parts):
        return SUPPORTING
    from meetloom.extract import meetings, proceedings  # they add their parsers to the registry

    if p.HTML_MARKER.search(text):
        return PRIMEGOV
    if p.PROCEEDINGS_MARKER.search(text) and "Board of Supervisors" in text:
        return PROCEEDINGS
    return meetings.DEPUTIES if meetings.DEPUTIES_MARKER.search(text) else DEFAULT


def extract(text: str, path: str = "", parser: str | None = None) -> Document:
    """The document's items by the named parser, else by what the text looks like. An unknown name raises KeyError."""
    if parser and parser not in PARSERS:
        detect_parser("", "")  # loads the registry
    doc = PARSERS[parser or detect_parser(text, path)](text, path)
    for item in doc.items:
        if item.action_text_raw is None or item.final_action is None:
            for name, value in parliamentary(item.text_block.split("\n")).items():
                if getattr(item, name) in (None, []):
                    setattr(item, name, value)
    return doc


ITEM_FIELDS = ("section_number string, section_title string, item_label string, item_type string, title string, text_block string, speakers array<string>, topic_tags array<string>, action_text_raw string, vote_text_raw string, "
               "final_action string, motion_by string, second_by string, ayes_count int, noes_count int, abstain_count int, absent_count int, ayes_members array<string>, noes_members array<string>, abstain_members array<string>, absent_members array<string>")
SCHEMA = f"path string, parser string, cluster_name string, meeting_date string, meeting_date_iso string, document_role string, pos int, {ITEM_FIELDS}"


def extract_items(texts: DataFrame) -> DataFrame:
    """texts (path, text, parser or null) to item rows with their position; null texts have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for b in batches:
            rows = []
            for path, text, parser in zip(b["path"].tolist(), b["text"].tolist(), b["parser"].tolist(), strict=True):
                if text is None:
                    continue
                doc = extract(text, path or "", parser)
                about = {"path": path, "parser": doc.parser, "cluster_name": doc.body_name, "meeting_date": doc.meeting_date, "meeting_date_iso": iso_date(doc.meeting_date), "document_role": doc.document_role}
                rows += [about | {"pos": i} | asdict(x) for i, x in enumerate(doc.items)]
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({c: "Int32" for c in names if c.endswith("_count") or c == "pos"})

    return texts.select("path", "text", "parser").mapInPandas(run, SCHEMA)
