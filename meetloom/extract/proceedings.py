"""Statements of proceedings: sections, numbered items with a file number nearby, set matters, and what was decided."""

from __future__ import annotations

import re
from itertools import takewhile

from meetloom.extract import patterns as p
from meetloom.extract.kernels import PARSERS, PROCEEDINGS, Document, Item, normalised, parliamentary, squeeze, tags_of

# Fixed values of the format.
SECTION = re.compile(r"^([IVXLC]+)\.\s+(.+?)\s*$", p.I)
SECTION_NUMBER = re.compile(r"^([IVXLC]+)\.\s*$", p.I)
NUMBERED = re.compile(r"^(\d{1,3})\.\s+(.*\S)\s*$")
SET_MATTER = re.compile(r"^(?:SET MATTERS?)?\s*Set Matter\s*-?\s*(\d+)\.\s*(.*\S)?\s*$", p.I)
NOISE = re.compile(r"^(?:Page\s+\d+County of |[A-Za-z]+\s+\d{1,2},\s+\d{4}Board of Supervisors Statement Of Proceedings|BOARD OF SUPERVISORS\s+\d+\s*-\s*\d+|[0-9]+\s*-\s*)", p.I)
END = re.compile(r"^(?:The foregoing is a fair statement of the proceedings|Closing\s+\d+)", p.I)
BODY = re.compile(
    r"^(?:Report by|Hearing on the proposed|The Department|All persons wishing to testify|Opportunity was given|Interested person|On motion of|After discussion|After hearing|Correspondence was received|No interested persons|The Chief Executive Officer|The Director of|The Auditor-Controller)", p.I)
BODY_NAME = "Los Angeles County Board of Supervisors"
LOOK_AHEAD = 5


def item_type(title: str, section: str) -> str:
    low, sec = title.lower(), section.lower()
    for found, kind in ((low.startswith("motion "), "board_motion"), ("hearing" in low or "hearing" in sec, "public_hearing"), ("ordinance" in low or "ordinance" in sec, "ordinance"), ("closed session" in sec, "closed_session_item")):
        if found:
            return kind
    return "bos_sop_item"


def _clean_title(text: str) -> str:
    return squeeze(p.FILE_ID.sub("", text)).strip(" -")


def _has_file_number(lines: list[str]) -> bool:
    """On the first line, or on one after it before a section or a numbered line without one."""
    reach = takewhile(lambda x: x is lines[0] or not SECTION.match(x) and (not NUMBERED.match(x) or p.FILE_ID.search(x)), lines)
    return any(p.FILE_ID.search(x) for x in reach)


def _labels(lines: list[str]) -> list[str]:
    """One label per line. A numbered line starts an item if a file number is on it or on one of the next five non-blank-agnostic lines."""
    out = []
    for i, line in enumerate(lines):
        if not line or NOISE.match(line) and not NUMBERED.match(line):
            out.append("skip")
        elif END.match(line):
            out.append("end")
        elif SET_MATTER.match(line):
            out.append("set")
        elif NUMBERED.match(line):
            out.append("item" if _has_file_number(lines[i : i + 1 + LOOK_AHEAD]) else "numbered")
        elif SECTION.match(line):
            out.append("section")
        elif SECTION_NUMBER.match(line):
            out.append("number")
        else:
            out.append("text")
    return out


def _is_special(section: str) -> bool:
    """Sections whose numbered lines are items without a file number."""
    return "SET MATTER" in section.upper() or "PUBLIC HEARING" in section.upper()


def parse_proceedings(text: str, path: str) -> Document:
    """Regular items start at a numbered line with a file number nearby; their titles run to a body phrase or to the line of a later
    file number. Special ones, in set-matter and hearing sections or by a set-matter line, end their titles before such a line."""
    lines = [squeeze(x) for x in normalised(text, join_wraps=False).splitlines()]
    date = next((m for m in map(p.LONG_DATE.search, lines) if m), None)
    items: list[Item] = []
    number, title = "", ""
    label, head, body, titled, special, under = "", [], [], False, False, ""

    def close() -> None:
        nonlocal label, head, body
        if label and (name := _clean_title(" ".join(head))):
            block = squeeze(" ".join([name, *body]))
            items.append(Item(number or "UNSPECIFIED", under or "Unspecified", label, item_type(name, under), name, block, [], tags_of(f"{under} {block}"), **parliamentary([*head, *body])))
        label, head, body = "", [], []

    for line, kind in zip(lines, _labels(lines), strict=True):
        if kind == "end":
            break
        starts = (
            kind == "item"
            or kind == "numbered" and _is_special(title) and not (label and (titled or body))
            or kind == "set" and (special or not label) and (_is_special(title) or not title)
        )
        if kind == "section" or kind == "number" and not label:
            close()
            m = (SECTION if kind == "section" else SECTION_NUMBER).match(line)
            number, title = m[1].upper(), re.sub(r"\s+\d+\s*-\s*\d+$", "", m[2]) if kind == "section" else ""
        elif starts:
            close()
            m = (SET_MATTER if kind == "set" else NUMBERED).match(line)
            special, under = _is_special(title) or kind == "set", title or ("SET MATTER" if kind == "set" else "")
            label, head, titled = m[1], [m[2]] if m[2] else [], False
        elif kind == "skip":
            continue
        elif number and not title and not label and line.isupper() and len(line) < 80:
            title = line
        elif label:
            if titled or body or BODY.match(line) or special and p.FILE_ID.search(line):
                body.append(line)
            else:
                head.append(line)
                titled = bool(p.FILE_ID.search(line))
    close()
    return Document(PROCEEDINGS, BODY_NAME, squeeze(f"{date[1]}, {date[2]}") if date else None, "proceedings", items)


PARSERS[PROCEEDINGS] = parse_proceedings
