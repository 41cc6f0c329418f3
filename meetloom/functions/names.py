"""Names of helper columns that no column of the input has."""

from __future__ import annotations

from collections.abc import Iterable


def free(name: str, *taken: Iterable[str]) -> str:
    """The name, lengthened until no taken one equals it (Spark compares names without case)."""
    low = {t.lower() for some in taken for t in some}
    while name.lower() in low:
        name += "_"
    return name
