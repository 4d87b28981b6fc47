"""Column names: looked up whatever characters they have, and new ones that meet no other."""

from __future__ import annotations

from collections.abc import Iterable


def quoted(column: str) -> str:
    """``column`` as a name to look up, whatever characters it has."""
    return "`" + column.replace("`", "``") + "`"


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores put behind it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
