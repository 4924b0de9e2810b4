"""Names and strings as SQL text."""

from __future__ import annotations

from collections.abc import Iterable


def quoted(name: str) -> str:
    """A column's literal name, spaces and dots included."""
    return "`" + name.replace("`", "``") + "`"


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """The names, each lengthened until no column has it, in any case."""
    taken = {column.lower() for column in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def string(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
