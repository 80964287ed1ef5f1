"""Column names that a table does not have."""

from __future__ import annotations

from collections.abc import Iterable


def free(columns: Iterable[str], *names: str) -> list[str]:
    """Each name, with as many underscores after it as it takes to be none of the columns' (whatever their case) nor another's."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
