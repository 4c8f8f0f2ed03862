"""Names of columns that come and go inside an operator."""

from __future__ import annotations


def fresh(columns: list[str], *names: str) -> list[str]:
    """names, changed so that none is one of columns."""
    out = []
    for name in names:
        while name in columns or name in out:
            name += "_"
        out.append(name)
    return out
