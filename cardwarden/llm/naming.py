"""Names for helper columns beside columns that the caller brings."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(rows: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it differ from every column of the rows."""
    taken = {c.lower() for c in rows.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found
