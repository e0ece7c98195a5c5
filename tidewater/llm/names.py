"""Column names for an operator's own use that the caller's table does not bear."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free(df: DataFrame, *wanted: str) -> list[str]:
    """One name for each of ``wanted``: itself, with as many underscores put
    before it as it takes to differ from every column of ``df`` (names are
    compared without regard to case, as Spark does by default)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
