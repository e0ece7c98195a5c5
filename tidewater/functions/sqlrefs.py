"""Table references in SQL text.

All JVM regex built-ins: ``regexp_extract_all`` finds every FROM/JOIN
target in one pass over the whole query text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# identifier = optionally quoted [a-z0-9_$]+, up to three dotted parts,
# directly after FROM or JOIN (the query is lower-cased first). A sub-query
# "FROM (" never matches because an identifier cannot start with "(".
IDENT = r"(?:[`\"]?[a-z0-9_$]+[`\"]?)"
TABLE_REF = r"\b(?:from|join)\s+(" + IDENT + r"(?:\." + IDENT + r"){0,2})"
# references dropped after extraction
REJECT_PREFIXES = ("unnest", "json_table")
SYSTEM_SCHEMA = r"^(\"?information_schema\"?|\"?sys\"?|\"?pg_catalog\"?)\."


def table_refs(query: Column | str) -> Column:
    """every raw FROM/JOIN target of the lower-cased query, in order."""
    q = F.col(query) if isinstance(query, str) else query
    return F.regexp_extract_all(F.lower(q), F.lit(TABLE_REF), 1)


def keep_ref(raw: Column) -> Column:
    """Not a table function, not a system schema."""
    cond = ~raw.rlike(SYSTEM_SCHEMA)
    for p in REJECT_PREFIXES:
        cond = cond & ~raw.startswith(p)
    return cond


def normalize_ref(raw: Column) -> Column:
    """strip quotes; ``catalog.db.table`` -> ``db.table``; else unchanged."""
    t = F.regexp_replace(raw, r"[`\"]", "")
    parts = F.split(t, r"\.")
    n = F.size(parts)
    return (F.when(n == 3, F.concat_ws(".", F.element_at(parts, 2), F.element_at(parts, 3)))
            .otherwise(t))


def iso_day(ts_text: Column | str) -> Column:
    """the date part before ``T`` of an ISO timestamp string."""
    c = F.col(ts_text) if isinstance(ts_text, str) else ts_text
    return F.split(c, "T").getItem(0)
