"""Sensitive-value detectors.

A detector is a regex, optionally gated by keywords: a hit counts when a
keyword occurs at most ``max_distance`` characters before the match, or
when the cell sits under a column whose name is one of the keywords. Both
forms compile to one JVM regex per detector, so the scan is a handful of
``regexp_extract_all`` calls per cell.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Detector:
    name: str
    regex: str
    keywords: tuple[str, ...] = field(default_factory=tuple)
    max_distance: int = 300
    # a literal every match contains: cells without it skip the regex entirely
    hint: str | None = None

    def proximity_regex(self) -> str:
        """A match (group 1) that some keyword precedes by at most N characters.

        The look-behind is bounded and consumes nothing, so every match near a
        keyword counts, also several after one; the look-ahead in front skips
        positions where no match begins. Keywords match case-insensitively,
        the value pattern as written.
        """
        kws = "|".join(re.escape(k) for k in self.keywords)
        return f"(?s)(?={self.regex})(?<=(?i:{kws}).{{0,{self.max_distance}}})({self.regex})"

    def hits(self, value: Column, column_name: Column) -> Column:
        """Number of matches in one cell (0 when none)."""
        bare = F.size(F.regexp_extract_all(value, F.lit(f"({self.regex})"), 1))
        if self.keywords:
            near = F.size(F.regexp_extract_all(value, F.lit(self.proximity_regex()), 1))
            under = F.lower(column_name).isin([k.lower() for k in self.keywords])
            bare = F.when(under, bare).otherwise(near)
        if self.hint:
            return F.when(F.instr(value, self.hint) > 0, bare).otherwise(F.lit(0))
        return bare


# Fixed values. The strategy-code detector's pattern, keywords and distance;
# the e-mail and secret-token detectors are our own patterns.
STRATEGY_CODE = Detector(
    name="strategy-code-detector",
    regex=r"STRAT-[A-Z]{3}-[0-9]{2}",
    keywords=("内部戦略コード", "戦略コード"),
    max_distance=300,
    hint="STRAT-",
)
EMAIL = Detector(
    name="email-address",
    regex=r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    hint="@",
)
SECRET_TOKEN = Detector(
    name="secret-token",
    regex=r"[0-9a-f]{40}",
    keywords=("token",),
    max_distance=300,
)

DEFAULT_DETECTORS = (EMAIL, STRATEGY_CODE, SECRET_TOKEN)
