"""Schema-level operators: load stamp, rename maps, regex canonicalisation,
decimal and boolean casts (P1-P5, F15).

Column resolution (which header becomes which name) is decided once on the
driver from ``df.columns`` -- metadata, not data -- and applied as a single
projection, so Catalyst still sees one plain ``Project``.
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The legacy master's source headers and their English names.
LEGACY_RENAME_MAP = {
    "投資信託_分類": "fund_category",
    "信託報酬_率": "trust_fee_rate",
    "有効レコード": "is_active",
    "ファンド名": "fund_name",
    "愛称": "alias_name",
    "運用会社": "management_company",
    "隠れコスト": "hidden_cost",
    "内部戦略コード": "internal_strategy_code",
}


@dataclass(frozen=True)
class AliasRule:
    regex: str
    canonical_name: str
    priority: int = 1


# Header variants -> canonical column name (anchored, case-insensitive,
# first matching rule wins; priority is carried but every rule has 1).
ALIAS_RULES = [
    AliasRule(r"^(ファンド名|fund(_)?name)$", "fund_name"),
    AliasRule(r"^(運用会社|マネジメント会社|management[_ ]?company|mgmt[_ ]?company)$", "management_company"),
    AliasRule(r"^(愛称|ニックネーム|nickname|alias[_ ]?name)$", "nickname"),
    AliasRule(r"^(信託報酬_?率?|management[_ ]?fee|fee[_ ]?rate[_ ]?pct)$", "trust_fee_rate"),
    AliasRule(r"^(隠れコスト(率)?|hidden[_ ]?cost)$", "hidden_cost"),
    AliasRule(r"^(有効レコード|is[_ ]?active|valid[_ ]?flag)$", "valid_flag"),
    AliasRule(r"^(投資信託[_ ]?分類|fund[_ ]?category|投信[_ ]?分類)$", "fund_category"),
    AliasRule(r"^(取込日|取込日付|ingest[_ ]?date)$", "ingest_date"),
]


RULES_SCHEMA = "regex string, canonical_name string, priority int"


def rules_frame(spark, rules: list[AliasRule] = ALIAS_RULES):
    """The alias rules as an in-memory table with an explicit schema."""
    return spark.createDataFrame([(r.regex, r.canonical_name, r.priority) for r in rules], RULES_SCHEMA)


def rules_from_frame(df) -> list[AliasRule]:
    """Rules kept as a (small, configuration-sized) table, read back in order."""
    return [AliasRule(r["regex"], r["canonical_name"], r["priority"]) for r in df.collect()]


def stamp_ingest_date(df: DataFrame, day: str | _dt.date, col: str = "ingest_date") -> DataFrame:
    """Add the load date as a DATE literal."""
    return df.withColumn(col, F.lit(str(day)).cast("date"))


def rename_map(df: DataFrame, mapping: dict[str, str] = LEGACY_RENAME_MAP) -> DataFrame:
    """Rename the headers that are present; absent ones are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def resolve_aliases(columns: list[str], rules: list[AliasRule] = ALIAS_RULES) -> dict[str, str]:
    """P3 resolution: old name -> canonical name.

    Rules are tried in order; a rule renames every column it matches unless
    its canonical name is already taken (by an original column or an earlier
    rename), so two variants never collapse onto one name.
    """
    taken = set(columns)
    out: dict[str, str] = {}
    compiled = [(re.compile(r.regex, re.IGNORECASE), r.canonical_name) for r in rules]
    for pat, canon in compiled:
        for c in columns:
            if c in out or canon in taken:
                continue
            if pat.match(c):
                out[c] = canon
                taken.add(canon)
    return out


def canonicalize_columns(df: DataFrame, rules: list[AliasRule] | DataFrame = ALIAS_RULES) -> DataFrame:
    """One projection that applies the resolved alias map.

    ``rules`` may be a list or a rules table (:func:`rules_frame`).
    """
    if isinstance(rules, DataFrame):
        rules = rules_from_frame(rules)
    m = resolve_aliases(df.columns, rules)
    return df.withColumnsRenamed(m) if m else df


def decimal_cast(df: DataFrame, cols: list[str], precision: int = 5, scale: int = 2) -> DataFrame:
    """Cast to decimal(p, s); text that does not parse becomes null."""
    t = f"decimal({precision},{scale})"
    return df.withColumns({c: F.expr(f"try_cast(`{c}` as {t})") for c in cols if c in df.columns})


def bool_normalize(df: DataFrame, cols: list[str]) -> DataFrame:
    """P5: "True" -> true, "False" -> false, anything else through try_cast."""
    def one(c):
        s = F.col(c).cast("string")
        return (F.when(s == "True", F.lit(True))
                .when(s == "False", F.lit(False))
                .otherwise(F.expr(f"try_cast(`{c}` as boolean)")))
    return df.withColumns({c: one(c) for c in cols if c in df.columns})
