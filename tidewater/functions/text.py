"""Key normalisation, composite keys, text assembly and tokenising.

Only NFKC needs Python: Spark has no Unicode normal-form function. It runs
as an Arrow-batched pandas UDF (one Arrow transfer per batch, not per row),
and only for non-ASCII text: NFKC leaves ASCII unchanged, so ASCII values
are folded by JVM built-ins. Where values repeat, ``normalize_distinct`` folds
each different one once. Everything else is a JVM built-in so it stays
inside whole-stage codegen.
"""

from __future__ import annotations

import re
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import materialize

# Fixed values that must equal the reference's behaviour:
#   key normaliser = null -> "", NFKC, lower-case, delete every (Unicode) whitespace char
#   composite key separator "_", text feature separator " "
#   token pattern: runs of Han, Hiragana, Katakana, or ASCII letters/digits; no lower-casing
KEY_SEPARATOR = "_"
TEXT_SEPARATOR = " "
TOKEN_PATTERN = r"[\p{IsHan}]+|[\p{IsHiragana}]+|[\p{IsKatakana}]+|[A-Za-z0-9]+"

_WS = re.compile(r"\s+")


def _fold_one(v):
    if v is None:
        return ""
    return _WS.sub("", unicodedata.normalize("NFKC", v).lower())


@F.pandas_udf(StringType())
def _fold(s: pd.Series) -> pd.Series:
    return s.map(_fold_one)


# Ship this module's UDF code by value, so executors need no copy of the package.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError):  # pragma: no cover
    pass


# Python's \s restricted to ASCII: space, \t \n \v \f \r and the separators \x1c-\x1f
_ASCII_WS = r"[\t\n\x0B\f\r \x1c-\x1f]+"


def normalize_key(c: Column | str) -> Column:
    """null -> "", NFKC, lower, strip all whitespace (Unicode \\s).

    NFKC leaves ASCII text unchanged, so ASCII values (character length ==
    byte length) are folded by JVM built-ins and reach the Python UDF as
    nulls: only non-ASCII text crosses into Python.
    """
    col = F.col(c) if isinstance(c, str) else c
    ascii_only = F.length(col) == F.octet_length(col)
    jvm = F.regexp_replace(F.lower(col), _ASCII_WS, "")
    return F.when(ascii_only, jvm).otherwise(_fold(F.when(ascii_only, F.lit(None)).otherwise(col)))


def normalize_distinct(df: DataFrame, fields: list[str], suffix: str = "_norm") -> DataFrame:
    """F1 of columns whose values repeat (names, companies): every different
    non-ASCII value of all ``fields`` goes through Python once.

    The different values are counted (combined map-side), folded and written as a
    dictionary by digest, which the fields are joined with. Values that hold more
    than a hundredth of the cells are fewer than 100; those of up to 4096 bytes
    are broadcast. The rest is an ordinary join, which AQE broadcasts if it measures small. Rows that need
    no entry (ASCII, null, common value) get keys of their own in that join, so
    that no task has them all. Adds ``<field><suffix>``, the same as ``normalize_key``.
    """
    def wide(f):
        return F.when(F.length(f) != F.octet_length(f), F.col(f))

    cells = df.select(F.explode(F.array(*[wide(f) for f in fields])).alias("value")).filter("value IS NOT NULL")
    folded = materialize(cells.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
                         .select(digest("value").alias("d"), "n", _fold("value").alias("folded")), "folded", "parquet")
    share = (folded.agg(F.sum("n")).first()[0] or 0) / 100
    common = (F.col("n") > share) & (F.octet_length("folded") <= 4096)
    often, rest = folded.filter(common), folded.filter(~common)
    low = {c.lower() for c in df.columns} | {f"{f}{suffix}".lower() for f in fields}
    names = ["key", "hot", "hot_folded", "at", "rest_folded"]
    k, h, hf, at, rf = (next(n for n in (f"{'_' * i}{x}" for i in range(1, 99)) if n not in low) for x in names)
    for f in fields:
        df = df.withColumn(k, digest(wide(f)))
        df = df.join(F.broadcast(often.select(F.col("d").alias(h), F.col("folded").alias(hf))), F.col(k) == F.col(h), "left")
        own = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))
        df = df.withColumn(k, F.when(F.col(h).isNull() & F.col(k).isNotNull(), F.col(k)).otherwise(own))
        df = df.join(rest.select(F.col("d").alias(at), F.col("folded").alias(rf)), F.col(k) == F.col(at), "left")
        ascii_form = F.regexp_replace(F.lower(f), _ASCII_WS, "")
        df = df.withColumn(f"{f}{suffix}", F.coalesce(hf, rf, ascii_form, F.lit(""))).drop(k, h, hf, at, rf)
    return df


def det_key(df: DataFrame, fields: list[str], out: str = "det_key",
            suffix: str = "_norm", repeated: bool = False) -> DataFrame:
    """normalise each field into ``<field><suffix>`` and join them with "_".

    Also adds ``<out>_empty`` (every normalised field is empty); such rows
    carry no identity and are kept out of exact matching. ``repeated``: the
    values repeat, so each different one is normalised once.
    """
    normed = [f"{f}{suffix}" for f in fields]
    if repeated:
        df = normalize_distinct(df, fields, suffix)
    else:
        df = df.withColumns({n: normalize_key(f) for f, n in zip(fields, normed)})
    return df.withColumns({
        out: F.concat_ws(KEY_SEPARATOR, *[F.col(n) for n in normed]),
        f"{out}_empty": F.greatest(*[F.length(n) for n in normed], F.lit(0)) == 0,
    })


def text_features(df: DataFrame, fields: list[str], out: str = "text") -> DataFrame:
    """``concat_ws(" ", coalesce(x, ""), ...)``."""
    return df.withColumn(out, F.concat_ws(TEXT_SEPARATOR,
                                          *[F.coalesce(F.col(f), F.lit("")) for f in fields]))


def tokenize(c: Column | str, pattern: str = TOKEN_PATTERN) -> Column:
    """every non-overlapping match of ``pattern`` over the whole text."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(col, F.lit(pattern), 0)


def token_set(c: Column | str, pattern: str = TOKEN_PATTERN) -> Column:
    """Distinct tokens in a canonical (sorted) order."""
    return F.sort_array(F.array_distinct(tokenize(c, pattern)))


def digest(c: Column | str) -> Column:
    """Fixed-width join key for long strings (SHA-256 hex)."""
    return F.sha2(F.col(c) if isinstance(c, str) else c, 256)


#: Fixed value: dimension of the hashed features.
NUM_FEATURES = 512


def hashing_tf(df: DataFrame, tokens_col: str, num_features: int = NUM_FEATURES,
               indices: str = "indices", counts: str = "counts") -> DataFrame:
    """hashed term counts of each row as a sparse vector: ``indices``
    (ascending) and how many tokens fall on each. A token's index is the first
    28 bits of its md5 modulo ``num_features``, the same in any engine. Null or
    empty token lists give empty arrays, null tokens count as none.

    Without a shuffle, linear in the tokens: the sorted indices of a row are
    cut where they change."""
    low = {c.lower() for c in df.columns}
    own, at = (next(n for n in (f"{'_' * k}{x}" for k in range(1, 99)) if n not in low) for x in ("sorted", "starts"))
    index = F.transform(F.filter(tokens_col, lambda t: t.isNotNull()),
                        lambda t: (F.conv(F.substring(F.md5(t), 1, 7), 16, 10).cast("long") % num_features).cast("int"))
    df = df.withColumn(own, F.coalesce(F.array_sort(index), F.array().cast("array<int>")))
    starts = F.filter(F.transform(own, lambda x, k: F.when((k == 0) | (F.get(F.col(own), k - 1) != x), k)), lambda k: k.isNotNull())
    df = df.withColumn(at, starts)
    ends = F.concat(F.slice(at, 2, F.greatest(F.size(at) - 1, F.lit(0))), F.array(F.size(own)))
    return df.withColumns({
        indices: F.transform(at, lambda k: F.get(F.col(own), k)),
        counts: F.zip_with(F.slice(ends, 1, F.size(at)), at, lambda e, b: (e - b).cast("long"))}).drop(own, at)
