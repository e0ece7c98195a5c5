"""Partitioned JDBC read options and the high-watermark extract.

The options builder validates the sub-query and returns the dict a
``spark.read.format("jdbc").options(**opts)`` call takes: Spark splits the
read into ``numPartitions`` range queries on ``partitionColumn`` and each
executor fetches ``fetchsize`` rows per round trip. The watermark filter is
pushed to the source inside the sub-query.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import list_partition_dirs
from .sinks import partition_overwrite

# The reference's read defaults.
FETCH_SIZE = 1000
LOWER_BOUND = "1"
UPPER_BOUND = "10000"
NUM_PARTITIONS = 4


def jdbc_options(url: str, user: str | None, password: str | None, subquery: str | None,
                 partition_column: str, fetch_size: int = FETCH_SIZE,
                 lower_bound: str | int = LOWER_BOUND, upper_bound: str | int = UPPER_BOUND,
                 num_partitions: int = NUM_PARTITIONS) -> dict[str, str]:
    """Options for a chunked, parallel JDBC read."""
    if subquery is None:
        raise ValueError("subquery cannot be None")
    if not isinstance(subquery, str) or not subquery.strip():
        raise ValueError("subquery must be a non-empty string")
    opts = {
        "url": url,
        "dbtable": subquery,
        "fetchsize": str(fetch_size),
        "partitionColumn": partition_column,
        "lowerBound": str(lower_bound),
        "upperBound": str(upper_bound),
        "numPartitions": str(num_partitions),
    }
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    return opts


def watermark_subquery(table: str, column: str, watermark: _dt.date | str, alias: str = "src") -> str:
    """``(SELECT * FROM t WHERE col > DATE 'wm') src`` for ``dbtable``."""
    wm = watermark.isoformat() if isinstance(watermark, _dt.date) else str(watermark)
    _dt.date.fromisoformat(wm[:10])  # reject anything that is not a date
    return f"(SELECT * FROM {table} WHERE {column} > DATE '{wm[:10]}') {alias}"


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def watermark_filter(df: DataFrame, column: str, watermark: _dt.date | str) -> DataFrame:
    """S5 for file/table sources: rows strictly after the high-water mark.

    On Parquet the comparison reaches the scan as a pushed filter, so row
    groups whose max is at or below the mark are skipped.
    """
    wm = watermark.isoformat() if isinstance(watermark, _dt.date) else str(watermark)
    return df.filter(F.col(column) > F.lit(wm).cast(df.schema[column].dataType))


def next_watermark(df: DataFrame, column: str):
    """The mark to store after a successful load (``max(column)``)."""
    return df.agg(F.max(column)).first()[0]


#: The name Spark gives the folder of a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def loaded_watermark(spark: SparkSession, path: str, part_col: str, lookback: int = 0) -> str | None:
    """The partition value to load from: the highest that the target's folders
    bear, or the one ``lookback`` folders below it. No file is opened; a target
    that is not there, or holds only the null partition, has none."""
    names = [p.split("=", 1)[1] for p in list_partition_dirs(spark, path, [part_col])]
    values = sorted(n for n in names if n != NULL_PARTITION)
    return values[max(0, len(values) - 1 - lookback)] if values else None


def incremental_load(spark: SparkSession, source: DataFrame, path: str, date_col: str, part_col: str = "ingest_date",
                     part_format: str = "yyyy-MM-dd", lookback: int = 0) -> str | None:
    """S5 + S12: extract what is new since the last load, and overwrite the
    partitions it falls into.

    The table is partitioned by ``date_col`` written in ``part_format``
    (``yyyy``, ``yyyy-MM`` or ``yyyy-MM-dd``, whose order as text is that of
    time). The mark is read from the target's folders, so nothing is stored
    beside the data that could disagree with it. The extract begins at the
    mark's partition, not after it, since that one may have been loaded before
    it was complete, and ``lookback`` partitions earlier for rows that arrive
    late; every partition it touches is replaced by all that the source has of
    it. A rerun therefore changes nothing, and a load cut short is put right by
    the next. Rows older than the lookback reach a partition loaded already
    only by a load with a larger one. Rows without a date form a partition
    that every load replaces if the source has any. The lower bound reaches a
    Parquet or JDBC source as a pushed filter. Returns the mark that was used
    (None: a full load)."""
    if part_format not in ("yyyy", "yyyy-MM", "yyyy-MM-dd"):
        raise ValueError(f"{part_format}: its order as text must be that of time")
    mark = loaded_watermark(spark, path, part_col, lookback)
    rows = source
    if mark is not None:
        day = _dt.date(*[int(x) for x in (mark.split("-") + ["1", "1"])[:3]]).isoformat()
        at = F.col(date_col)
        rows = source.filter(at.isNull() | (at >= F.lit(day).cast(source.schema[date_col].dataType)))
    partition_overwrite(rows.withColumn(part_col, F.date_format(date_col, part_format)), path, part_col)
    return mark
