"""Table-usage report from a query log.

Log rows -> explode every FROM/JOIN reference -> distinct (query, table,
day) -> count per (table, day). Both aggregates combine map-side; the only
wide dependency per step is on the small (table, day) key space. Unlike a
one-match-per-query extraction, every reference in a query is counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sqlrefs import iso_day, keep_ref, normalize_ref, table_refs

# Fixed value: default newest-N query window of the report.
DEFAULT_RECENT = 1000


def flatten_query_log(log: DataFrame, keep_null: bool = False) -> DataFrame:
    """``QueryExecutions`` array -> (qid, submitted, query).

    Executions without query text are dropped unless ``keep_null`` (they
    still count towards a newest-N window taken before extraction).
    """
    q = log.select(F.explode("QueryExecutions").alias("q"))
    out = q.select(F.col("q.QueryExecutionId").alias("qid"),
                   F.col("q.Status.SubmissionDateTime").alias("submitted"),
                   F.col("q.Query").alias("query"))
    return out if keep_null else out.filter(F.col("query").isNotNull())


def query_table_refs(queries: DataFrame, qid: str = "qid", submitted: str = "submitted",
                     query: str = "query") -> DataFrame:
    """Distinct (qid, tbl, day) references (A3)."""
    raw = (queries.filter(F.col(query).isNotNull())
           .select(F.col(qid).alias("qid"), iso_day(submitted).alias("day"),
                   F.explode(table_refs(query)).alias("raw")))
    return (raw.filter(keep_ref(F.col("raw")))
            .select("qid", normalize_ref(F.col("raw")).alias("tbl"), "day")
            .distinct())


def table_refs_daily(queries: DataFrame, **kw) -> DataFrame:
    """A4 + O1: references per (table, day), most used first, ties by name, day."""
    refs = query_table_refs(queries, **kw)
    return (refs.groupBy("tbl", "day").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "tbl", "day"))


def newest_queries(queries: DataFrame, n: int = DEFAULT_RECENT, submitted: str = "submitted",
                   qid: str = "qid") -> DataFrame:
    """O3: the ``n`` most recent queries (ties by id, descending).

    ``orderBy().limit()`` plans as a TakeOrderedAndProject: each task keeps
    its own top ``n`` and only those reach the final merge.
    """
    return queries.orderBy(F.desc(submitted), F.desc(qid)).limit(n)
