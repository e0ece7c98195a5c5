"""File sources: versioned CSV snapshots, audit-log JSON under a projected
path template, hourly flow-log Parquet, query-log JSON (S1-S3, S8-S11).

Readers take an explicit schema wherever one is known: ``inferSchema`` is
an extra full pass over the input and narrows 64-bit keys to int.
"""

from __future__ import annotations

import datetime as _dt
import itertools

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def versioned_path(base: str, version: str) -> str:
    """S1 naming: ``{base}_{version}.csv``."""
    return f"{base}_{version}.csv"


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None,
             infer: bool = False) -> DataFrame:
    """Header CSV; explicit ``schema`` preferred, else inference or strings."""
    r = spark.read.option("header", "true").option("encoding", "UTF-8")
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", "true")
    return r.csv(path)


def read_versioned_csv(spark: SparkSession, base: str, version: str,
                       schema: StructType | str | None = None, infer: bool = False) -> DataFrame:
    """One version of a snapshot series."""
    return read_csv(spark, versioned_path(base, version), schema, infer)


def read_nav_csv(spark: SparkSession, path: str, date_col: str = "base_date",
                 date_format: str = "yyyy-MM-dd", value_col: str = "nav_price",
                 value_type: str = "decimal(18,4)") -> DataFrame:
    """S2 + F8: NAV rows with the date parsed and the price as decimal.

    Text that is not a date / a number becomes null (``try_to_date``,
    ``try_cast``) instead of failing the load under ANSI mode.
    """
    df = read_csv(spark, path)
    return df.withColumns({
        date_col: F.expr(f"try_to_date(`{date_col}`, '{date_format}')"),
        value_col: F.expr(f"try_cast(`{value_col}` as {value_type})"),
    })


def with_line_numbers(df: DataFrame, col: str = "line", header_lines: int = 1) -> DataFrame:
    """1-based line number of each row within its source file (F14 cell rows).

    A window per file would sort a hot file in one task, so this is the
    distributed zip-with-index instead: rows are counted per (file, read
    partition) chunk -- one row per chunk --, chunk offsets are prefix sums
    over that small table in partition order, and each row adds its index
    inside the chunk. It relies on Spark reading one file's splits in offset
    order, and each split's rows in file order; both ids are recomputed
    identically on a retry because the splits are fixed by the input.
    Use on a plain scan (before any shuffle).
    """
    from pyspark.sql import Window

    d = df.withColumns({"_f": F.col("_metadata.file_path"), "_p": F.spark_partition_id(),
                        "_m": F.monotonically_increasing_id()})
    chunks = d.groupBy("_f", "_p").agg(F.min("_m").alias("_m0"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_f").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    line = F.col("_off") + (F.col("_m") - F.col("_m0")) + F.lit(1 + header_lines)
    return (d.join(chunks.select("_f", "_p", "_m0", "_off"), ["_f", "_p"])
            .withColumn(col, line).drop("_f", "_p", "_m", "_m0", "_off"))


# ---------------------------------------------------------------- audit log

# The audit-log partition projection.
AUDIT_REGIONS = ("ap-northeast-1", "us-east-1", "us-west-2", "eu-west-1")
AUDIT_YEARS = (2020, 2030)
AUDIT_TEMPLATE = "{root}/{region}/{year:04d}/{month:02d}/{day:02d}"
AUDIT_PATH_RE = r"/([a-z]+-[a-z]+-[0-9])/([0-9]{4})/([0-9]{2})/([0-9]{2})/[^/]*$"

# The field names and types of audit events.
AUDIT_SCHEMA = (
    "eventversion string, "
    "useridentity struct<type:string,principalid:string,arn:string,accountid:string,"
    "invokedby:string,accesskeyid:string,userName:string,"
    "sessioncontext:struct<attributes:struct<mfaauthenticated:string,creationdate:string>,"
    "sessionissuer:struct<type:string,principalId:string,arn:string,accountId:string,userName:string>>>, "
    "eventtime string, eventsource string, eventname string, awsregion string, "
    "sourceipaddress string, useragent string, errorcode string, errormessage string, "
    "requestparameters string, responseelements string, additionaleventdata string, "
    "requestid string, eventid string, "
    "resources array<struct<accountid:string,type:string,arn:string>>, "
    "eventtype string, apiversion string, readonly string, recipientaccountid string, "
    "serviceeventdetails string, sharedeventid string, vpcendpointid string"
)


def projected_paths(root: str, regions: list[str] | tuple[str, ...] = AUDIT_REGIONS,
                    start: _dt.date | None = None, end: _dt.date | None = None,
                    years: tuple[int, int] = AUDIT_YEARS) -> list[str]:
    """The partition folders a predicate selects, without listing storage.

    Enumerates region x day from the projection ranges, restricted to
    ``start..end``; the list is bounded by the predicate, not by the data.
    """
    first, last = _dt.date(years[0], 1, 1), _dt.date(years[1], 12, 31)
    lo, hi = start or first, end or last
    if lo < first or hi > last:
        raise ValueError(f"{lo}..{hi} leaves the projected years {years[0]}..{years[1]}")
    days = [lo + _dt.timedelta(days=i) for i in range((hi - lo).days + 1)]
    return [AUDIT_TEMPLATE.format(root=root.rstrip("/"), region=r, year=d.year, month=d.month, day=d.day)
            for r, d in itertools.product(regions, days)]


def with_template_partitions(df: DataFrame) -> DataFrame:
    """Partition columns from the file path (the layout is not ``key=value``)."""
    p = F.col("_metadata.file_path")
    return df.withColumns({
        "region": F.regexp_extract(p, AUDIT_PATH_RE, 1),
        "year": F.regexp_extract(p, AUDIT_PATH_RE, 2),
        "month": F.regexp_extract(p, AUDIT_PATH_RE, 3),
        "day": F.regexp_extract(p, AUDIT_PATH_RE, 4),
    })


def projected_glob(root: str, regions: list[str] | tuple[str, ...] = AUDIT_REGIONS,
                   start: _dt.date | None = None, end: _dt.date | None = None,
                   years: tuple[int, int] = AUDIT_YEARS) -> str:
    """S9 as one pattern: whole years and months of ``start..end`` by their own
    folder, the rest by days. It names at most the years, 22 months and 60
    days, whatever the range."""
    first, last = _dt.date(years[0], 1, 1), _dt.date(years[1], 12, 31)
    lo, hi = start or first, end or last
    if lo < first or hi > last:
        raise ValueError(f"{lo}..{hi} leaves the projected years {years[0]}..{years[1]}")
    parts, day = [], lo
    while day <= hi:
        year_end = _dt.date(day.year, 12, 31)
        month_end = (day.replace(day=28) + _dt.timedelta(days=4)).replace(day=1) - _dt.timedelta(days=1)
        if (day.month, day.day) == (1, 1) and year_end <= hi:
            parts, day = [*parts, f"{day:%Y}"], year_end
        elif day.day == 1 and month_end <= hi:
            parts, day = [*parts, f"{day:%Y/%m}"], month_end
        else:
            parts.append(f"{day:%Y/%m/%d}")
        day += _dt.timedelta(days=1)
    return f"{root.rstrip('/')}/{{{','.join(regions)}}}/{{{','.join(parts)}}}" if parts and regions else ""


def read_audit_log(spark: SparkSession, root: str, regions=AUDIT_REGIONS,
                   start: _dt.date | None = None, end: _dt.date | None = None) -> DataFrame:
    """S8 + S9: gzip JSON audit events from the projected folders.

    Spark gets the projection as one pattern and lists what lies under the
    folders it names, in parallel; folders that storage lacks are skipped. Only
    files right in a day folder of the template are read. Without any: no rows.
    """
    glob = projected_glob(root, regions, start, end)
    none = spark.createDataFrame([], AUDIT_SCHEMA + ", region string, year string, month string, day string")
    if not glob:
        return none
    try:
        df = spark.read.schema(AUDIT_SCHEMA).option("recursiveFileLookup", "true").json(glob)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return none
        raise
    return with_template_partitions(df.filter(F.col("_metadata.file_path").rlike(AUDIT_PATH_RE)))


def audit_flat(df: DataFrame) -> DataFrame:
    """Nested fields out of the struct, one row per resource."""
    return df.select(
        "eventid", "eventtime", "eventname", "awsregion",
        F.col("useridentity.type").alias("identity_type"),
        F.col("useridentity.principalid").alias("principal_id"),
        F.col("useridentity.sessioncontext.sessionissuer.userName").alias("issuer_user"),
        F.col("useridentity.sessioncontext.attributes.mfaauthenticated").alias("mfa"),
        "region", "year", "month", "day",
        F.explode_outer("resources").alias("res"),
    ).select("*", F.col("res.arn").alias("resource_arn"),
             F.col("res.type").alias("resource_type")).drop("res")


# ---------------------------------------------------------------- flow log

# The field names and types of flow logs.
FLOW_LOG_SCHEMA = (
    "version int, `account-id` string, `interface-id` string, srcaddr string, "
    "dstaddr string, srcport int, dstport int, protocol int, packets bigint, "
    "bytes bigint, start bigint, `end` bigint, action string, `log-status` string"
)
FLOW_PARTITIONS = ("year", "month", "day", "hour")


def read_flow_logs(spark: SparkSession, root: str) -> DataFrame:
    """Hourly hive-style Parquet; filters on year/month/day/hour prune folders."""
    return (spark.read.option("basePath", root)
            .schema(FLOW_LOG_SCHEMA + ", year string, month string, day string, hour string")
            .parquet(root))


# ---------------------------------------------------------------- query log

# The field names of batch query-execution documents.
QUERY_LOG_SCHEMA = (
    "QueryExecutions array<struct<QueryExecutionId:string,Query:string,"
    "Status:struct<SubmissionDateTime:string>>>"
)


def read_query_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Batch-get style JSON documents (one per line)."""
    return spark.read.schema(QUERY_LOG_SCHEMA).json(path)
