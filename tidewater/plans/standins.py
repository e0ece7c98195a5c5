"""Inputs for the driver catalogue, derived by Spark from the driver tables.

The reference works on fund masters, NAV files and service logs; the
driver gives TPC-H-like tables. Each builder here re-points one input
shape at a driver table, in full, so the work grows with the table.
Every expression has a twin in :mod:`tidewater.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import det_key
from ..session import ensure_utc, list_partition_dirs, rename_path, scratch_path
from ..sources.files import AUDIT_REGIONS, AUDIT_TEMPLATE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- documents as two masters

def documents(spark: SparkSession, sf_dir: str, cols: list[str] | None = None) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(*cols) if cols else d


def is_current(source: Column) -> Column:
    """Documents are split in two by source: an even source number is current,
    anything else (odd, or no number at all) legacy."""
    return F.coalesce(F.substring(source, 4, 16).try_cast("int") % 2 == 0, F.lit(False))


def doc_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(current, legacy) documents with ``det_key`` over the text."""
    d = documents(spark, sf_dir, ["doc_id", "text", "source", "n_chars"])
    d = det_key(d, ["text"])
    cur = d.filter(is_current(F.col("source")))
    leg = d.filter(~is_current(F.col("source")))
    return cur, leg


# ---------------------------------------------------------------- part as a legacy master CSV

# Header order of the legacy file (position 9 = strategy code).
LEGACY_HEADERS = ["fund_id", "投資信託_分類", "信託報酬_率", "有効レコード", "ファンド名",
                  "愛称", "運用会社", "隠れコスト", "内部戦略コード"]


def _two_dp(x: Column) -> Column:
    """Integer hundredths -> 'i.ff' text, exact in both engines."""
    return F.concat((x / 100).cast("long").cast("string"), F.lit("."),
                    F.lpad((x % 100).cast("string"), 2, "0"))


def legacy_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        p.p_partkey.cast("string").alias("fund_id"),
        F.when(p.p_size < 25, "INDEX").otherwise("ACTIVE").alias("投資信託_分類"),
        _two_dp(p.p_size).alias("信託報酬_率"),
        F.when(p.p_size % 3 == 0, "True").when(p.p_size % 3 == 1, "False")
         .otherwise("unknown").alias("有効レコード"),
        p.p_name.alias("ファンド名"),
        p.p_type.alias("愛称"),
        p.p_brand.alias("運用会社"),
        _two_dp(p.p_partkey % 1000).alias("隠れコスト"),
        F.concat(F.lit("STRAT-"), F.upper(F.substring(p.p_type, 1, 3)), F.lit("-"),
                 F.lpad((p.p_partkey % 100).cast("string"), 2, "0")).alias("内部戦略コード"),
    )


def export_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", "true").csv(path)
    return path


def legacy_csv(spark: SparkSession, sf_dir: str) -> str:
    base = scratch_path(spark, "legacy_fund_master")
    return export_csv(legacy_rows(spark, sf_dir), f"{base}.csv")


LEGACY_CSV_SCHEMA = ", ".join(f"`{c}` string" for c in LEGACY_HEADERS)


def legacy_csv_buckets(spark: SparkSession, sf_dir: str) -> str:
    """The legacy rows as one CSV file per eighth of the keys, in key order."""
    rows = legacy_rows(spark, sf_dir).withColumn("n", F.col("fund_id").cast("long"))
    root = scratch_path(spark, "legacy_buckets")
    (rows.withColumn("bucket", F.col("n") % 8).repartition("bucket").sortWithinPartitions("bucket", "n").drop("n")
     .write.partitionBy("bucket").option("header", "true").csv(root))
    return root


# ---------------------------------------------------------------- orders as NAV / snapshots

def nav_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(o.o_custkey.cast("string").alias("fund_id"),
                    F.date_format(o.o_orderdate, "yyyy-MM-dd").alias("base_date"),
                    o.o_totalprice.cast("string").alias("nav_price"))


def orders_by_month(spark: SparkSession, sf_dir: str, load_id: int) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.withColumns({"o_month": F.date_format("o_orderdate", "yyyy-MM"),
                          "load_id": F.lit(load_id)})


RELOAD_FROM = "1998-01-01"


def reload_slice(df: DataFrame) -> DataFrame:
    """The months a second load re-delivers."""
    return df.filter(F.col("o_orderdate") >= F.lit(RELOAD_FROM).cast("timestamp"))


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice",
                    F.to_date("o_orderdate").alias("base_date"))


# ---------------------------------------------------------------- events as logs

def query_text(e: DataFrame) -> Column:
    u = e.user_id
    return (F.when(e.event_type == "view", F.concat(
                F.lit('SELECT * FROM "Sales".orders_'), (u % 5).cast("string"),
                F.lit(" o JOIN `lake`.`gold`.dim_"), (u % 3).cast("string"),
                F.lit(" d ON o.k = d.k JOIN sales.orders_"), (u % 5).cast("string"),
                F.lit(" o2 ON o2.k = o.k")))
            .when(e.event_type == "click", F.lit(
                "select count(*) from information_schema.tables t join web.clicks c on t.x = c.x"))
            .when(e.event_type == "purchase", F.concat(
                F.lit("SELECT x FROM unnest(array[1,2]) AS u(x) JOIN (SELECT 1 FROM shop.purchases_"),
                (u % 3).cast("string"), F.lit(") p ON true")))
            .when(e.event_type == "signup", F.concat(
                F.lit('WITH a AS (SELECT 1) SELECT * FROM a JOIN json_table(doc) j ON 1=1 '
                      'JOIN "crm"."users" u ON u.id = '), u.cast("string")))
            .otherwise(F.lit(None).cast("string")))


def query_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.concat(F.lit("q"), e.event_id.cast("string")).alias("qid"),
                    F.date_format(e.ts, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("submitted"),
                    query_text(e).alias("query"), e.event_id)


def write_query_log(spark: SparkSession, sf_dir: str) -> str:
    """The log as batch-get JSON documents of up to 50 executions each."""
    rows = query_log_rows(spark, sf_dir)
    docs = (rows.groupBy((F.col("event_id") / 50).cast("long").alias("batch"))
            .agg(F.collect_list(F.struct(
                F.col("qid").alias("QueryExecutionId"), F.col("query").alias("Query"),
                F.struct(F.col("submitted").alias("SubmissionDateTime")).alias("Status")))
                .alias("QueryExecutions"))
            .drop("batch"))
    path = scratch_path(spark, "query_log")
    docs.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    regions = F.array(*[F.lit(r) for r in AUDIT_REGIONS])
    region = F.element_at(regions, (e.user_id % 4 + 1).cast("int"))
    acct = F.lit("123456789012")
    res1 = F.struct(acct.alias("accountid"), F.lit("AWS::S3::Object").alias("type"),
                    F.concat(F.lit("arn:aws:s3:::data/"), e.event_id.cast("string")).alias("arn"))
    res2 = F.struct(acct.alias("accountid"), F.lit("AWS::KMS::Key").alias("type"),
                    F.concat(F.lit("arn:aws:kms:key/"), e.user_id.cast("string")).alias("arn"))
    resources = (F.when(e.event_type == "error", F.lit(None))
                 .when(e.value > 20, F.array(res1, res2)).otherwise(F.array(res1)))
    ident = F.struct(
        F.lit("IAMUser").alias("type"), e.user_id.cast("string").alias("principalid"),
        F.concat(F.lit("arn:aws:iam::123456789012:user/u"), e.user_id.cast("string")).alias("arn"),
        acct.alias("accountid"), F.lit(None).cast("string").alias("invokedby"),
        F.lit(None).cast("string").alias("accesskeyid"),
        F.concat(F.lit("u"), e.user_id.cast("string")).alias("userName"),
        F.struct(
            F.struct(F.when(e.user_id % 2 == 0, "true").otherwise("false").alias("mfaauthenticated"),
                     F.date_format(e.ts, "yyyy-MM-dd'T'00:00:00'Z'").alias("creationdate"))
            .alias("attributes"),
            F.struct(F.lit("Role").alias("type"), F.lit("ROLE1").alias("principalId"),
                     F.lit("arn:aws:iam::123456789012:role/r").alias("arn"), acct.alias("accountId"),
                     F.concat(F.lit("role-"), e.event_type).alias("userName"))
            .alias("sessionissuer")).alias("sessioncontext"))
    return e.select(
        F.lit("1.08").alias("eventversion"), ident.alias("useridentity"),
        F.date_format(e.ts, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("eventtime"),
        F.lit("s3.amazonaws.com").alias("eventsource"), e.event_type.alias("eventname"),
        region.alias("awsregion"), e.props.alias("requestparameters"),
        e.event_id.cast("string").alias("eventid"), resources.alias("resources"),
        region.alias("region"), F.date_format(e.ts, "yyyy").alias("year"),
        F.date_format(e.ts, "MM").alias("month"), F.date_format(e.ts, "dd").alias("day"))


def write_audit_log(spark: SparkSession, sf_dir: str) -> str:
    """gzip JSON laid out as ``root/{region}/{yyyy}/{MM}/{dd}/`` (not key=value).

    One partitioned write, then one directory rename per (region, day):
    the rename count is bounded by the calendar, not by the rows.
    """
    root = scratch_path(spark, "audit")
    staging = root + "__kv"
    df = audit_rows(spark, sf_dir)
    (df.hint("rebalance", "region", "year", "month", "day")
     .write.mode("overwrite").option("compression", "gzip")
     .partitionBy("region", "year", "month", "day").json(staging))
    for kv in list_partition_dirs(spark, staging, ["region", "year", "month", "day"]):
        vals = [seg.split("=", 1)[1] for seg in kv.split("/")]
        dst = AUDIT_TEMPLATE.format(root=root, region=vals[0], year=int(vals[1]),
                                    month=int(vals[2]), day=int(vals[3]))
        rename_path(spark, f"{staging}/{kv}", dst)
    return root


def flow_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    start = F.unix_timestamp(e.ts)
    return e.select(
        F.lit(2).alias("version"), F.lit("123456789012").alias("account-id"),
        F.concat(F.lit("eni-"), (e.user_id % 50).cast("string")).alias("interface-id"),
        F.concat(F.lit("10.0."), (e.user_id % 256).cast("string"), F.lit("."),
                 (e.event_id % 256).cast("string")).alias("srcaddr"),
        F.lit("10.1.0.1").alias("dstaddr"),
        (F.lit(1024) + e.event_id % 50000).cast("int").alias("srcport"),
        F.lit(443).alias("dstport"), F.lit(6).alias("protocol"),
        F.get_json_object(e.props, "$.k").try_cast("bigint").alias("packets"),
        F.round(e.value * 100, 0).cast("bigint").alias("bytes"),
        start.alias("start"), (start + 60).alias("end"),
        F.when(e.event_type == "error", "REJECT").otherwise("ACCEPT").alias("action"),
        F.lit("OK").alias("log-status"),
        F.date_format(e.ts, "yyyy").alias("year"), F.date_format(e.ts, "MM").alias("month"),
        F.date_format(e.ts, "dd").alias("day"), F.date_format(e.ts, "HH").alias("hour"))


def write_flow_logs(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "flowlogs")
    (flow_rows(spark, sf_dir).hint("rebalance", "year", "month", "day", "hour")
     .write.mode("overwrite").partitionBy("year", "month", "day", "hour").parquet(root))
    return root
