"""Driver query catalogue: one Spark plan per operator of the inventory.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs an operator over the
whole driver tables (see :mod:`tidewater.plans.standins` for how each
input shape is re-pointed). The matching DuckDB SQL lives next to it in
:mod:`tidewater.plans.oracle`; column names agree one to one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.text import hashing_tf, normalize_key, text_features, tokenize
from ..operators import dims, match, scan, usage
from ..session import delete_path, scratch_path
from ..sources import files, jdbc, sinks
from . import standins as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed parameters of the catalogue.
JACCARD_MAX_DISTANCE = 0.5
LSH_BANDS, LSH_ROWS = match.LSH_BANDS, match.LSH_ROWS
INGEST_DAY = "2025-07-01"
SNAPSHOT_DAYS = ("2025-06-30", "2025-07-01")
WATERMARK = "1998-08-01"
FIRST_LOAD_MONTH = "1998-04"
PROJECTION_REGIONS = ("us-east-1", "eu-west-1")
PROJECTION_DAYS = ("2024-01-05", "2024-01-12")
FLOW_HOURS = ("09", "17")


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- scans

@query("scan_csv")
def q_scan_csv(spark, d):
    orders = S.table(spark, d, "orders")
    base = scratch_path(spark, "orders")
    S.export_csv(orders, files.versioned_path(base, "v1"))
    return files.read_versioned_csv(spark, base, "v1", schema=orders.schema)


@query("scan_nav_csv")
def q_scan_nav_csv(spark, d):
    path = S.export_csv(S.nav_rows(spark, d), scratch_path(spark, "fund_nav") + "_v1.csv")
    return files.read_nav_csv(spark, path)


def _legacy_raw(spark, d):
    return files.read_csv(spark, S.legacy_csv(spark, d))


@query("scan_legacy_csv")
def q_scan_legacy_csv(spark, d):
    return _legacy_raw(spark, d)


@query("rename_map")
def q_rename_map(spark, d):
    return C.rename_map(_legacy_raw(spark, d))


@query("canonicalize_columns")
def q_canonicalize_columns(spark, d):
    """The rules come from their table."""
    return C.canonicalize_columns(_legacy_raw(spark, d), C.rules_frame(spark))


def _legacy_typed(spark, d):
    df = C.rename_map(_legacy_raw(spark, d))
    df = C.decimal_cast(df, ["trust_fee_rate", "hidden_cost"])
    return df


@query("decimal_cast")
def q_decimal_cast(spark, d):
    return _legacy_typed(spark, d)


@query("bool_normalize")
def q_bool_normalize(spark, d):
    return C.bool_normalize(_legacy_typed(spark, d), ["is_active"])


@query("ingest_snapshot")
def q_ingest_snapshot(spark, d):
    df = C.bool_normalize(_legacy_typed(spark, d), ["is_active"])
    return C.stamp_ingest_date(df, INGEST_DAY)


@query("routed_ingest")
def q_routed_ingest(spark, d):
    """The legacy extract job end to end: scan, rename, casts, stamp, then a
    partition overwrite by ``ingest_date`` into the table the environment
    routes to (a non-main environment gets its own namespace)."""
    df = C.stamp_ingest_date(C.bool_normalize(_legacy_typed(spark, d), ["is_active"]), INGEST_DAY)
    path = sinks.table_path(scratch_path(spark, "lake"), "dev", "legacy_fund_master")
    sinks.partition_overwrite(df, path, "ingest_date", schema="legacy_fund_master")
    sinks.partition_overwrite(df, path, "ingest_date", schema="legacy_fund_master")  # a rerun replaces, never duplicates
    return sinks.read_table(spark, path, "legacy_fund_master")


@query("watermark_extract")
def q_watermark_extract(spark, d):
    return jdbc.watermark_filter(S.table(spark, d, "orders"), "o_orderdate", WATERMARK)


@query("incremental_load")
def q_incremental_load(spark, d):
    """Three loads into one table by month: orders up to a month of which some
    rows are late, then all orders, then again with nothing new."""
    orders = S.table(spark, d, "orders")
    path = scratch_path(spark, "orders_incremental")
    late = (F.date_format("o_orderdate", "yyyy-MM") == FIRST_LOAD_MONTH) & (F.col("o_orderkey") % 7 == 0)
    first = orders.filter((F.date_format("o_orderdate", "yyyy-MM") <= FIRST_LOAD_MONTH) & ~late)
    marks = [jdbc.incremental_load(spark, load, path, "o_orderdate", "o_month", "yyyy-MM") for load in (first, orders, orders)]
    if marks[:2] != [None, FIRST_LOAD_MONTH] or marks[2] <= FIRST_LOAD_MONTH:
        raise RuntimeError(f"unexpected marks: {marks}")
    return sinks.read_partitioned(spark, path, ["o_month"])


# ---------------------------------------------------------------- sinks

def _month_schema(spark, d):
    return S.orders_by_month(spark, d, 1).schema


@query("partition_overwrite")
def q_partition_overwrite(spark, d):
    path = scratch_path(spark, "orders_by_month")
    sinks.partition_overwrite(S.orders_by_month(spark, d, 1), path, "o_month")
    sinks.partition_overwrite(S.reload_slice(S.orders_by_month(spark, d, 2)), path, "o_month")
    return spark.read.schema(_month_schema(spark, d)).parquet(path)


@query("full_overwrite")
def q_full_overwrite(spark, d):
    path = scratch_path(spark, "orders_by_month")
    sinks.partition_overwrite(S.orders_by_month(spark, d, 1), path, "o_month")
    sinks.full_overwrite(S.reload_slice(S.orders_by_month(spark, d, 2)), path, "o_month")
    return spark.read.schema(_month_schema(spark, d)).parquet(path)


@query("replace_table")
def q_replace_table(spark, d):
    path = scratch_path(spark, "orders_table")
    orders = S.orders_by_month(spark, d, 1)
    sinks.replace_table(orders, path)
    monthly = (spark.read.parquet(path).groupBy("o_month")
               .agg(F.count(F.lit(1)).alias("n_orders"),
                    F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")))
    monthly = monthly.checkpoint(eager=True)  # cut the read of the table being replaced
    sinks.replace_table(monthly, path)
    return spark.read.parquet(path)


def _snapshots(spark, d):
    o = S.table(spark, d, "orders")
    v1 = C.stamp_ingest_date(
        o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), SNAPSHOT_DAYS[0])
    v2 = C.stamp_ingest_date(
        S.reload_slice(o).select("o_orderkey", "o_custkey", F.lit("F").alias("o_orderstatus"),
                                 "o_totalprice"), SNAPSHOT_DAYS[1])
    return v1, v2


@query("union_snapshots")
def q_union_snapshots(spark, d):
    v1, v2 = _snapshots(spark, d)
    return v1.unionByName(v2)


@query("latest_snapshot")
def q_latest_snapshot(spark, d):
    v1, v2 = (v.withColumn("load_seq", F.lit(i)) for i, v in enumerate(_snapshots(spark, d)))
    return dims.latest_snapshot(v1.unionByName(v2), ["o_orderkey"], "ingest_date", ["load_seq"]).drop("load_seq")


@query("write_audit_publish")
def q_write_audit_publish(spark, d):
    main, stage = scratch_path(spark, "orders_main"), scratch_path(spark, "orders_stage")
    checks = [sinks.Expectation("key_not_null", F.col("o_orderkey").isNotNull()),
              sinks.Expectation("price_not_negative", F.col("o_totalprice") >= 0)]
    reload = S.reload_slice(S.orders_by_month(spark, d, 2))
    batches = [S.orders_by_month(spark, d, 1),
               reload.withColumn("o_totalprice", -F.col("o_totalprice")),  # rejected; same stage
               reload]
    got = [sinks.write_audit_publish(spark, b, main, stage, "o_month", checks)["published"] for b in batches]
    if got != [1, 0, 1]:
        raise RuntimeError(f"unexpected audit outcome: {got}")
    return spark.read.schema(_month_schema(spark, d)).parquet(main)


@query("compact_partitions")
def q_compact_partitions(spark, d):
    path = scratch_path(spark, "orders_small_files")
    (S.orders_by_month(spark, d, 1).repartition(16).write.mode("overwrite")
     .partitionBy("o_month").parquet(path))
    sinks.compact_partitions(spark, path, "o_month")
    return spark.read.schema(_month_schema(spark, d)).parquet(path)


@query("compact_flow_logs")
def q_compact_flow_logs(spark, d):
    """Flow logs in many small files per hour; after the compaction the hour
    folders still bear their two digits, so text ranges select the same rows."""
    path = scratch_path(spark, "flow_small_files")
    S.flow_rows(spark, d).repartition(4, "srcport").write.partitionBy(*files.FLOW_PARTITIONS).parquet(path)
    sinks.compact_partitions(spark, path, list(files.FLOW_PARTITIONS))
    fl = files.read_flow_logs(spark, path).filter(F.col("hour").between(*FLOW_HOURS))
    return (fl.groupBy("year", "month", "day", "hour")
            .agg(F.count(F.lit(1)).alias("flows"), F.sum("bytes").alias("bytes")))


# ---------------------------------------------------------------- text

@query("normalize_key")
def q_normalize_key(spark, d):
    docs = S.documents(spark, d, ["doc_id", "text"])
    return docs.select("doc_id", F.md5(normalize_key("text")).alias("key_md5"))


def _part_keys(spark, d):
    from ..functions.text import det_key
    p = S.table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return det_key(p, ["p_name", "p_brand", "p_type"], repeated=True)


@query("det_key")
def q_det_key(spark, d):
    return _part_keys(spark, d).select("p_partkey", "det_key")


@query("text_features")
def q_text_features(spark, d):
    k = _part_keys(spark, d)
    return text_features(k, ["p_name_norm", "p_brand_norm", "p_type_norm"]).select("p_partkey", "text")


@query("tokenize")
def q_tokenize(spark, d):
    docs = S.documents(spark, d, ["doc_id", "text"])
    t = tokenize(F.coalesce(F.col("text"), F.lit("")))
    return docs.select("doc_id", t.alias("t")).select(
        "doc_id", F.size("t").cast("long").alias("n_tokens"),
        F.size(F.array_distinct("t")).cast("long").alias("n_distinct"),
        F.md5(F.array_join("t", " ")).alias("tokens_md5"))


@query("hashing_features")
def q_hashing_features(spark, d):
    """Hashed term counts of all documents, as ``index:count`` pairs in order."""
    docs = S.documents(spark, d, ["doc_id", "text"])
    out = hashing_tf(docs.select("doc_id", tokenize("text").alias("tokens")), "tokens")
    pairs = F.zip_with("indices", "counts", lambda i, n: F.concat_ws(":", i, n))
    return out.select("doc_id", F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n).alias("n_tokens"),
                      F.size("indices").cast("long").alias("n_indices"), F.array_join(pairs, " ").alias("features"))


# ---------------------------------------------------------------- matching

@query("exact_match_pairs")
def q_exact_match_pairs(spark, d):
    f = _doc_features(spark, d)
    return match.exact_match_pairs(f.filter("cur"), f.filter("NOT cur"), "doc_id", "doc_id",
                                   key="kd", empty_col="det_key_empty", key_is_digest=True)


@query("unmatched_left")
def q_unmatched_left(spark, d):
    return _remainders(spark, d)[0].select("doc_id")


@query("unmatched_right")
def q_unmatched_right(spark, d):
    return _remainders(spark, d)[1].select("doc_id")


@query("load_counts")
def q_load_counts(spark, d):
    cur, leg = S.doc_sides(spark, d)
    return match.load_counts({"current": cur, "legacy": leg})


def _doc_features(spark, d):
    """One pass over documents: side, key digest, empty flag, token set.

    The NFKC UDF and the tokenizer run once per document; the result is
    written as a Parquet table in the shared checkpoint folder so the
    anti-joins and the similarity join read it instead of re-running them
    (columnar: the key-only reads of the anti-joins skip the token arrays).
    """
    from ..functions.text import det_key, digest, token_set
    from ..session import materialize
    docs = S.documents(spark, d, ["doc_id", "text", "source"])
    f = det_key(docs, ["text"]).select(
        "doc_id", S.is_current(F.col("source")).alias("cur"),
        digest("det_key").alias("kd"), "det_key_empty", token_set("text").alias("toks"))
    return materialize(f, "doc_features", how="parquet")


def _remainders(spark, d):
    f = _doc_features(spark, d)
    cur, leg = f.filter("cur"), f.filter("NOT cur")
    return (match.unmatched(cur, leg, key="kd", empty_col="det_key_empty", key_is_digest=True),
            match.unmatched(leg, cur, key="kd", empty_col="det_key_empty", key_is_digest=True))


def _doc_sets(spark, d):
    """(features, token sets, path of both) of documents for the similarity joins, in one pass.

    Side, key digest, empty flag and the digest of the token set are all that the
    anti-joins and the grouping of copies read; the tokens, one line of text a
    document in a column of their own, are read where they are joined to the sets
    that are left.
    """
    from ..functions.text import det_key, digest, token_set
    docs = S.documents(spark, d, ["doc_id", "text", "source"]).withColumn("toks", token_set("text"))
    path = scratch_path(spark, "doc_digests")
    det_key(docs, ["text"]).select(
        "doc_id", S.is_current(F.col("source")).alias("cur"), digest("det_key").alias("kd"), "det_key_empty",
        F.when(F.size("toks") > 0, match.set_digest("toks")).alias("set_digest"),
        match.pack_tokens("toks").alias("toks")).write.parquet(path, compression="zstd")
    f = spark.read.parquet(path)
    return f.drop("toks"), f.select("set_digest", "toks"), path


def _set_sides(features):
    """Both remainders, as ids and set digests."""
    cur, leg = (features.filter(x).select("doc_id", "kd", "det_key_empty", "set_digest") for x in ("cur", "NOT cur"))
    how = dict(key="kd", empty_col="det_key_empty", key_is_digest=True)
    return match.unmatched(cur, leg, **how), match.unmatched(leg, cur, **how)


def _jaccard(spark, d, found=None):
    """The tables of ``found`` (:func:`_doc_sets`) are deleted once the join has its
    token sets, so a caller reads them before."""
    features, toks, path = found or _doc_sets(spark, d)
    a, b = _set_sides(features)
    return match.jaccard_join(a, b, "doc_id", "doc_id", JACCARD_MAX_DISTANCE, text_col=None,
                              digest_col="set_digest", token_sets=toks, release=lambda: delete_path(spark, path))


@query("jaccard_join")
def q_jaccard_join(spark, d):
    return _jaccard(spark, d)


@query("lsh_similarity_join")
def q_lsh_similarity_join(spark, d):
    features, toks, _ = _doc_sets(spark, d)
    a, b = _set_sides(features)
    return match.lsh_similarity_join(a, b, "doc_id", "doc_id", threshold=JACCARD_MAX_DISTANCE,
                                     num_bands=LSH_BANDS, rows_per_band=LSH_ROWS, text_col=None,
                                     digest_col="set_digest", token_sets=toks)


@query("exact_match_members")
def q_exact_match_members(spark, d):
    f = _doc_features(spark, d)
    return match.exact_match_members(f.filter("cur"), f.filter("NOT cur"), "doc_id", "doc_id",
                                     key="kd", empty_col="det_key_empty", key_is_digest=True)


@query("jaccard_members")
def q_jaccard_members(spark, d):
    a, b = _remainders(spark, d)
    return match.set_members(a, b, "doc_id", "doc_id", text_col=None, tokens_col="toks")


@query("match_job")
def q_match_job(spark, d):
    """The matching job end to end: features from one table, pairs and scores
    written as named tables (S14) and read back by name (S6). The rows behind
    each representative are not written here: ``exact_match_members`` and
    ``jaccard_members`` give them."""
    found = _doc_sets(spark, d)
    cur, leg = found[0].filter("cur"), found[0].filter("NOT cur")
    how = dict(key="kd", empty_col="det_key_empty", key_is_digest=True)
    tag = uuid.uuid4().hex[:8]

    def save(df, name):
        sinks.replace_table(df, scratch_path(spark, name), f"{name}_{tag}")
        return spark.table(f"{name}_{tag}")

    exact = save(match.exact_match_pairs(cur, leg, "doc_id", "doc_id", **how), "exact_pairs")
    similar = save(_jaccard(spark, d, found), "similar_pairs")
    docs = S.table(spark, d, "documents")
    fees = save(match.fee_diff(similar, docs, docs, "doc_id", "doc_id", "n_chars"), "scored_pairs")
    out = (exact.select("v2_id", "lg_id", F.lit("exact").alias("kind"), F.lit(0.0).alias("jaccard_dist"),
                        F.lit(None).cast("long").alias("fee_diff"))
           .unionByName(fees.select("v2_id", "lg_id", F.lit("similar").alias("kind"), "jaccard_dist",
                                     F.col("fee_diff").cast("long").alias("fee_diff"))))
    for name in ("exact_pairs", "similar_pairs", "scored_pairs"):  # the names go, the files of this run stay for the result
        spark.sql(f"DROP TABLE {name}_{tag}")
    return out


@query("fee_diff")
def q_fee_diff(spark, d):
    docs = S.table(spark, d, "documents")
    pairs = _jaccard(spark, d).select("v2_id", "lg_id", "jaccard_dist")
    return match.fee_diff(pairs, docs, docs, "doc_id", "doc_id", "n_chars")


@query("distance_summary")
def q_distance_summary(spark, d):
    return match.distance_summary(_jaccard(spark, d))


@query("match_preview")
def q_match_preview(spark, d):
    return match.match_preview(_jaccard(spark, d), 10)


# ---------------------------------------------------------------- gold

def _daily_nav(spark, d):
    o = S.daily_orders(spark, d)
    return (o.groupBy("o_custkey", "base_date")
            .agg(F.sum(F.col("o_totalprice").cast("decimal(18,4)")).cast("decimal(18,4)").alias("nav")))


def _scd2(spark, d, sk=None):
    daily = dims.daily_last(S.daily_orders(spark, d), "o_custkey", "base_date",
                            ["o_orderpriority"], "o_orderkey")
    return dims.scd2_dimension(daily, "o_custkey", "base_date", ["o_orderpriority"], sk_col=sk)


@query("scd2_dimension")
def q_scd2_dimension(spark, d):
    return _scd2(spark, d)


@query("scd2_refresh")
def q_scd2_refresh(spark, d):
    """Odd days load first, even days arrive late: the refreshed dimension
    must equal the one built from everything at once."""
    daily = dims.daily_last(S.daily_orders(spark, d), "o_custkey", "base_date",
                            ["o_orderpriority"], "o_orderkey")
    first = daily.filter(F.dayofmonth("base_date") % 2 == 1)
    late = daily.filter(F.dayofmonth("base_date") % 2 == 0)
    dim = dims.scd2_dimension(first, "o_custkey", "base_date", ["o_orderpriority"], sk_col=None)
    return dims.scd2_refresh(dim, first, late, "o_custkey", "base_date", ["o_orderpriority"], sk_col=None)


@query("nav_change")
def q_nav_change(spark, d):
    return dims.nav_change(_daily_nav(spark, d), "o_custkey", "base_date", "nav")


@query("dim_date")
def q_dim_date(spark, d):
    return dims.calendar_for(S.table(spark, d, "orders"), "o_orderdate")


@query("fact_performance")
def q_fact_performance(spark, d):
    nav = dims.nav_change(_daily_nav(spark, d), "o_custkey", "base_date", "nav")
    cal = dims.calendar_for(S.table(spark, d, "orders"), "o_orderdate")
    return dims.fact_performance(nav, _scd2(spark, d), cal, "o_custkey", "base_date",
                                 carry=["o_orderpriority"])


def _gold(spark, d):
    """Two loads of prices: all days, then the days from 1998 again, one lower;
    the master is the priority of each customer's newest order of a day."""
    o = S.daily_orders(spark, d)
    master = o.select("o_custkey", F.col("base_date").alias("ingest_date"), "o_orderpriority",
                      F.col("o_orderkey").alias("load_seq"))
    day = F.col("base_date")
    first = _daily_nav(spark, d).select("*", F.lit(SNAPSHOT_DAYS[0]).cast("date").alias("ingest_date"),
                                        F.lit(1).alias("load_seq"))
    again = first.filter(day >= F.lit(S.RELOAD_FROM).cast("date")).select(
        "o_custkey", "base_date", (F.col("nav") - 1).cast("decimal(18,4)").alias("nav"),
        F.lit(SNAPSHOT_DAYS[1]).cast("date").alias("ingest_date"), F.lit(2).alias("load_seq"))
    return dims.build_gold(master, first.unionByName(again), id_col="o_custkey", value_col="nav",
                           attrs=["o_orderpriority"])


@query("gold_dim_fund")
def q_gold_dim_fund(spark, d):
    dim = _gold(spark, d)["dim_fund"]
    dims.assert_unique(dim, "fund_sk")
    return dim


@query("gold_fact")
def q_gold_fact(spark, d):
    return _gold(spark, d)["fact"]


@query("daily_wide")
def q_daily_wide(spark, d):
    cust = S.table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "c_nationkey")
    return dims.daily_wide(_daily_nav(spark, d), cust, "o_custkey")


# ---------------------------------------------------------------- logs

def _query_log(spark, d, keep_null=False):
    raw = files.read_query_log(spark, S.write_query_log(spark, d))
    return usage.flatten_query_log(raw, keep_null=keep_null)


@query("table_refs_daily")
def q_table_refs_daily(spark, d):
    return usage.table_refs_daily(_query_log(spark, d))


@query("table_refs_recent")
def q_table_refs_recent(spark, d):
    recent = usage.newest_queries(_query_log(spark, d, keep_null=True), usage.DEFAULT_RECENT)
    return usage.table_refs_daily(recent)


@query("audit_log_scan")
def q_audit_log_scan(spark, d):
    root = S.write_audit_log(spark, d)
    return files.audit_flat(files.read_audit_log(spark, root))


@query("partition_projection")
def q_partition_projection(spark, d):
    import datetime as dt
    root = S.write_audit_log(spark, d)
    df = files.read_audit_log(spark, root, regions=PROJECTION_REGIONS,
                              start=dt.date.fromisoformat(PROJECTION_DAYS[0]),
                              end=dt.date.fromisoformat(PROJECTION_DAYS[1]))
    return files.audit_flat(df)


@query("flow_log_scan")
def q_flow_log_scan(spark, d):
    fl = files.read_flow_logs(spark, S.write_flow_logs(spark, d))
    fl = fl.filter(F.col("hour").between(*FLOW_HOURS))
    return (fl.groupBy("year", "month", "day", "action")
            .agg(F.count(F.lit(1)).alias("flows"), F.sum("packets").alias("packets"),
                 F.sum("bytes").alias("bytes")))


# ---------------------------------------------------------------- sensitive scan

def _doc_cells(spark, d):
    docs = scan.in_scope(S.table(spark, d, "documents"), ["documents"], root=d)
    return scan.scan_cells(docs, "doc_id", object_name="documents")


@query("sensitive_scan")
def q_sensitive_scan(spark, d):
    return _doc_cells(spark, d)


@query("sensitive_findings")
def q_sensitive_findings(spark, d):
    legacy = _legacy_raw(spark, d)
    lc = scan.scan_cells(legacy, "fund_id", object_name="legacy_fund_master")
    return scan.findings(_doc_cells(spark, d).unionByName(lc))


@query("sensitive_totals")
def q_sensitive_totals(spark, d):
    lc = scan.scan_cells(_legacy_raw(spark, d), "fund_id", object_name="legacy_fund_master")
    return scan.object_totals(scan.findings(_doc_cells(spark, d).unionByName(lc)))


@query("sensitive_lines")
def q_sensitive_lines(spark, d):
    """Cell findings of the legacy CSV by line number: one file per bucket,
    objects sampled as a whole by their key."""
    root = S.legacy_csv_buckets(spark, d)
    raw = files.with_line_numbers(files.read_csv(spark, root, schema=S.LEGACY_CSV_SCHEMA)
                                  .withColumn("object", F.regexp_extract(scan.object_key(root), "^([^/]*)/", 1)))
    raw = scan.hash_sample(raw, "object")
    cells = scan.scan_cells(raw, "line", S.LEGACY_HEADERS, object_name=F.col("object"))
    return cells.select("object", F.col("row").cast("long").alias("line"), "column", "columnName", "detector", "hits")


@query("finding_documents")
def q_finding_documents(spark, d):
    """Nested findings of all documents and of the legacy CSV; the ordered cell
    positions of a chunk as JSON."""
    lc = scan.scan_cells(_legacy_raw(spark, d), "fund_id", object_name="legacy_fund_master")
    out = scan.finding_documents(_doc_cells(spark, d).unionByName(lc))
    return out.withColumns({"cells": F.to_json("cells"), "n_cells": F.size("cells").cast("long")})


@query("hash_sample")
def q_hash_sample(spark, d):
    docs = S.table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars")
    return scan.hash_sample(docs, "doc_id")
