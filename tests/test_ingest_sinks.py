import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidewater.sources import files, jdbc, sinks
from tests.fixtures import MASTER_V1, MASTER_V2, NAV_V1, NAV_V2, write


def _nav_month(spark, path):
    return files.read_nav_csv(spark, path).withColumn("month", F.date_format("base_date", "yyyy-MM"))


def test_versioned_csv(spark, tmp_dir):
    write(tmp_dir, "fund_master_v1.csv", MASTER_V1)
    write(tmp_dir, "fund_master_v2.csv", MASTER_V2)
    base = os.path.join(tmp_dir, "fund_master")
    assert files.read_versioned_csv(spark, base, "v1").count() == 2
    assert files.read_versioned_csv(spark, base, "v2", infer=True).count() == 3


def test_nav_scan_types(spark, tmp_dir):
    nav = files.read_nav_csv(spark, write(tmp_dir, "nav.csv", NAV_V1))
    assert dict(nav.dtypes) == {"base_date": "date", "fund_id": "string", "nav_price": "decimal(18,4)"}


def test_partition_overwrite_is_idempotent_and_full_overwrite_replaces(spark, tmp_dir):
    v1 = _nav_month(spark, write(tmp_dir, "nav1.csv", NAV_V1))
    v2 = _nav_month(spark, write(tmp_dir, "nav2.csv", NAV_V2))
    table = os.path.join(tmp_dir, "nav_table")
    sinks.partition_overwrite(v1, table, "month")
    sinks.partition_overwrite(v2, table, "month")
    t = spark.read.parquet(table)
    assert t.count() == 12 and t.filter("month = '2025-07'").count() == 6
    assert t.groupBy("fund_id", "base_date").count().filter("count > 1").count() == 0
    sinks.partition_overwrite(v2, table, "month")  # rerun changes nothing
    assert spark.read.parquet(table).count() == 12
    sinks.full_overwrite(v2, table, "month")
    assert spark.read.parquet(table).count() == 6


def test_missing_partition_column(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        sinks.partition_overwrite(df, "/tmp/never-written", "ingest_date")


def test_declared_schemas_are_enforced(spark, tmp_dir):
    from tidewater.schemas import SchemaDrift, conform, declared
    nav = files.read_nav_csv(spark, write(tmp_dir, "nav.csv", NAV_V1)).withColumn("ingest_date", F.lit("2025-07-01").cast("date"))
    path = os.path.join(tmp_dir, "nav")
    sinks.partition_overwrite(nav, path, "ingest_date", schema="fund_nav")
    assert sinks.read_table(spark, path, "fund_nav").schema.names == declared("fund_nav").names
    drifted = [nav.withColumn("extra", F.lit(1)), nav.drop("fund_id"), nav.withColumn("nav_price", F.lit(1.5))]
    for df in drifted:
        with pytest.raises(SchemaDrift):
            sinks.partition_overwrite(df, path, "ingest_date", schema="fund_nav")
        with pytest.raises(SchemaDrift):
            sinks.replace_table(df, path, schema="fund_nav")
    assert sinks.read_table(spark, path, "fund_nav").count() == 6
    with pytest.raises(SchemaDrift):
        sinks.read_table(spark, path, "match_scores")
    assert conform(nav.select(*reversed(nav.columns)), "fund_nav").columns == declared("fund_nav").names


def test_jdbc_options_and_watermark():
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "u", "p", None, "id")
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "u", "p", "   ", "id")
    o = jdbc.jdbc_options("jdbc:x", "u", "p", jdbc.watermark_subquery("public.orders", "logical_date",
                                                                       dt.date(2025, 7, 1)), "id")
    assert o["dbtable"] == "(SELECT * FROM public.orders WHERE logical_date > DATE '2025-07-01') src"
    assert (o["fetchsize"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == ("1000", "1", "10000", "4")
    with pytest.raises(ValueError):
        jdbc.watermark_subquery("t", "c", "not-a-date")


def test_watermark_filter_pushdown(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    out = jdbc.watermark_filter(orders, "o_orderdate", "1998-08-01")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in plan
    assert out.count() == orders.filter("o_orderdate > timestamp'1998-08-01'").count()
    assert jdbc.next_watermark(out, "o_orderdate") is not None


def test_write_audit_publish_with_one_stage(spark, tmp_dir):
    main, stage = os.path.join(tmp_dir, "main"), os.path.join(tmp_dir, "stage")
    schema = "k int, v double, hour string"
    frame = lambda *rows: spark.createDataFrame(list(rows), schema)
    checks = [sinks.Expectation("_v_positive", F.col("v") > 0)]
    publish = lambda df: sinks.write_audit_publish(spark, df, main, stage, "hour", checks)
    read = lambda: sorted((r.k, r.hour) for r in spark.read.schema(schema).parquet(main).collect())
    assert publish(frame((1, 5.0, "09"), (2, 6.0, "10")))["published"] == 1
    assert os.path.isdir(os.path.join(main, "hour=09"))
    rejected = publish(frame((3, -1.0, "09")))
    assert rejected["published"] == 0 and rejected["_v_positive"] == 1
    assert read() == [(1, "09"), (2, "10")]
    # newer rows in main must survive a later batch of other partitions, and
    # neither the rejected nor the first batch may come back
    sinks.partition_overwrite(frame((7, 7.0, "10")), main, "hour")
    assert publish(frame((4, 1.0, "09"), (5, 1.0, None)))["published"] == 1
    assert read() == [(4, "09"), (5, None), (7, "10")] or set(read()) == {(4, "09"), (5, None), (7, "10")}
    with pytest.raises(ValueError):
        sinks.audit(frame(), [sinks.Expectation("_rows", F.lit(True))])


def test_compaction_keeps_folder_names_and_null_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "hours")
    df = spark.range(600).withColumn("hour", F.when(F.col("id") % 4 == 3, None).otherwise(
        F.lpad((F.col("id") % 4 + 8).cast("string"), 2, "0")))
    df.repartition(5).write.partitionBy("hour").parquet(path)
    one = os.path.join(path, "hour=11")
    spark.range(3).coalesce(1).write.parquet(one)  # well sized already: left as it is
    before = sorted(os.listdir(one))
    names = sorted(x for x in os.listdir(path) if x.startswith("hour="))
    rep = sinks.compact_partitions(spark, path, "hour").collect()
    assert sorted(x for x in os.listdir(path) if x.startswith("hour=")) == names
    assert "hour=08" in names and "hour=__HIVE_DEFAULT_PARTITION__" in names
    assert sorted(os.listdir(one)) == before and len(rep) == 5
    back = sinks.read_partitioned(spark, path, ["hour"])
    assert back.filter("hour IS NULL").count() == 150 and back.filter("hour BETWEEN '08' AND '09'").count() == 300
    assert all(r.files_before == 1 for r in sinks.file_stats(spark, path, ["hour"]).collect())


def test_compaction(spark, tmp_dir):
    path = os.path.join(tmp_dir, "small")
    df = spark.range(0, 5000).withColumn("p", (F.col("id") % 3).cast("string"))
    df.repartition(20).write.partitionBy("p").parquet(path)
    before = sinks.file_stats(spark, path, ["p"]).collect()
    assert all(r.files_before > 1 for r in before)
    rep = sinks.compact_partitions(spark, path, "p", target_mb=512)
    assert sorted(r.files_after for r in rep.collect()) == [1, 1, 1]
    after = sinks.file_stats(spark, path, ["p"]).collect()
    assert all(r.files_before == 1 for r in after)
    assert spark.read.parquet(path).count() == 5000


def test_replace_table_and_routing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    sinks.replace_table(spark.range(3), path)
    sinks.replace_table(spark.createDataFrame([("x",)], "s string"), path)
    assert spark.read.parquet(path).columns == ["s"]
    assert sinks.target_namespace("main") == "brz_ingestion"
    assert sinks.target_namespace("dev") == "brz_ingestion_dev"
    assert sinks.table_path("/lake", "dev", "fund_nav").endswith("/brz_ingestion_dev/fund_nav")


def test_line_numbers_across_splits(spark, tmp_dir):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        for k, n in (("a", 3000), ("b", 700), ("c", 5)):
            with open(os.path.join(tmp_dir, f"{k}.csv"), "w") as fh:
                fh.write("id,val\n" + "\n".join(f"{k}{i},{i * 7}" for i in range(n)))
        df = files.read_csv(spark, [os.path.join(tmp_dir, f"{k}.csv") for k in "abc"])
        assert df.rdd.getNumPartitions() > 3
        rows = files.with_line_numbers(df).select("id", "line").collect()
        assert len(rows) == 3705 and all(int(r.id[1:]) + 2 == r.line for r in rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_half_done_swap_is_put_right(spark, tmp_dir):
    from tidewater.session import rename_path
    path = os.path.join(tmp_dir, "t")
    spark.range(100).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(path)
    rename_path(spark, path + "/p=0", path + "__old/p=0")          # the driver died right here
    assert sinks.recover_swap(spark, path, ["p"]) == "rolled back"
    assert spark.read.parquet(path).count() == 100 and not os.path.exists(path + "__old")
    spark.range(5).withColumn("p", F.lit(0)).write.partitionBy("p").parquet(path + "__old")  # new folder in place
    assert sinks.recover_swap(spark, path, ["p"]) == "removed old"
    assert sinks.recover_swap(spark, path, ["p"]) == "nothing"


class _Lost(Exception):
    pass


def test_a_publish_cut_short_anywhere_is_finished(spark, tmp_dir, monkeypatch):
    """The driver is lost before each rename and each deletion in turn; the next
    call finishes the batch before it wipes the stage."""
    schema = "k int, hour string"
    frame = lambda ks, hours: spark.createDataFrame([(k, h) for k in ks for h in hours], schema)
    checks = [sinks.Expectation("k_known", F.col("k").isNotNull())]
    monkeypatch.setattr(sinks, "SWAP_THREADS", 1)
    real = {"rename_path": sinks.rename_path, "delete_path": sinks.delete_path}
    step, cut = 0, True
    while cut:
        main, stage = os.path.join(tmp_dir, f"main{step}"), os.path.join(tmp_dir, f"stage{step}")
        sinks.write_audit_publish(spark, frame([1], ["08", "09", "10"]), main, stage, "hour", checks)
        left, cut = [step], False

        def spy(name):
            def call(*args):
                nonlocal cut
                if left[0] == 0:
                    cut = True
                    raise _Lost
                left[0] -= 1
                return real[name](*args)
            return call

        for name in real:
            monkeypatch.setattr(sinks, name, spy(name))
        try:
            sinks.write_audit_publish(spark, frame([2, 3], ["09", "10", "11"]), main, stage, "hour", checks)
        except _Lost:
            pass
        for name, fn in real.items():
            monkeypatch.setattr(sinks, name, fn)
        sinks.write_audit_publish(spark, frame([4], ["12"]), main, stage, "hour", checks)
        got = sorted((r.hour, r.k) for r in spark.read.schema(schema).parquet(main).collect())
        assert got == [("08", 1), ("09", 2), ("09", 3), ("10", 2), ("10", 3), ("11", 2), ("11", 3), ("12", 4)], step
        assert not os.path.exists(main + "__old") and not os.path.exists(main + "__journal")
        step += 1
    assert step > 6


def test_swap_of_many_folders_is_quick(spark, tmp_dir):
    import time
    for name in ("new", "table"):
        for i in range(720):
            os.makedirs(os.path.join(tmp_dir, name, f"hour={i:03d}"))
            open(os.path.join(tmp_dir, name, f"hour={i:03d}", name), "w").close()
    began = time.time()
    assert sinks.swap_partitions(spark, os.path.join(tmp_dir, "new"), os.path.join(tmp_dir, "table"), ["hour"]) == 720
    took = time.time() - began
    assert all("new" in os.listdir(os.path.join(tmp_dir, "table", f"hour={i:03d}")) for i in range(720))
    assert not os.path.exists(os.path.join(tmp_dir, "table__old")) and took < 15, took


def test_compaction_spreads_equal_rows_over_the_planned_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "same")
    df = spark.range(20_000).select(F.lit("x" * 40).alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("w"),
                                    F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("p"))
    df.withColumn("w", F.when(F.col("p") == "b", F.col("w")).otherwise("same")).repartition(12).write.partitionBy("p").parquet(path)
    sizes = {r.p: r.bytes for r in sinks.file_stats(spark, path, ["p"]).collect()}
    rep = {r.p: r.files_after for r in sinks.compact_partitions(spark, path, "p", target_mb=sizes["a"] / 3 / 1024 / 1024).collect()}
    after = {r.p: r for r in sinks.file_stats(spark, path, ["p"]).collect()}
    assert rep["a"] == 3 and {p: r.files_before for p, r in after.items()} == rep
    assert spark.read.parquet(path).count() == 20_000
    by_file = spark.read.parquet(path).filter("p = 'a'").groupBy(F.input_file_name()).count().collect()
    assert len(by_file) == 3 and min(r["count"] for r in by_file) > 5000


def test_incremental_loads_equal_the_full_load(spark, tmp_dir):
    path = os.path.join(tmp_dir, "inc")
    rows = [(i, dt.datetime(2025, 5 + i % 3, 1 + i % 28, 13), f"v{i}") for i in range(90)]
    rows += [(100, None, "no day"), (101, dt.datetime(2025, 7, 31, 23, 59), "last")]
    source = spark.createDataFrame(rows, "id int, at timestamp, v string").withColumn("at", F.col("at"))
    load = lambda df, lookback=0: jdbc.incremental_load(spark, df, path, "at", "month", "yyyy-MM", lookback)
    read = lambda: sorted((r.id, r.v, r.month) for r in sinks.read_partitioned(spark, path, ["month"]).collect())
    want = sorted((r.id, r.v, r.m) for r in source.withColumn("m", F.date_format("at", "yyyy-MM")).collect())
    assert jdbc.loaded_watermark(spark, path, "month") is None
    assert load(source.filter("at < '2025-06-20'")) is None      # June is loaded before it is complete
    assert load(source.filter("at < '2025-07-10' AND id % 9 <> 4")) == "2025-06"  # without its late rows
    assert load(source, 1) == "2025-06"                           # they arrive: one partition back
    assert read() == want
    assert load(source.filter("at > '2026-01-01'")) == "2025-07" and read() == want  # nothing new
    assert load(source) == "2025-07" and read() == want           # a rerun
    with pytest.raises(ValueError):
        jdbc.incremental_load(spark, source, path, "at", "month", "dd-MM-yyyy")


def test_incremental_bound_is_pushed(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "orders")
    os.makedirs(os.path.join(path, "o_month=1998-07"))
    plans = []
    monkeypatch.setattr(jdbc, "partition_overwrite",
                        lambda df, *a: plans.append(df._jdf.queryExecution().executedPlan().toString()))
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    assert jdbc.incremental_load(spark, orders, path, "o_orderdate", "o_month", "yyyy-MM") == "1998-07"
    assert "GreaterThanOrEqual(o_orderdate,1998-07-01" in plans[0]
