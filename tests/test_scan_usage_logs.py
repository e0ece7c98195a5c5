import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tidewater.functions.detectors import EMAIL, SECRET_TOKEN, STRATEGY_CODE
from tidewater.operators import scan, usage
from tidewater.sources import files
from tidewater.plans import standins as S
from tests.fixtures import LEGACY, MASTER_V2


def _with_line_numbers(spark, text, tmp_dir, name):
    """The CSV object read by Spark, each row keyed by its line (header = line 1)."""
    from tests.fixtures import write
    path = write(tmp_dir, name, text)
    df = files.with_line_numbers(files.read_csv(spark, path))
    return df, [c for c in df.columns if c != "line"]


def test_strategy_code_golden(spark, tmp_dir):
    df, header = _with_line_numbers(spark, LEGACY, tmp_dir, "legacy_fund_master.csv")
    cells = scan.scan_cells(df, "line", header, detectors=(STRATEGY_CODE,), object_name="legacy_fund_master.csv")
    got = sorted((r.row, r.column, r.columnName, r.hits) for r in cells.collect())
    assert got == [("2", 9, "内部戦略コード", 1), ("3", 9, "内部戦略コード", 1), ("4", 9, "内部戦略コード", 1)]
    f = scan.findings(cells).collect()
    assert [(r.detector, r.cells, r.hits) for r in f] == [("strategy-code-detector", 3, 3)]


def test_email_detector_on_master(spark, tmp_dir):
    df, header = _with_line_numbers(spark, MASTER_V2, tmp_dir, "fund_master_v2.csv")
    cells = scan.scan_cells(df, "line", header, detectors=(EMAIL,), object_name="fund_master_v2.csv")
    got = sorted((r.row, r.column, r.columnName) for r in cells.collect())
    assert got == [("2", 9, "manager_email"), ("3", 9, "manager_email"), ("4", 9, "manager_email")]


def test_keyword_proximity(spark):
    h = "a" * 40
    df = spark.createDataFrame([
        (1, "戦略コード: STRAT-ABC-12", f"token = \"{h}\""),
        (2, "STRAT-ABC-12 without a keyword", h),
        (3, "戦略コード" + "x" * 301 + "STRAT-ABC-12", "Token " + "y" * 10 + h),
    ], "id long, a string, b string")
    cells = scan.scan_cells(df, "id", detectors=(STRATEGY_CODE, SECRET_TOKEN))
    got = sorted((r.row, r.columnName, r.detector) for r in cells.collect())
    assert got == [("1", "a", "strategy-code-detector"), ("1", "b", "secret-token"),
                   ("3", "b", "secret-token")]


def test_every_match_near_a_keyword_counts(spark):
    a, b = "a" * 40, "b" * 40
    df = spark.createDataFrame([(1, f"token {a} and {b}"), (2, f"token {'x ' * 200}{a}"), (3, f"{a} token")], "id long, t string")
    got = {(r.row, r.hits) for r in scan.scan_cells(df, "id", detectors=(SECRET_TOKEN,)).collect()}
    assert got == {("1", 2)}


def test_scope_and_findings_are_the_same_for_a_file_and_a_folder(spark, tmp_dir):
    rows = spark.createDataFrame([(i, f"m{i}@x.example", i) for i in range(9)], "id long, t string, n long")
    found = []
    for name, parts in (("one", 1), ("many", 3)):
        root = os.path.join(tmp_dir, name)
        rows.repartition(parts).write.parquet(os.path.join(root, "documents.parquet"))
        df = scan.in_scope(spark.read.parquet(os.path.join(root, "documents.parquet")), ["documents"], root=f"file://{root}/")
        found.append(sorted(map(tuple, scan.findings(scan.scan_cells(df, "id", object_name="documents")).collect())))
    assert found[0] == found[1] == [("documents", "email-address", 2, "t", 9, 9)]


def test_the_key_column_is_scanned(spark):
    df = spark.createDataFrame([("k@x.example", 1)], "id string, n long")
    cells = scan.scan_cells(df, "id", detectors=(EMAIL,))
    assert [(r.row, r.column, r.columnName) for r in cells.collect()] == [("k@x.example", 1, "id")]
    assert [tuple(r) for r in scan.object_totals(scan.findings(cells)).collect()] == [("object", 1)]


def test_projection_outside_its_years_is_an_error():
    import pytest
    with pytest.raises(ValueError):
        files.projected_paths("/x", start=dt.date(2019, 12, 31), end=dt.date(2020, 1, 2))


def test_hash_sample_deterministic(spark):
    df = spark.range(0, 4000).withColumnRenamed("id", "k")
    a = {r.k for r in scan.hash_sample(df, "k").collect()}
    b = {r.k for r in scan.hash_sample(df.repartition(7), "k").collect()}
    assert a == b and 0.72 < len(a) / 4000 < 0.78


def test_object_sample_keeps_whole_files(spark, tmp_dir):
    p = os.path.join(tmp_dir, "objects")
    for i in range(40):
        spark.range(5).coalesce(1).write.parquet(os.path.join(p, f"obj{i:02d}"))
    df = spark.read.parquet(os.path.join(p, "*"))
    kept = scan.hash_sample(df, "_metadata.file_path").groupBy("_metadata.file_path").count().collect()
    assert all(r["count"] == 5 for r in kept) and 20 <= len(kept) <= 38


def test_scope_filter(spark, tmp_dir):
    p = os.path.join(tmp_dir, "scope")
    spark.range(3).write.parquet(os.path.join(p, "fund_x"))
    spark.range(5).write.parquet(os.path.join(p, "other"))
    df = spark.read.parquet(os.path.join(p, "*"))
    assert scan.in_scope(df, ["fund"], root=p).count() == 3
    assert scan.in_scope(df, ["fund", "oth"], root=p).count() == 8
    assert scan.in_scope(df, ["part-"]).count() == 8  # file-name scope


def _log_doc(queries):
    return {"QueryExecutions": [
        {"QueryExecutionId": q, "Query": text, "Status": {"SubmissionDateTime": ts}}
        for q, text, ts in queries]}


def test_usage_report(spark, tmp_dir):
    docs = [_log_doc([
        ("q1", 'SELECT * FROM "A".b JOIN `c`.d.e ON x JOIN (SELECT 1 FROM f)', "2025-07-01T10:00:00Z"),
        ("q2", "select * from a.b join a.b on 1=1", "2025-07-01T11:00:00Z"),
        ("q3", "SELECT * FROM unnest(x) JOIN json_table(y) JOIN information_schema.tables", "2025-07-01T12:00:00Z"),
        ("q4", None, "2025-07-01T12:00:00Z"),
    ]), _log_doc([("q5", "SELECT 1 FROM a.b", "2025-07-02T09:00:00.123Z")])]
    path = os.path.join(tmp_dir, "log.json")
    with open(path, "w") as fh:
        fh.write("\n".join(json.dumps(d) for d in docs))
    q = usage.flatten_query_log(files.read_query_log(spark, path))
    assert q.count() == 4
    refs = sorted((r.qid, r.tbl) for r in usage.query_table_refs(q).collect())
    assert refs == [("q1", "a.b"), ("q1", "d.e"), ("q1", "f"), ("q2", "a.b"), ("q5", "a.b")]
    rep = [(r.tbl, r.day, r.n) for r in usage.table_refs_daily(q).collect()]
    assert rep == [("a.b", "2025-07-01", 2), ("a.b", "2025-07-02", 1), ("d.e", "2025-07-01", 1),
                   ("f", "2025-07-01", 1)]
    recent = usage.newest_queries(usage.flatten_query_log(files.read_query_log(spark, path), keep_null=True), 2)
    # q3 and q4 were submitted in the same second: the tie goes to the larger id
    assert sorted(r.qid for r in recent.collect()) == ["q4", "q5"]


def test_audit_log_projection_and_flow_pruning(spark):
    d = "/root/testdata/sf0.001"
    root = S.write_audit_log(spark, d)
    paths = files.projected_paths(root, ["us-east-1"], dt.date(2024, 1, 5), dt.date(2024, 1, 6))
    assert paths == [f"{root}/us-east-1/2024/01/05", f"{root}/us-east-1/2024/01/06"]
    sel = files.read_audit_log(spark, root, ["us-east-1"], dt.date(2024, 1, 5), dt.date(2024, 1, 6))
    assert {(r.region, r.day) for r in sel.select("region", "day").distinct().collect()} <= {
        ("us-east-1", "05"), ("us-east-1", "06")}
    full = files.read_audit_log(spark, root)
    assert full.count() == spark.read.parquet(f"{d}/events.parquet").count()
    flat = files.audit_flat(full)
    assert flat.filter(F.col("resource_arn").isNull()).count() == \
        full.filter(F.col("resources").isNull()).count()
    fl = files.read_flow_logs(spark, S.write_flow_logs(spark, d)).filter(F.col("hour") == "09")
    plan = fl._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan


def test_projected_glob_names_the_same_days():
    """Every pattern, opened out, covers exactly the folders of ``projected_paths``."""
    ranges = [(None, None), (dt.date(2024, 1, 5), dt.date(2024, 1, 12)), (dt.date(2023, 11, 30), dt.date(2025, 2, 1)),
              (dt.date(2024, 2, 1), dt.date(2024, 2, 29)), (dt.date(2024, 12, 31), dt.date(2025, 12, 31))]
    for start, end in ranges:
        glob = files.projected_glob("/x/", ["us-east-1", "eu-west-1"], start, end)
        head, regions, parts = glob[:glob.index("{")], *[p.split("}")[0].split(",") for p in glob.split("{")[1:]]
        prefixes = [f"{head}{r}/{p}" for r in regions for p in parts]
        days = files.projected_paths("/x", ["us-east-1", "eu-west-1"], start, end)
        assert all(sum(d == p or d.startswith(p + "/") for p in prefixes) == 1 for d in days)
        every = files.projected_paths("/x", ["us-east-1", "eu-west-1"])
        assert sum(any(d == p or d.startswith(p + "/") for p in prefixes) for d in every) == len(days)
        assert len(parts) <= 11 + 22 + 60
    assert files.projected_glob("/x", ["us-east-1"], dt.date(2024, 2, 2), dt.date(2024, 2, 1)) == ""


def test_audit_log_reads_day_folders_only(spark, tmp_dir):
    import os
    for folder in ("us-east-1/2024/01/05", "us-east-1/2024/01/06", "us-east-1/2024/01", "us-east-1/2024/01/05/more", "xx-east-1/2024/01/05"):
        os.makedirs(f"{tmp_dir}/{folder}", exist_ok=True)
        with open(f"{tmp_dir}/{folder}/f.json", "w") as f:
            f.write('{"eventid": "%s"}\n' % folder)
    got = files.read_audit_log(spark, tmp_dir).select("eventid", "region", "day").collect()
    assert sorted(map(tuple, got)) == [("us-east-1/2024/01/05", "us-east-1", "05"), ("us-east-1/2024/01/06", "us-east-1", "06")]
    one = files.read_audit_log(spark, tmp_dir, start=dt.date(2024, 1, 6), end=dt.date(2024, 1, 8))
    assert [r.day for r in one.collect()] == ["06"] and len(one.inputFiles()) == 1
    assert files.read_audit_log(spark, tmp_dir, ["eu-west-1"]).count() == 0
    assert files.read_audit_log(spark, tmp_dir, start=dt.date(2024, 1, 6), end=dt.date(2024, 1, 5)).count() == 0


def test_finding_documents_of_a_hot_object(spark):
    """One object with most findings, in chunks of 7: every position once, in
    order, and no chunk longer than that."""
    import random
    rng = random.Random(4)
    cells = [("hot", str(i), i % 3 + 1, f"c{i % 3}", rng.choice("de"), rng.randint(1, 3)) for i in range(500)]
    cells += [("hot", "key-a", 1, "c0", "d", 1), ("hot", "5", 1, "c0", "d", 1), ("hot", "5", 1, "c0", "d", 1), ("cold", "1", 2, "c1", "d", 4)]
    rng.shuffle(cells)
    df = spark.createDataFrame(cells, "object string, row string, column int, columnName string, detector string, hits long").repartition(9)
    out = scan.finding_documents(df, 7).collect()
    want = {}
    for o, r, c, n, det, h in cells:
        want.setdefault((o, det), []).append(((not r.isdigit(), int(r) if r.isdigit() else 0, r, c), (r, c, n), h))
    assert len(out) == len({(r.object, r.detector, r.chunk) for r in out})
    for (o, det), found in want.items():
        mine = sorted((r for r in out if (r.object, r.detector) == (o, det)), key=lambda r: r.chunk)
        assert [r.chunk for r in mine] == list(range(-(-len(found) // 7))) and {r.n_chunks for r in mine} == {len(mine)}
        assert [tuple(c) for r in mine for c in r.cells] == [x[1] for x in sorted(found, key=lambda x: x[0])]
        assert all(len(r.cells) <= 7 for r in mine)
        assert {r["count"] for r in mine} == {sum(x[2] for x in found)}
        assert {r.total_count for r in mine} == {sum(x[5] for x in cells if x[0] == o)}
    assert scan.finding_documents(df.limit(0)).collect() == []
