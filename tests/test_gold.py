import datetime as dt
import decimal

from pyspark.sql import functions as F

from tidewater.functions import columns as C
from tidewater.operators import dims
from tidewater.sources import files
from tests.fixtures import MASTER_V1, MASTER_V2, NAV_V1, NAV_V2, write

D1, D2 = dt.date(2025, 6, 30), dt.date(2025, 7, 1)
ATTRS = ["fund_category", "trust_fee_rate", "is_active", "fund_name", "nickname",
         "management_company", "manager_name", "manager_email"]


def test_scd2_from_two_snapshots(spark, tmp_dir):
    v1 = C.stamp_ingest_date(spark.read.option("header", "true").csv(write(tmp_dir, "m1.csv", MASTER_V1)), D1)
    v2 = C.stamp_ingest_date(spark.read.option("header", "true").csv(write(tmp_dir, "m2.csv", MASTER_V2)), D2)
    snaps = C.decimal_cast(v1.unionByName(v2), ["trust_fee_rate"])
    dim = dims.scd2_dimension(snaps, "fund_id", "ingest_date", ATTRS, sk_col="fund_sk")
    rows = sorted((r.fund_id, str(r.trust_fee_rate), r.effective_start_date, r.effective_end_date, r.current_flag)
                  for r in dim.collect())
    assert rows == [
        ("K10", "1.45", D1, dt.date(9999, 12, 31), True),
        ("K20", "0.18", D2, dt.date(9999, 12, 31), True),
        ("K20", "0.30", D1, D1, False),
        ("K30", "0.22", D2, dt.date(9999, 12, 31), True),
    ]
    sks = [r.fund_sk for r in dim.collect()]
    assert len(set(sks)) == 4
    dims.assert_unique(dim, "fund_sk")
    import pytest
    with pytest.raises(ValueError):
        dims.assert_unique(dim, "fund_id")
    again = [r.fund_sk for r in dims.scd2_dimension(snaps, "fund_id", "ingest_date", ATTRS, sk_col="fund_sk").collect()]
    assert sorted(again) == sorted(sks)  # stable across reruns


def _nav(spark, tmp_dir):
    v1 = files.read_nav_csv(spark, write(tmp_dir, "nav1.csv", NAV_V1))
    v2 = files.read_nav_csv(spark, write(tmp_dir, "nav2.csv", NAV_V2))
    return v1.unionByName(v2)


def test_nav_change(spark, tmp_dir):
    out = dims.nav_change(_nav(spark, tmp_dir), "fund_id", "base_date", "nav_price")
    got = {(r.fund_id, r.base_date.isoformat()): (r.price_change, r.price_change_rate_pct) for r in out.collect()}
    assert got[("K10", "2025-04-01")] == (None, None)
    assert got[("K10", "2025-04-02")] == (decimal.Decimal("-12.2500"), -0.119975)
    assert got[("K10", "2025-07-01")] == (decimal.Decimal("52.2000"), 0.501904)
    assert got[("K20", "2025-04-02")] == (decimal.Decimal("73.7300"), 1.01)
    assert got[("K30", "2025-07-01")] == (None, None)
    assert got[("K30", "2025-07-02")] == (decimal.Decimal("91.2000"), 0.999973)


def test_calendar(spark):
    b = spark.createDataFrame([(dt.date(2025, 3, 30), dt.date(2025, 4, 6))], "d0 date, d1 date")
    cal = {r.date_value: r for r in dims.dim_date(b).collect()}
    assert len(cal) == 8
    m31 = cal[dt.date(2025, 3, 31)]
    assert m31.date_sk == 20250331 and m31.is_month_end and m31.fiscal_year == 2024 and m31.day_of_week == 1
    a5 = cal[dt.date(2025, 4, 5)]
    assert a5.fiscal_year == 2025 and a5.is_weekend and a5.day_of_week == 6 and a5.year_month == "202504"
    assert not cal[dt.date(2025, 4, 4)].is_weekend


def test_point_in_time_fact_and_wide(spark, tmp_dir):
    nav = dims.nav_change(_nav(spark, tmp_dir), "fund_id", "base_date", "nav_price")
    snaps = spark.createDataFrame(
        [("K20", dt.date(2025, 4, 1), "0.25"), ("K20", dt.date(2025, 7, 1), "0.11"),
         ("K10", dt.date(2025, 4, 1), "1.2"), ("K30", dt.date(2025, 7, 1), "0.15")],
        "fund_id string, day date, fee string")
    dim = dims.scd2_dimension(snaps, "fund_id", "day", ["fee"], sk_col=None)
    cal = dims.calendar_for(nav, "base_date")
    fact = dims.fact_performance(nav, dim, cal, "fund_id", "base_date", carry=["fee"])
    got = {(r.fund_id, r.base_date.isoformat()): (r.fee, r.effective_start_date.isoformat(), r.date_sk)
           for r in fact.collect()}
    assert got[("K20", "2025-06-30")] == ("0.25", "2025-04-01", 20250630)
    assert got[("K20", "2025-07-01")] == ("0.11", "2025-07-01", 20250701)
    assert fact.count() == nav.count()
    # the same through a range join
    rj = nav.join(dim, (nav.fund_id == dim.fund_id) &
                  nav.base_date.between(dim.effective_start_date, dim.effective_end_date)) \
        .select(nav.fund_id, nav.base_date, dim.fee)
    assert sorted(map(tuple, rj.collect())) == sorted((k[0], dt.date.fromisoformat(k[1]), v[0])
                                                      for k, v in got.items())
    master = spark.createDataFrame([("K10", "A"), ("K20", "B")], "fund_id string, name string")
    wide = dims.daily_wide(nav, master, "fund_id")
    assert wide.count() == nav.count() and wide.filter(F.col("name").isNull()).count() == 2


def test_latest_snapshot(spark):
    df = spark.createDataFrame([(1, "a", D1), (1, "b", D2), (2, "c", D1)], "k int, v string, ingest_date date")
    got = sorted(map(tuple, dims.latest_snapshot(df, ["k"], "ingest_date", ["v"]).collect()))
    assert got == [(1, "b", D2), (2, "c", D1)]
    import pytest
    with pytest.raises(ValueError):
        dims.latest_snapshot(df, ["k"], "ingest_date", [])


def test_latest_snapshot_and_refresh_do_not_depend_on_arrival(spark):
    old = spark.createDataFrame([("A", D1, "zz", 1)], "k string, d date, v string, seq int")
    new = spark.createDataFrame([("A", D1, "aa", 2)], "k string, d date, v string, seq int")
    for u in (old.unionByName(new), new.unionByName(old)):
        assert [r.v for r in dims.latest_snapshot(u, ["k", "d"], "d", ["seq"]).collect()] == ["aa"]
    hist, reload = old.drop("seq"), new.drop("seq")  # a reload of a known day wins
    dim = dims.scd2_dimension(hist, "k", "d", ["v"], sk_col=None)
    got = dims.scd2_refresh(dim, hist, reload, "k", "d", ["v"], sk_col=None).collect()
    assert [r.v for r in got] == ["aa"]


def test_nav_change_zero_previous(spark):
    df = spark.createDataFrame([("F", dt.date(2025, 1, 1), decimal.Decimal("0")),
                                ("F", dt.date(2025, 1, 2), decimal.Decimal("5"))],
                               "k string, d date, v decimal(18,4)")
    r = dims.nav_change(df, "k", "d", "v").orderBy("d").collect()
    assert r[1].price_change == decimal.Decimal("5.0000") and r[1].price_change_rate_pct is None


def _loads(v1, v2, day=None):
    """Two loads with their load dates and sequence numbers."""
    frames = []
    for i, (v, d) in enumerate(((v1, dt.date(2025, 4, 1)), (v2, dt.date(2025, 7, 1)))):
        frames.append(C.stamp_ingest_date(v, d).withColumn("load_seq", F.lit(i)))
    return frames[0].unionByName(frames[1])


def test_a_lower_corrected_price_counts(spark):
    day = dt.date(2025, 4, 1)
    rows = [("A", day, decimal.Decimal("100"), day, 1), ("A", day, decimal.Decimal("90"), day, 2)]
    nav = spark.createDataFrame(rows, "fund_id string, base_date date, nav_price decimal(18,4), ingest_date date, load_seq int")
    master = spark.createDataFrame([("A", day, "x", 1)], "fund_id string, ingest_date date, fund_name string, load_seq int")
    assert [r.nav_price for r in dims.build_gold(master, nav)["fact"].collect()] == [decimal.Decimal("90.0000")]


def test_build_gold(spark, tmp_dir):
    read = spark.read.option("header", "true")
    snaps = _loads(read.csv(write(tmp_dir, "g1.csv", MASTER_V1)), read.csv(write(tmp_dir, "g2.csv", MASTER_V2)))
    snaps = C.decimal_cast(snaps, ["trust_fee_rate"])
    nav = _loads(files.read_nav_csv(spark, write(tmp_dir, "n1.csv", NAV_V1)),
                 files.read_nav_csv(spark, write(tmp_dir, "n2.csv", NAV_V2)))
    g = dims.build_gold(snaps, nav)
    assert g["dim_fund"].count() == 4
    dims.assert_unique(g["fact"], ["fund_id", "base_date"])
    fact = {(r.fund_id, r.base_date.isoformat()): r for r in g["fact"].collect()}
    assert fact[("K20", "2025-06-30")].date_sk == 20250630
    wide = {(r.fund_id, r.base_date.isoformat()): str(r.trust_fee_rate) for r in g["wide"].collect()}
    assert wide[("K20", "2025-06-30")] == "0.30" and wide[("K20", "2025-07-01")] == "0.18"
    assert g["dim_date"].count() == (dt.date(2025, 7, 2) - dt.date(2025, 4, 1)).days + 1


def test_scd2_refresh_with_late_snapshot(spark):
    rows = [("A", dt.date(2025, 1, 1), "x"), ("A", dt.date(2025, 1, 10), "y"),
            ("B", dt.date(2025, 1, 1), "p")]
    hist = spark.createDataFrame(rows, "k string, d date, v string")
    dim = dims.scd2_dimension(hist, "k", "d", ["v"], sk_col="sk")
    late = spark.createDataFrame([("A", dt.date(2025, 1, 5), "z")], "k string, d date, v string")
    refreshed = dims.scd2_refresh(dim, hist, late, "k", "d", ["v"], sk_col="sk")
    full = dims.scd2_dimension(hist.unionByName(late), "k", "d", ["v"], sk_col="sk")
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, refreshed.collect()), key=key) == sorted(map(tuple, full.select(*refreshed.columns).collect()), key=key)
    a = {(r.v, r.effective_start_date.isoformat(), r.effective_end_date.isoformat())
         for r in refreshed.filter("k = 'A'").collect()}
    assert a == {("x", "2025-01-01", "2025-01-04"), ("z", "2025-01-05", "2025-01-09"),
                 ("y", "2025-01-10", "9999-12-31")}


def test_scd2_refresh_rebuilds_neighbours_only(spark, tmp_dir):
    """Versions that no late day borders come back as they are, even where the
    history would give others; the history is read once."""
    day = lambda i: dt.date(2025, 1, 1) + dt.timedelta(days=i)
    path = f"{tmp_dir}/scd_history"
    spark.createDataFrame([("A", day(10 * i), f"v{i}") for i in range(9)] + [("B", day(0), "p")],
                          "k string, d date, v string").write.parquet(path)
    hist = spark.read.parquet(path)
    dim = dims.scd2_dimension(hist, "k", "d", ["v"], sk_col=None)
    marked = spark.createDataFrame(dim.withColumn("v", F.concat("v", F.lit("!"))).collect(), dim.schema)
    out = dims.scd2_refresh(marked, hist, spark.createDataFrame([("A", day(45), "late")], "k string, d date, v string"),
                            "k", "d", ["v"], sk_col=None)
    got = {(r.k, r.effective_start_date): (r.v, r.effective_end_date) for r in out.collect()}
    rebuilt = {day(30): "v3", day(40): "v4", day(45): "late", day(50): "v5"}
    for i in range(9):
        assert got["A", day(10 * i)][0] == rebuilt.get(day(10 * i), f"v{i}!")
    assert got["A", day(40)] == ("v4", day(44)) and got["A", day(45)] == ("late", day(49)) and got["B", day(0)][0] == "p!"
    assert len(got) == 11
    assert out._jdf.queryExecution().sparkPlan().toString().count("scd_history") == 1
