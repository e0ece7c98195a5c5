"""A third of all rows on one key: outputs stay linear, copies collapse."""

from pyspark.sql import functions as F

from tidewater.functions.text import det_key
from tidewater.operators import dims, match, usage


def _sides(spark, n=3000):
    rows = [(i, "the very same hot text" if i % 3 == 0 else f"unique words number {i} here") for i in range(n)]
    df = det_key(spark.createDataFrame(rows, "id long, text string"), ["text"])
    return df.filter(F.col("id") % 2 == 0), df.filter(F.col("id") % 2 == 1)


def test_exact_match_hot_key_is_linear(spark):
    cur, leg = _sides(spark)
    out = match.exact_match_pairs(cur, leg, "id", "id", empty_col="det_key_empty")
    hot_cur = cur.filter("text = 'the very same hot text'").count()
    hot_leg = leg.filter("text = 'the very same hot text'").count()
    assert out.count() == hot_cur  # one row per current record, not hot_cur * hot_leg
    r = out.first()
    assert r.n_right == hot_leg and r.lg_id == leg.filter("text = 'the very same hot text'").agg(F.min("id")).first()[0]
    assert match.unmatched(cur, leg, empty_col="det_key_empty").count() == cur.count() - hot_cur


def test_similarity_joins_collapse_hot_copies(spark):
    cur, leg = _sides(spark)
    j = match.jaccard_join(cur, leg, "id", "id", 0.5).collect()
    hot = [r for r in j if r.jaccard_dist == 0.0]
    assert len(hot) == 1 and hot[0].n_left == 500 and hot[0].n_right == 500
    lsh = match.lsh_similarity_join(cur, leg, "id", "id", threshold=0.5).collect()
    assert sum(1 for r in lsh if r.jaccard_dist == 0.0) == 1


def test_hot_key_windows_are_bounded_by_days(spark):
    # 3000 rows on one key but only 10 distinct days: the SCD2 window sees 10 rows
    rows = [(1, i % 10, "x" if i % 10 < 5 else "y", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, d int, v string, o int").withColumn(
        "day", F.date_add(F.lit("2025-01-01").cast("date"), F.col("d")))
    daily = dims.daily_last(df, "k", "day", ["v"], "o")
    assert daily.count() == 10
    assert dims.scd2_dimension(daily, "k", "day", ["v"], sk_col=None).count() == 2


def test_usage_counts_hot_table(spark):
    rows = [(f"q{i}", "2025-07-01T00:00:00Z", "select * from hot.t join cold.u" if i % 3 else "select 1 from hot.t")
            for i in range(900)]
    q = spark.createDataFrame(rows, "qid string, submitted string, query string")
    rep = {(r.tbl, r.day): r.n for r in usage.table_refs_daily(q).collect()}
    assert rep == {("hot.t", "2025-07-01"): 900, ("cold.u", "2025-07-01"): 600}
