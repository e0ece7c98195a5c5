"""The fund fixture end to end: canonicalise, key, exact match, remainder,
exact Jaccard, fee difference, MinHash LSH."""

import decimal
import statistics

import pytest
from pyspark.sql import functions as F

from tidewater.functions import columns as C
from tidewater.functions.text import det_key, text_features
from tidewater.operators import match
from tests.fixtures import LEGACY, MASTER_V2, write

FIELDS = ["fund_name", "management_company", "nickname"]


@pytest.fixture()
def masters(spark, tmp_dir):
    v2 = spark.read.option("header", "true").csv(write(tmp_dir, "fund_master_v2.csv", MASTER_V2))
    lg = spark.read.option("header", "true").csv(write(tmp_dir, "legacy_fund_master.csv", LEGACY))
    lg = C.rename_map(lg)

    def prep(df):
        df = C.decimal_cast(C.canonicalize_columns(df), ["trust_fee_rate", "hidden_cost"])
        df = det_key(df, FIELDS)
        return text_features(df, [f"{f}_norm" for f in FIELDS])
    return prep(v2), prep(lg)


def test_exact_match_and_remainder(masters):
    v2, lg = masters
    pairs = match.exact_match_pairs(v2, lg, "fund_id", "fund_id", empty_col="det_key_empty").collect()
    assert [(r.v2_id, r.lg_id, r.n_right) for r in pairs] == [("K10", "L10", 1)]
    left = sorted(r.fund_id for r in match.unmatched(v2, lg, empty_col="det_key_empty").collect())
    right = sorted(r.fund_id for r in match.unmatched(lg, v2, empty_col="det_key_empty").collect())
    assert left == ["K20", "K30"] and right == ["L20", "L30"]
    # metamorphic: matched + unmatched = input
    assert len(pairs) + len(left) == v2.count()


def _remainder(masters):
    v2, lg = masters
    return (match.unmatched(v2, lg, empty_col="det_key_empty"),
            match.unmatched(lg, v2, empty_col="det_key_empty"))


def _brute(a, b):
    """(inter, uni) of all pairs of rows that share a token."""
    import regex
    pat = regex.compile(r"[\p{Han}]+|[\p{Hiragana}]+|[\p{Katakana}]+|[A-Za-z0-9]+")
    A, B = ({r.fund_id: set(pat.findall(r.text)) for r in x.collect()} for x in (a, b))
    return {(i, j): (len(x & y), len(x | y)) for i, x in A.items() for j, y in B.items() if x & y}


def test_jaccard_distances_and_fee_diff(masters):
    a, b = _remainder(masters)
    j = match.jaccard_join(a, b, "fund_id", "fund_id", 1.0, text_col="text")
    got = {(r.v2_id, r.lg_id): (r.inter, r.uni) for r in j.collect()}
    assert got == _brute(a, b) and {("K20", "L20"), ("K30", "L30")} <= set(got)
    fee = match.fee_diff(j, a, b, "fund_id", "fund_id", "trust_fee_rate")
    diffs = {(r.v2_id, r.lg_id): r.fee_diff for r in fee.collect()}
    assert diffs[("K20", "L20")] == decimal.Decimal("0.00")
    assert diffs[("K30", "L30")] == decimal.Decimal("0.03")
    dists = [1 - i / u for i, u in got.values()]
    summ = match.distance_summary(j).first()
    assert summ.n == len(dists) and summ.min == pytest.approx(min(dists)) and summ.max == pytest.approx(max(dists))
    prev = match.match_preview(j, 2).collect()
    assert [(r.v2_id, r.lg_id) for r in prev] == [("K20", "L20"), ("K30", "L30")]


def test_jaccard_threshold_is_strict_and_prefix_filter_exact(masters):
    a, b = _remainder(masters)
    for t in (0.13, 0.4, 0.41, 0.86):
        j = match.jaccard_join(a, b, "fund_id", "fund_id", t, text_col="text")
        brute = match.jaccard_join(a, b, "fund_id", "fund_id", 1.0, text_col="text") \
            .filter(F.col("jaccard_dist") < t)
        assert sorted(map(tuple, j.collect())) == sorted(map(tuple, brute.collect()))


def test_identical_sets_collapse(spark):
    left = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, "a b c"), (4, "x y")], "id long, text string")
    right = spark.createDataFrame([(10, "a b c d"), (11, "x y")], "id long, text string")
    rows = match.jaccard_join(left, right, "id", "id", 0.5).collect()
    got = {(r.v2_id, r.lg_id): (r.n_left, r.n_right, r.jaccard_dist) for r in rows}
    assert got == {(1, 10): (3, 1, 0.25), (4, 11): (1, 1, 0.0)}


def test_distance_summary_counts_every_pair_of_rows(spark):
    """Rows behind one token set are pairs of their own; a single pair has no deviation."""
    texts = [["a b c"] * 3 + ["x y", "p q r s"], ["a b c d", "c b d a", "x y", "p q r s t", "p q r"]]
    left, right = (spark.createDataFrame(list(enumerate(t)), "id long, text string") for t in texts)
    pairs = match.jaccard_join(left, right, "id", "id", 0.5)
    dists = [1 - len(a & b) / len(a | b) for a in (set(t.split()) for t in texts[0]) for b in (set(t.split()) for t in texts[1])]
    dists = [x for x in dists if x < 0.5]
    got = match.distance_summary(pairs).first()
    assert (got.n, got.min, got.max) == (len(dists), min(dists), max(dists)) and got.n > pairs.count()
    assert got["mean"] == pytest.approx(statistics.mean(dists), abs=1e-6)
    assert got.stddev == pytest.approx(statistics.stdev(dists), abs=1e-6)
    one = match.distance_summary(pairs.filter("v2_id = 3")).first()
    assert tuple(one) == (1, 0.0, None, 0.0, 0.0)
    assert tuple(match.distance_summary(pairs.filter("v2_id > 9")).first()) == (0, None, None, None, None)
    assert match.distance_summary(pairs.select("jaccard_dist")).first().n == pairs.count()


@pytest.mark.parametrize("seed", [1, 42])
def test_lsh_like_the_reference_settings(masters, seed):
    """One row per band, 8 tables, 512 dimensions, distance below 1."""
    a, b = _remainder(masters)
    lsh = match.lsh_similarity_join(a, b, "fund_id", "fund_id", threshold=1.0, num_features=512, hashing="mllib",
                                    num_bands=8, rows_per_band=1, seed=seed, text_col="text")
    got = {(r.v2_id, r.lg_id) for r in lsh.collect()}
    assert {("K20", "L20"), ("K30", "L30")} <= got <= set(_brute(a, b))


def test_a_common_word_of_short_names_makes_no_candidates(spark, monkeypatch):
    """Two sides of n two-token names that share one word: the word leaves
    the prefixes, so what the join looks at grows with n, not with n * n."""
    counted = []
    real = match.materialize

    def spy(df, name, how="checkpoint"):
        out = real(df, name, how)
        if name == "jaccard_prefix":
            counted.append(out.join(out.select(F.col("tok").alias("t2"), F.col("side").alias("s2")).filter("s2 = 1"),
                                    F.col("tok") == F.col("t2")).filter("side = 0").count())
        return out

    monkeypatch.setattr(match, "materialize", spy)
    for n in (1500, 6000):
        left = spark.range(n).selectExpr("id", "concat('fund a', id) AS text")
        right = spark.range(n).selectExpr("id", "concat('fund b', id) AS text")
        assert match.jaccard_join(left, right, "id", "id", 0.5).count() == 0
    assert counted == [0, 0]


def _random_sets(n, pool, size, seed):
    """Two sides of n sets of ``size`` words, all drawn from one small pool."""
    import random
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(pool)]
    return [[(i, " ".join(rng.sample(words, size))) for i in range(n)] for _ in range(2)]


def test_long_sets_of_common_words_make_few_candidates(spark, monkeypatch):
    """Every set shares about 18 of its 60 words, the commonest there are, with
    every other: what is written as a candidate does not grow with n * n."""
    counted = []
    real = match.jaccard_candidates

    def spy(prefix, p, q):
        out = real(prefix, p, q)
        counted.append(out.count())
        return out

    monkeypatch.setattr(match, "jaccard_candidates", spy)
    sides = _random_sets(400, 200, 60, 5)
    near = " ".join(sides[0][0][1].split()[:50] + [f"own{i}" for i in range(10)])
    for n in (100, 400):
        left, right = (spark.createDataFrame(x[:n], "id long, text string") for x in sides)
        right = right.unionByName(spark.createDataFrame([(9999, near)], "id long, text string"))
        got = [(r.v2_id, r.lg_id, r.inter) for r in match.jaccard_join(left, right, "id", "id", 0.5).collect()]
        assert got == [(0, 9999, 50)]
    assert max(counted) < 40, counted


def test_sketch_never_loses_a_pair(spark):
    """All pairs of sets of mixed sizes around the threshold, with many blocks."""
    import random
    rng = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    base = [rng.sample(words, rng.randint(1, 25)) for _ in range(12)]
    rows = [(i, " ".join(set(rng.sample(b, rng.randint(1, len(b))) + rng.sample(words, rng.randint(0, 4)))))
            for i, b in enumerate(base * 10)]
    left, right = (spark.createDataFrame(rows[i::2], "id long, text string") for i in (0, 1))
    for most in (0.3, 0.5, 0.75):
        got = {(r.v2_id, r.lg_id) for r in match.jaccard_join(left, right, "id", "id", most).collect()}
        a, b = ({}, {})
        for side, part in ((a, rows[0::2]), (b, rows[1::2])):
            for i, t in part:
                side.setdefault(frozenset(t.split()), i)
        want = {(i, j) for x, i in a.items() for y, j in b.items() if 1.0 - len(x & y) / len(x | y) < most}
        assert got == want


def test_block_pairs_meet_once_and_stay_small(spark):
    """A bucket of a third of the rows on each side: every pair meets once, in
    blocks of about the size asked for."""
    rows = [(side, i, "hot" if i % 3 == 0 else f"k{i}") for side in (0, 1) for i in range(900)]
    df = spark.createDataFrame(rows, "side int, rep long, k string")
    a, b = match.block_pairs(df, ["k"], "rep", block_rows=50)
    met = a.withColumnRenamed("rep", "ra").join(b.withColumnRenamed("rep", "rb"), ["k", "_bl", "_br"])
    assert met.count() == met.distinct().count() == 300 * 300 + 600
    cells = {(r["_bl"], r["_br"]): r["count"] for r in a.filter("k = 'hot'").groupBy("_bl", "_br").count().collect()}
    assert len(cells) == 36 and max(cells.values()) < 100


def test_lsh_hot_bucket_and_first_band(spark, monkeypatch):
    """A third of the sets are alike in their least hashes (one bucket in every
    band) but differ: all near pairs are found, each once, over small blocks."""
    monkeypatch.setattr(match, "block_pairs", lambda e, keys, row, real=match.block_pairs: real(e, keys, row, 16))
    core = " ".join(f"c{i}" for i in range(60))
    left = [(i, f"{core} x{i}" if i % 3 == 0 else f"own{i} a{i} b{i}") for i in range(240)]
    right = [(i, f"{core} y{i}" if i % 3 == 0 else f"other{i} d{i} e{i}") for i in range(240)]
    got = match.lsh_similarity_join(spark.createDataFrame(left, "id long, text string"),
                                    spark.createDataFrame(right, "id long, text string"), "id", "id", threshold=0.5).collect()
    assert len({(r.v2_id, r.lg_id) for r in got}) == len(got) == 80 * 80


def test_lsh_recall_against_the_exact_join(spark):
    """Pairs of every similarity above the threshold, and the documents."""
    import random
    rng = random.Random(2)
    left, right = [], []
    for i in range(600):
        shared, own = rng.randint(41, 60), rng.randint(0, 20)  # similarity from 0.5 up
        words = [f"s{i}w{k}" for k in range(shared)]
        left.append((i, " ".join(words + [f"l{i}w{k}" for k in range(own)])))
        right.append((i, " ".join(words + [f"r{i}w{k}" for k in range(20 - own)])))
    near, far = (spark.createDataFrame(x, "id long, text string") for x in (left, right))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    for a, b in ((near, far), (docs.filter("id % 2 = 0"), docs.filter("id % 2 = 1"))):
        exact = {(r.v2_id, r.lg_id) for r in match.jaccard_join(a, b, "id", "id", 0.5).collect()}
        found = {(r.v2_id, r.lg_id) for r in match.lsh_similarity_join(a, b, "id", "id", threshold=0.5).collect()}
        assert found <= exact and len(found) >= 0.98 * len(exact) > 0


def test_members_rebuild_all_pairs(spark):
    left = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c d"), (4, "")], "id long, text string")
    right = spark.createDataFrame([(10, "a b"), (11, "b a"), (12, "x y")], "id long, text string")
    exact = match.exact_match_members(left, right, "id", "id", key="text")
    got = {(r.side, r.id) for r in exact.collect()}
    assert got == {(0, 1), (0, 2), (1, 10)}
    sets = {(r.side, r.rep, r.id) for r in match.set_members(left, right, "id", "id").collect()}
    assert sets == {(0, 1, 1), (0, 1, 2), (0, 3, 3), (1, 10, 10), (1, 10, 11), (1, 12, 12)}


def test_similarity_joins_against_brute_force(spark):
    """Exact join = brute force over all pairs; LSH output is a subset of it."""
    import regex

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = docs.filter(F.col("doc_id") % 2 == 0)
    b = docs.filter(F.col("doc_id") % 2 == 1)
    pat = regex.compile(r"[\p{Han}]+|[\p{Hiragana}]+|[\p{Katakana}]+|[A-Za-z0-9]+")
    toks = {r.doc_id: frozenset(pat.findall(r.text or "")) for r in docs.collect()}
    A = {i: t for i, t in toks.items() if i % 2 == 0 and t}
    B = {i: t for i, t in toks.items() if i % 2 == 1 and t}
    rep_a, rep_b = {}, {}
    for side, reps in ((A, rep_a), (B, rep_b)):
        for i in sorted(side):
            reps.setdefault(side[i], i)
    brute = {}
    for sa, ia in rep_a.items():
        for sb, ib in rep_b.items():
            d = 1.0 - len(sa & sb) / len(sa | sb)
            if d < 0.5:
                brute[(ia, ib)] = d
    exact = {(r.v2_id, r.lg_id): r.jaccard_dist
             for r in match.jaccard_join(a, b, "doc_id", "doc_id", 0.5).collect()}
    assert exact == brute
    lsh = match.lsh_similarity_join(a, b, "doc_id", "doc_id", threshold=0.5, num_bands=10, rows_per_band=4).collect()
    assert lsh, "expected the near copies to collide in at least one band"
    for r in lsh:
        d = 1.0 - len(A[r.v2_id] & B[r.lg_id]) / len(A[r.v2_id] | B[r.lg_id])
        assert r.jaccard_dist == pytest.approx(d) and d < 0.5
        assert (r.v2_id, r.lg_id) in brute  # representatives, as in the exact join


def test_resolve_masters_takes_latest_snapshot(spark, tmp_dir):
    from tests.fixtures import MASTER_V1
    read = spark.read.option("header", "true")
    v1, v2 = (C.stamp_ingest_date(read.csv(write(tmp_dir, f"m{i}.csv", text)), day).withColumn("load_seq", F.lit(i))
              for i, (text, day) in enumerate(((MASTER_V1, "2025-06-30"), (MASTER_V2, "2025-07-01"))))
    cur = C.decimal_cast(v1.unionByName(v2), ["trust_fee_rate"])
    lg = C.decimal_cast(C.rename_map(read.csv(write(tmp_dir, "lg.csv", LEGACY))), ["trust_fee_rate", "hidden_cost"])
    r = match.resolve_masters(cur, lg)
    assert r["current"].count() == 3  # one row per fund, not per snapshot
    assert [(x.v2_id, x.lg_id) for x in r["exact"].collect()] == [("K10", "L10")]
    fees = {(x.v2_id, x.lg_id): x.fee_diff for x in r["similar_with_fee"].collect()}
    assert fees == {("K20", "L20"): decimal.Decimal("0.00"), ("K30", "L30"): decimal.Decimal("0.03")}  # newest fee
    assert {(x.side, x.id) for x in r["set_members"].collect()} == {(0, "K20"), (0, "K30"), (1, "L20"), (1, "L30")}
