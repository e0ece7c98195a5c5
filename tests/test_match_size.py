"""What the similarity joins keep and shuffle: one row per set, digests instead of tokens."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tidewater.operators import match, meet
from tidewater.plans import QUERIES, catalog
from tidewater.session import path_exists


def _pairs(left, right, most):
    a, b = {}, {}
    for side, rows in ((a, left), (b, right)):
        for i, t in rows:
            if t.split():
                side.setdefault(frozenset(t.split()), i)
    return {(i, j) for x, i in a.items() for y, j in b.items() if 1.0 - len(x & y) / len(x | y) < most}


def _texts(n, seed, words=300):
    """Sets of 1 to 250 words in families of copies with changes."""
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(words)]
    base = [rng.sample(pool, rng.choice((1, 3, 20, 90, 250))) for _ in range(n // 8)]
    out = []
    for i in range(n):
        own = rng.choice(base)
        kept = rng.sample(own, max(1, int(len(own) * rng.uniform(0.5, 1))))
        out.append((i, " ".join(kept + rng.sample(pool, rng.randint(0, 3)))))
    return out


def _spied(monkeypatch, name):
    got = []
    real = match.materialize

    def spy(df, of, *how):
        out = real(df, of, *how)
        if of == name:
            got.append(out)
        return out

    monkeypatch.setattr(match, "materialize", spy)
    return got


def test_index_lists_are_lengths_and_sets_are_lines(spark, monkeypatch):
    rows = _texts(60, 3)
    left, right = (spark.createDataFrame(rows[i::2], "id long, text string") for i in (0, 1))
    lists, sets = _spied(monkeypatch, "jaccard_prefix"), _spied(monkeypatch, "jaccard_sets")
    match.jaccard_join(left, right, "id", "id", 0.5).count()
    assert lists[0].count() == lists[0].select("side", "tok").distinct().count()
    assert dict(sets[0].dtypes)["toks"] == "string"


def test_bands_are_one_row_per_set(spark, monkeypatch):
    rows = _texts(60, 4)
    left, right = (spark.createDataFrame(rows[i::2], "id long, text string") for i in (0, 1))
    bands, sets = _spied(monkeypatch, "lsh_bands"), _spied(monkeypatch, "lsh_sets")
    match.lsh_similarity_join(left, right, "id", "id", threshold=0.5).count()
    assert bands[0].count() == sets[0].count()


@pytest.mark.parametrize("most", [0.2, 0.5, 0.8])
def test_blocks_buckets_and_unranked_tokens_lose_no_pair(spark, monkeypatch, most):
    """Lists cut into small blocks, few known frequencies, sketches of several widths."""
    monkeypatch.setattr(match, "BLOCK_ROWS", 16)
    monkeypatch.setattr(match, "COMMON_TOKENS", 20)
    rows = _texts(300, 5)
    left, right = (spark.createDataFrame(rows[i::2], "id long, text string") for i in (0, 1))
    got = [(r.v2_id, r.lg_id) for r in match.jaccard_join(left, right, "id", "id", most).collect()]
    want = _pairs(rows[0::2], rows[1::2], most)
    assert len(got) == len(set(got)) and set(got) == want and want


def test_tokens_with_spaces_and_null_ids(spark):
    """Given token lists stay lists; a set whose rows have no id is in no pair."""
    left = spark.createDataFrame([(1, ["a b", "c"]), (None, ["x", "y"])], "id long, toks array<string>")
    right = spark.createDataFrame([(10, ["a", "b", "c"]), (11, ["a b", "c"]), (12, ["x", "y"])], "id long, toks array<string>")
    for join in (match.jaccard_join(left, right, "id", "id", 0.6, text_col=None, tokens_col="toks"),
                 match.lsh_similarity_join(left, right, "id", "id", threshold=0.6, text_col=None, tokens_col="toks")):
        assert [(r.v2_id, r.lg_id, r.jaccard_dist) for r in join.collect()] == [(1, 11, 0.0)]


@pytest.mark.parametrize("name", ["jaccard_join", "lsh_similarity_join", "fee_diff", "distance_summary", "match_preview", "match_job"])
def test_queries_match_by_digests(spark, tmp_dir, monkeypatch, name):
    """Rows that go through the anti-joins and the grouping hold no tokens."""
    rows = _texts(80, 6)
    spark.createDataFrame([(i, t, "en", f"src{i}", len(t)) for i, t in rows],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_dir}/documents.parquet")
    seen = []
    for join in ("jaccard_join", "lsh_similarity_join"):
        monkeypatch.setattr(catalog.match, join, lambda a, b, *x, real=getattr(match, join), **k: seen.append((a, b)) or real(a, b, *x, **k))
    out = QUERIES[name](spark, tmp_dir).collect()
    assert len(seen) == 1
    for side in seen[0]:
        assert "toks" not in side.columns and "text" not in side.columns
    if name == "jaccard_join":
        whole = {(i, j) for i, j in _pairs(rows[0::2], rows[1::2], 0.5)}
        texts = dict(rows)
        exact = {t.lower().replace(" ", "") for _, t in rows[0::2]} & {t.lower().replace(" ", "") for _, t in rows[1::2]}
        if not exact:
            assert {(r.v2_id, r.lg_id) for r in out} == whole
        assert all(len(set(texts[r.v2_id].split()) & set(texts[r.lg_id].split())) == r.inter for r in out)


@pytest.mark.parametrize("cell", [4, 256])
def test_tokens_are_shuffled_per_cell_not_per_pair(spark, monkeypatch, cell):
    """40 x 40 near copies: 1600 pairs, each found once with its counts; a set is sent once a cell."""
    monkeypatch.setattr(match, "CELL_ROWS", cell)
    common = " ".join(f"c{i}" for i in range(30))
    rows = [(i, f"{common} own{i % 80}") for i in range(120)]
    left, right = (spark.createDataFrame(rows[i::2], "id long, text string") for i in (0, 1))
    sent = []
    real = match.cell_rows
    monkeypatch.setattr(match, "cell_rows", lambda *x: sent.append(real(*x)) or sent[-1])
    for join in (match.jaccard_join(left, right, "id", "id", 0.5), match.lsh_similarity_join(left, right, "id", "id", threshold=0.5, num_bands=40, rows_per_band=1)):
        got = {(r.v2_id, r.lg_id): (r.n_left, r.n_right, round(r.jaccard_dist, 9)) for r in join.collect()}
        assert join.count() == len(got) == 1600
        assert {(v[0] + v[1]) // 2 for v in got.values()} <= {1, 2} and {v[2] for v in got.values()} == {round(1 - 30 / 32, 9)}
        n = sent[-1].count()
        assert n == 80 if cell == 256 else 80 < n < 1600
        assert sent[-1].groupBy("fam", "bl", "br").count().agg({"count": "max"}).first()[0] <= 4 * cell


@pytest.mark.parametrize("rounds", [2, 4])
def test_buckets_are_met_in_rounds(spark, monkeypatch, rounds):
    """Each round shuffles the index rows of its own buckets only; together they lose
    no pair and give each once, also where hot lists are cut into blocks."""
    monkeypatch.setattr(match, "ROUND_BUCKETS", -(-match.LEAST_BUCKETS // rounds))
    monkeypatch.setattr(match, "BLOCK_ROWS", 16)
    released, met = [], []
    real, release = match.jaccard_candidates, match.release_shuffles
    monkeypatch.setattr(match, "release_shuffles", lambda s: released.append(1) or release(s))
    monkeypatch.setattr(match, "jaccard_candidates",
                        lambda rows, p, q: met.append({r.bucket for r in rows.select("bucket").distinct().collect()}) or real(rows, p, q))
    rows = _texts(200, 7)
    left, right = (spark.createDataFrame(rows[i::2], "id long, text string") for i in (0, 1))
    got = [(r.v2_id, r.lg_id) for r in match.jaccard_join(left, right, "id", "id", 0.5).collect()]
    want = _pairs(rows[0::2], rows[1::2], 0.5)
    assert len(got) == len(set(got)) and set(got) == want and want
    assert len(met) == rounds and sum(map(len, met)) == len(set().union(*met)) == match.LEAST_BUCKETS
    assert len(released) > rounds
    found = {(r.v2_id, r.lg_id) for r in match.lsh_similarity_join(left, right, "id", "id", threshold=0.5, num_bands=40, rows_per_band=1).collect()}
    assert len(met) == 2 * rounds and found <= want and len(found) >= 0.98 * len(want)


@pytest.mark.parametrize("name", ["distance_summary", "fee_diff", "match_job", "match_preview"])
def test_digests_are_gone_once_the_sets_are_written(spark, tmp_dir, monkeypatch, name):
    rows = _texts(80, 8)
    spark.createDataFrame([(i, t, "en", f"src{i}", len(t)) for i, t in rows],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_dir}/documents.parquet")
    paths, there = [], []
    real, meet = catalog.scratch_path, match.jaccard_candidates
    monkeypatch.setattr(catalog, "scratch_path", lambda s, n: paths.append(real(s, n)) or paths[-1])
    monkeypatch.setattr(match, "jaccard_candidates", lambda *x: there.append(path_exists(spark, paths[0])) or meet(*x))
    out = QUERIES[name](spark, tmp_dir).collect()
    assert out and "doc_digests" in paths[0] and there == [False]


def _index_rows(sets, p, q):
    """One batch of ``meet.INDEX`` rows of (side, tokens)."""
    part = pa.RecordBatch.from_arrays(
        [pa.array([x for x, _ in sets], pa.int32()), pa.array(range(len(sets)), pa.int64()), pa.array([len(t) for _, t in sets], pa.int32()),
         pa.array([list(t) for _, t in sets], pa.list_(pa.int64()))], names=["side", "name", "n", "hashes"])
    none = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    return list(meet.prefix_keys(*none, p, q)([part]))


def _bucket_rows(index, buckets, held, ranked=True):
    """``meet.PACKED`` rows of all buckets, sorted as a task gets them."""
    none = np.zeros(0, dtype=np.uint64), np.zeros((0, 2), dtype=np.int64)
    rows = pa.Table.from_batches(meet.pack_keys(*none, buckets, held, ranked, (0, buckets))(index))
    return rows.sort_by([("bucket", "ascending"), ("side", "ascending")]).combine_chunks().to_batches(max_chunksize=100)


@pytest.mark.parametrize("held", [0, 1])
@pytest.mark.parametrize("p, q", [(0, 1), (1, 5), (1, 2), (4, 5)])
def test_places_and_folded_sketches_rule_out_no_pair(p, q, held):
    """Sets of 1 to 4000 tokens, so sketches of all widths meet; whichever side is held."""
    rng = random.Random(p * 10 + q)
    pool, sets = [rng.getrandbits(63) for _ in range(5000)], []
    for _ in range(40):
        base = rng.sample(pool, rng.choice((1, 2, 30, 150, 800, 4000)))
        for _ in range(6):
            kept = rng.sample(base, max(1, int(len(base) * rng.choice((0.25, 0.6, 0.9, 1)))))
            sets.append((rng.randint(0, 1), set(kept) | set(rng.sample(pool, rng.choice((0, 1, len(kept) // 5))))))
    want = {(i, j) for i, (x, a) in enumerate(sets) for j, (y, b) in enumerate(sets) if x < y and len(a & b) * q > p * len(a | b)}
    got = [(a, b) for r in meet.meeting(p, q)(_bucket_rows(_index_rows(sets, p, q), 3, held)) for a, b in zip(*(c.to_pylist() for c in r.columns))]
    assert want and want <= set(got) and all(sets[a][0] == 0 and sets[b][0] == 1 for a, b in got)


@pytest.mark.parametrize("place, met", [(1, 1), (10, 1), (11, 0), (30, 0)])
def test_a_key_that_comes_too_late_in_a_set_makes_no_pair(place, met):
    """Sets of 90 and 60 tokens are alike by half with 51 common ones at least, so the first of
    them is among the first ten of the smaller set."""
    index = pa.RecordBatch.from_arrays(
        [pa.array([0, 1], pa.int32()), pa.array([0, 1], pa.int64()), pa.array([90, 60], pa.int32()), pa.array([b"\0" * 64] * 2, pa.binary()),
         pa.array([[*range(100, 120), 5], [*range(200, 199 + place), 5]], pa.list_(pa.int64()))], names=["side", "name", "n", "sketch", "keys"])
    assert sum(r.num_rows for r in meet.meeting(1, 2)(_bucket_rows([index], 1, 1))) == met


def test_a_task_holds_one_side_of_a_bucket_only():
    """What a task holds does not grow with the other side."""
    rng = np.random.default_rng(3)
    sets = [(1, rng.integers(0, 1 << 60, 120).tolist()) for _ in range(2000)]
    held = _bucket_rows(_index_rows(sets, 1, 2), 1, 1)
    other = _bucket_rows(_index_rows([(0, t) for _, t in sets[:500]], 1, 2), 1, 1)
    peaks = []
    for times in (1, 20):
        tracemalloc.start()
        pairs = sum(r.num_rows for r in meet.meeting(1, 2)(iter(held + other * times)))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert pairs == 500 * times
    assert peaks[1] < 1.2 * peaks[0]


def test_buckets_follow_from_the_bytes_of_one(spark, monkeypatch):
    """No bucket's held side is much larger than ``BUCKET_BYTES``, and no pair is lost."""
    monkeypatch.setattr(match, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(match, "MOST_ROUNDS", 2)
    sizes = []
    real = match.jaccard_candidates

    def spy(rows, p, q):
        for r in rows.filter("side < 2").selectExpr("bucket", "length(sketch) w", "length(keys) div 4 k").collect():
            sizes.append((r.bucket, r.w + meet.ROW_BYTES + r.k * meet.ENTRY_BYTES))
        return real(rows, p, q)

    monkeypatch.setattr(match, "jaccard_candidates", spy)
    rows = _texts(400, 9)
    left, right = (spark.createDataFrame(rows[i::2], "id long, text string") for i in (0, 1))
    got = [(r.v2_id, r.lg_id) for r in match.jaccard_join(left, right, "id", "id", 0.5).collect()]
    want = _pairs(rows[0::2], rows[1::2], 0.5)
    assert len(got) == len(set(got)) and set(got) == want and want
    total = {}
    for bucket, size in sizes:
        total[bucket] = total.get(bucket, 0) + size
    assert len(total) > match.LEAST_BUCKETS and sum(total.values()) / len(total) < 22_000 and max(total.values()) < 60_000
    assert meet.buckets_for([(64, 10, 100)], 1, 96 << 20, 12) == 12
    assert meet.buckets_for([(128, 10**7, 10**9)], 1, 96 << 20, 12) < meet.buckets_for([(128, 10**8, 10**10)], 1, 96 << 20, 12)
