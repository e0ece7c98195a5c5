"""Property tests: Spark operators against plain-Python references on random inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewater.operators import dims, match

WORDS = ["a", "b", "c", "d", "e", "f", "g", "h", "the", "of"]
texts = st.lists(st.sampled_from(WORDS), min_size=0, max_size=8).map(" ".join)
SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**{**SETTINGS, "max_examples": 8})
@given(left=st.lists(texts, min_size=1, max_size=8), right=st.lists(texts, min_size=1, max_size=8),
       t=st.sampled_from([0.2, 0.34, 0.5, 0.75, 1.0]))
def test_jaccard_join_equals_brute_force(spark, left, right, t):
    ldf = spark.createDataFrame([(i, x) for i, x in enumerate(left)], "id long, text string")
    rdf = spark.createDataFrame([(100 + i, x) for i, x in enumerate(right)], "id long, text string")
    got = {(r.v2_id, r.lg_id): (r.n_left, r.n_right, r.jaccard_dist)
           for r in match.jaccard_join(ldf, rdf, "id", "id", t, cut_lineage=False).collect()}

    def reps(rows, base):
        out = {}
        for i, x in enumerate(rows):
            s = frozenset(x.split())
            if s:
                rep, cnt = out.get(s, (base + i, 0))
                out[s] = (min(rep, base + i), cnt + 1)
        return out
    ra, rb = reps(left, 0), reps(right, 100)
    want = {}
    for sa, (ia, ca) in ra.items():
        for sb, (ib, cb) in rb.items():
            d = 1.0 - len(sa & sb) / len(sa | sb)
            if d < t:
                want[(ia, ib)] = (ca, cb, d)
    assert got == want


@settings(**SETTINGS)
@given(days=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30), st.sampled_from(["x", "y", None])),
                     min_size=1, max_size=25, unique_by=lambda x: (x[0], x[1])))
def test_scd2_equals_python(spark, days):
    base = dt.date(2025, 1, 1)
    rows = [(k, base + dt.timedelta(days=d), v) for k, d, v in days]
    df = spark.createDataFrame(rows, "k int, day date, v string")
    key = lambda r: tuple((x is None, str(x)) for x in r)  # noqa: E731  (values may be None)
    got = sorted(map(tuple, dims.scd2_dimension(df, "k", "day", ["v"], sk_col=None).collect()), key=key)
    want = []
    for k in sorted({r[0] for r in rows}):
        seq = sorted((d, v) for kk, d, v in rows if kk == k)
        starts = [(d, v) for i, (d, v) in enumerate(seq) if i == 0 or seq[i - 1][1] != v]
        for i, (d, v) in enumerate(starts):
            nxt = starts[i + 1][0] if i + 1 < len(starts) else None
            end = nxt - dt.timedelta(days=1) if nxt else dt.date(9999, 12, 31)
            want.append((k, v, d, end, nxt is None))
    assert got == sorted(want, key=key)


@settings(**SETTINGS)
@given(days=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 25), st.sampled_from(["x", "y", None]), st.booleans()),
                     min_size=1, max_size=30, unique_by=lambda x: (x[0], x[1], x[3])))
def test_scd2_refresh_equals_a_full_rebuild(spark, days):
    """Late, early, repeated and new days of known and unknown keys."""
    base = dt.date(2025, 1, 1)
    old = {(k, base + dt.timedelta(days=d)): v for k, d, v, late in days if not late}
    new = {(k, base + dt.timedelta(days=d)): v for k, d, v, late in days if late}
    frame = lambda x: spark.createDataFrame([(*k, v) for k, v in x.items()], "k int, day date, v string")
    key = lambda r: tuple((x is None, str(x)) for x in r)
    dim = dims.scd2_dimension(frame(old), "k", "day", ["v"])
    got = dims.scd2_refresh(dim, frame(old), frame(new), "k", "day", ["v"])
    full = dims.scd2_dimension(frame({**old, **new}), "k", "day", ["v"]).select(*got.columns)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, full.collect()), key=key)


PIECES = ["from ", "FROM ", "join ", "JOIN ", "(", "select 1 ", '"', "`", ".", "a", "b1", "sys",
          "information_schema", "unnest", "json_table", "x_y", "$", " ", "\n"]


@settings(**SETTINGS)
@given(queries=st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), min_size=1, max_size=6))
def test_table_refs_equal_python_regex(spark, queries):
    import re

    from tidewater.functions.sqlrefs import REJECT_PREFIXES, SYSTEM_SCHEMA, TABLE_REF
    from tidewater.operators import usage

    rows = [(f"q{i}", "2025-07-01T00:00:00Z", q) for i, q in enumerate(queries)]
    df = spark.createDataFrame(rows, "qid string, submitted string, query string")
    got = sorted((r.qid, r.tbl) for r in usage.query_table_refs(df).collect())
    want = set()
    for qid, _, q in rows:
        for raw in re.findall(TABLE_REF, q.lower()):
            if raw.startswith(REJECT_PREFIXES) or re.match(SYSTEM_SCHEMA, raw):
                continue
            t = re.sub(r'[`"]', "", raw)
            parts = t.split(".")
            want.add((qid, ".".join(parts[1:]) if len(parts) == 3 else t))
    assert got == sorted(want)
