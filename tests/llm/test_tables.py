"""Reply trees, source mixing, embedding dedup, components, the pipeline."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.util import documents, frame
from tidewater.llm import cube_mix, embed_dedup, langid, line_chunks, ngram_join, queries, reply_trees
from tidewater.llm.components import connected_components
from tests.oracle_check import compare


# ---------------------------------------------------------------- reply trees

NODES = "conv long, node long, parent long, role string, text string, score double"


def _best(nodes, n=1):
    """Per conversation: the node lists of the ``n`` best root-to-leaf paths."""
    by = defaultdict(dict)
    for c, i, p, _, _, s in nodes:
        by[c][i] = (p, s or 0.0)
    out = {}
    for c, tree in by.items():
        parents, paths = {p for p, _ in tree.values()}, []
        for leaf in tree:
            if leaf in parents:
                continue
            path, at = [], leaf
            while at in tree and at not in path:
                path.append(at)
                at = tree[at][0]
            if at is None or at not in tree:
                paths.append((-sum(tree[i][1] for i in path), leaf, path[::-1]))
        if paths:
            out[c] = [p for _, _, p in sorted(paths)[:n]]
    return out


@pytest.mark.parametrize("branches", [1, 2, None])
def test_best_branches(spark, branches):
    rng, nodes = random.Random(4), []
    for c in range(12):
        for i in range(rng.randint(1, 40)):
            nodes.append((c, i, rng.randrange(i) if i and rng.random() < 0.95 else None, "user", f"t{i}", rng.randint(0, 5) / 4))
    nodes += [(50, i, i - 1 if i else None, None, None, None) for i in range(130)]  # a long chain
    nodes += [(60, 1, 2, "user", "cycle", 1.0), (60, 2, 1, "user", "cycle", 1.0), (61, 5, 99, "user", "orphan", 0.0)]
    got = defaultdict(list)
    for r in reply_trees.best_paths(spark.createDataFrame(nodes, NODES), branches).collect():
        got[(r.conv, r.rank)].append((r.pos, r.leaf, r.text))
    want = _best(nodes, branches or 10**6)
    assert {c for c, _ in got} == set(want)
    texts = {(c, i): t for c, i, _, _, t, _ in nodes}
    for c, paths in want.items():
        found = sorted([t for _, _, t in sorted(v, key=lambda x: x[0])] for (cc, _), v in got.items() if cc == c) if c != 50 else None
        if found is not None:
            assert found == sorted([texts[(c, i)] for i in p] for p in paths), c
    assert len(got[(50, 1)]) == 130


def test_template_reads_back(spark):
    rng = random.Random(1)
    bits = ["\\", "<", "s>", "</s>", "<s>", "[INST]", "[/INST]", "[", "INST]", "/", "ok ", "\n", "é", "😀", "\\<s>", "<\\s>", ""]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "", None, "[INST]"]),
             rng.choice([None, "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))]))
            for c in range(150) for t in range(rng.randint(1, 5))]
    rows += [(None, 0, "assistant", "no conversation id"), (7, 0, "assistant", "a repeated turn"), (7, 0, "assistant", "a repeated turn")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {"conv": F.lit(1), "node": F.lit(2), "pos": F.lit(3)})
    out = reply_trees.format_paths(reply_trees.best_paths(reply_trees.chain(df)))
    out = out.withColumn("turns", reply_trees.read_back(F.col("formatted"))).withColumn(
        "loss", reply_trees.read_loss(F.col("formatted"), F.col("loss_mask"))).collect()
    want = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[1], (r[2] is not None, r[2] or ""), (r[3] is not None, r[3] or ""))):
        want[c].append((r or "", x or ""))
    assert {r.conv for r in out} == set(want)
    for r in out:
        assert [tuple(t) for t in r.turns] == want[r.conv]
        assert r.loss == [x for role, x in want[r.conv] if role == "assistant"]
        for m, x in zip(r.loss_mask, r.loss):  # absolute code points of the mask
            raw = r.formatted[m.start:m.start + m.length]
            assert raw.count("</s>") == 0 and len(raw) >= len(x)


def test_trees_empty(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert reply_trees.format_paths(reply_trees.best_paths(reply_trees.chain(empty))).collect() == []


def test_queries_with_sql_match_duckdb(spark):
    res = compare(spark, "/root/testdata/sf0.001", sorted(queries.ORACLE))
    assert all(v.startswith("OK") for v in res.values()), res


# ---------------------------------------------------------------- mixing

def _goal(sizes, share=1.5, weights=(5, 2, 1), most=2.0):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        level = left / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > most * sizes[s] + 1e-9]
        if not over:
            target.update({s: level * w[s] for s in free})
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            free.discard(s)
    return target


def _sources(seed=0, n=700):
    rng = random.Random(seed)
    names = ["src1", "src10", "src2", "ü", "a", None]
    rows = [(i, "w " * rng.choice([0, 1, 3, 40, 90, 400]), names[min(rng.randrange(9), 5)]) for i in range(n)]
    return rows + [(5, None, "src1"), (6, "w w", "only zero"), rows[30], rows[30]]


def test_mix_meets_its_targets_and_reruns_agree(spark):
    rows = _sources()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"size": F.lit(9), "p": F.lit(1), "h": F.lit(2)})
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    goal, took = _goal(sizes), defaultdict(int)
    runs = [sorted((r.doc_id, r.size, r.h, r.target, r.copies) for r in cube_mix.mix(df.repartition(n)).collect()) for n in (1, 7)]
    assert runs[0] == runs[1] and len(runs[0]) == len(rows)
    taken = cube_mix.take(df, cube_mix.mix(df))
    assert taken.columns == df.columns
    for r in taken.collect():
        took[r.source] += len((r.text or "").split())
    for s in sizes:
        assert abs(took[s] - goal[s]) <= max(0.05 * goal[s], 3), s
    assert all(c in (0, 1, 2) for *_, c in runs[0])
    assert sum(c for *_, c in runs[0]) == taken.count()


def test_flight_keeps_both_totals_and_landing_is_small():
    rng = np.random.default_rng(2)
    for _ in range(20):
        size, p = rng.integers(0, 300, 200).astype(float), rng.random(200)
        out = cube_mix.flight(size, p, rng)
        assert ((out > 0) & (out < 1)).sum() <= 2
        assert out.sum() == pytest.approx(p.sum(), abs=1e-6) and (out * size).sum() == pytest.approx((p * size).sum(), abs=1e-4)
        assert set(cube_mix.land(size, out)) <= {0.0, 1.0}
    hits = np.mean([cube_mix.flight(np.array([3.0, 5.0, 9.0, 2.0, 7.0, 7.0]), np.full(6, 0.4), np.random.default_rng(s)) for s in range(4000)], axis=0)
    assert np.abs(hits - 0.4).max() < 0.03  # probabilities are kept on average


def test_mix_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(cube_mix, "BLOCK", 16)
    monkeypatch.setattr(cube_mix, "MEET", 4)
    rows = _sources(3, 900)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = cube_mix.mix(df).groupBy("source_size", "target").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.count("*").alias("n"))
    assert sum(r.n for r in got.collect()) == len(rows)
    assert all(abs(r.taken - r.target) <= max(0.05 * r.target, 3) for r in got.collect())
    empty = df.limit(0)
    assert cube_mix.mix(empty).collect() == [] and cube_mix.take(empty, cube_mix.mix(empty)).collect() == []


# ---------------------------------------------------------------- embeddings and components

def _vectors(seed=0, dim=24):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(300):
        rows.append((i, rng.normal(size=dim).tolist()))
    for i in range(300, 420):
        base = np.array(rows[rng.integers(0, 40)][1])
        rows.append((i, (base * rng.uniform(0.1, 4) + rng.normal(size=dim) * rng.uniform(0, 0.12) * np.linalg.norm(base) / dim**0.5).tolist()))
    rows += [(500 + i, rows[7][1]) for i in range(40)]  # exact copies
    rows += [(600, None), (601, [0.0] * dim), (602, [float("nan")] + [1.0] * (dim - 1)), (603, [float("inf")] + [1.0] * (dim - 1)),
             (604, []), (605, [1.0, 2.0]), (606, [2.0, 4.0]), (607, [None] + [1.0] * (dim - 1)), (None, rows[7][1]), (3, rows[3][1])]
    return rows


@pytest.mark.parametrize("dim", [64, 384])
def test_share_of_near_pairs_that_meet(dim):
    """Random pairs at a cosine of 0.95, by the number of parts of a code."""
    rng = np.random.default_rng(3)
    x, z = (rng.normal(size=(1500, dim)) for _ in range(2))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.9501 * x + (1 - 0.9501**2) ** 0.5 * z
    for parts in (1, 2, 3):
        a, b = (embed_dedup.codes(v, 8, parts, 3) for v in (x, y))
        met = (a[:, :, :, None] == b[:, :, None, :]).any(axis=(1, 2, 3))
        assert met.mean() >= 0.99, (parts, met.mean())


def test_embed_dedup_of_one_bucket_of_unlike_vectors(spark, monkeypatch):
    """All classes in one bucket, cut into blocks: pairs are compared in full."""
    monkeypatch.setattr(embed_dedup, "codes", lambda x, tables, parts, probes: np.zeros((len(x), tables, probes), dtype=np.int64))
    rng = np.random.default_rng(1)
    base = rng.normal(size=(120, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(1000 + i, (2 * base[i]).tolist()) for i in range(0, 120, 4)]
    got = embed_dedup.dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=10).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {
        **{i: (int(i % 4 == 0), i) for i in range(120)}, **{1000 + i: (1, i) for i in range(0, 120, 4)}}


@pytest.mark.parametrize("kind,block", [("float", 512), ("double", 8)])
def test_embed_dedup_against_all_pairs(spark, kind, block):
    rows = _vectors()
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumns({"rep": F.lit(1), "n": F.lit(2), "kept": F.lit(3)})
    good = [(i, np.array(v, dtype=np.float32 if kind == "float" else float).astype(float)) for i, v in rows
            if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links, parent = defaultdict(int), list(range(len(good)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    total = 0
    for x in range(len(good)):
        for y in range(x):
            a, b = good[x][1], good[y][1]
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95:
                links[x] += 1
                links[y] += 1
                total += 1
                parent[find(x)] = find(y)
    got = embed_dedup.dedup(df, block=block)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    rows_out = got.collect()
    assert len(rows_out) == len(rows)
    found = sum(r.n_links for r in rows_out) / 2
    least = defaultdict(lambda: 1 << 60)
    for x, (i, _) in enumerate(good):
        least[find(x)] = min(least[find(x)], i)
    assert found == total
    want = sorted((i, links[x], least[find(x)]) for x, (i, _) in enumerate(good))
    bad = {600, 601, 602, 603, 604, 607, None}
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in rows_out if r.vec_id not in bad) == want
    for r in rows_out:
        if r.vec_id in (600, 601, 602, 603, 604, 607, None):
            assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)
        else:
            assert r.kept == (r.vec_id == r.component_id)


def test_embed_dedup_empty(spark):
    assert embed_dedup.dedup(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 2000 + i) for i in range(50)] + [(5000, 5000), (None, 3), (7, None)]
    links += [(rng.randrange(3000, 3100), rng.randrange(3000, 3100)) for _ in range(60)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(parent)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark, tmp_dir):
    import corpus_pipeline as P
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "near_duplicates", "mix_sources", "encode"]
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = [(10_000, None, None, None, None), (10_001, "12 34", "en", "src0", 5), (10_002, "", "fr", None, 0)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumns({
        c: F.lit(c) for c in ("own", "key", "k", "r", "h", "n", "i", "copies", "one", "lang_pred", "score", "cut", "later", "nth",
                              "__own", "__h", "__k", "__key", "__lang", "__score", "_own", "_h")})
    for i, (name, stage) in enumerate(P.STAGES):
        before = docs
        out = stage(spark, docs, sf)
        if name != "encode":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_dir}/{name}")
        docs = spark.read.parquet(f"{tmp_dir}/{name}")
        n0, n1 = before.count(), docs.count()
        if name == "language_id":
            assert n1 == 200 and docs.filter("doc_id >= 10000").count() == 0
        if name == "line_dedup":
            want = {(r.doc_id, r.text) for r in line_chunks.dedup(before.select("doc_id", "text"), extend=True).collect()}
            assert n0 == n1 and {(r.doc_id, r.text) for r in docs.collect()} == want
            assert docs.filter("n_chars != length(text)").count() == 0
        if name == "near_duplicates":
            comp = ngram_join.near_duplicates(before.select("doc_id", "text"))
            assert {r.doc_id for r in docs.collect()} == {r.component_id for r in comp.collect()}
        if name == "mix_sources":
            want = {r.doc_id: r.copies for r in cube_mix.mix(before.select("doc_id", "text", "source")).collect() if r.copies}
            assert {r.doc_id: r["count"] for r in docs.groupBy("doc_id").count().collect()} == want
        if name == "encode":
            from tokenizers import Tokenizer
            import public_tokenizers
            lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            texts = {r.doc_id: r.text for r in before.collect()}
            assert n0 == n1
            for r in docs.collect():
                assert np.frombuffer(r.ids, "<u4").tolist() == lib.encode(texts[r.doc_id] or "", add_special_tokens=False).ids


def test_pipeline_on_an_empty_table(spark, tmp_dir):
    import corpus_pipeline as P
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        stage(spark, docs, "").write.parquet(f"{tmp_dir}/{name}")
        docs = spark.read.parquet(f"{tmp_dir}/{name}")
        assert docs.count() == 0
