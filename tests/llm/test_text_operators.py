"""Substring dedup, n-gram join, winnowing, line chunks: against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.util import documents, frame, key, words
from tidewater.llm import bpe, cube_mix, langid, line_chunks, ngram_join, quality_gam, queries, substring_dedup, vec, winnowing


def _words(text):
    return (text or "").encode().split()


# ---------------------------------------------------------------- substring dedup

def _cut(rows, width):
    seen = Counter(tuple(w[i:i + width]) for _, t in rows for w in [_words(t)] for i in range(len(w) - width + 1))
    out = []
    for i, t in rows:
        w = _words(t)
        gone = [False] * len(w)
        for a in range(len(w) - width + 1):
            if seen[tuple(w[a:a + width])] > 1:
                gone[a:a + width] = [True] * width
        kept = b" ".join(x for x, g in zip(w, gone) if not g).decode()
        out.append((i, kept if t is not None else None, len(w), sum(gone)))
    return sorted(out, key=key)


@pytest.mark.parametrize("width,seed", [(35, 1), (35, 2), (8, 3)])
def test_substring_dedup_equals_brute_force(spark, width, seed):
    rows = documents(seed)
    got = substring_dedup.remove_repeats(frame(spark, rows), width=width).collect()
    assert sorted(map(tuple, got), key=key) == _cut(rows, width)


def test_substring_dedup_empty_and_clashing_columns(spark):
    assert substring_dedup.remove_repeats(frame(spark, [])).collect() == []
    df = frame(spark, documents()).withColumns({c: F.lit(1) for c in ("own", "to", "n_words", "starts", "name")})
    out = substring_dedup.remove_repeats(df)
    assert out.columns == ["doc_id", "text", "own", "to", "starts", "name", "n_words", "n_removed"]
    assert out.count() == len(documents())


def test_symbols_of_equal_stretches_agree():
    """Inside a stretch that two texts share, every symbol whose range lies in
    the stretch stands in both."""
    rng, some = np.random.default_rng(3), 0
    for _ in range(30):
        shared = [f"w{rng.integers(6)}" for _ in range(40)]
        found = []
        for n in (7, 11):
            text = " ".join([f"w{rng.integers(6)}" for _ in range(n)] + shared + [f"w{rng.integers(6)}" for _ in range(5)])
            p = substring_dedup.Parse(*vec.buffer(pa.array([text])))
            inside = (p.low >= n) & (p.high <= n + 40)
            found.append({(int(a), int(b) - n) for a, b in zip(p.name[inside], p.first[inside])})
        assert found[0] == found[1]
        some += len(found[0])
    assert some > 30


# ---------------------------------------------------------------- n-gram join

def _components(rows, k=5):
    sets = []
    for i, t in rows:
        raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())
        w = raw.split()
        sets.append((i, frozenset(tuple(w[a:a + k]) for a in range(len(w) - k + 1)) if len(w) >= k
                     else frozenset([tuple(w)] if w else [])))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(x)] = find(y)
    least = defaultdict(lambda: 1 << 62)
    for x in range(len(sets)):
        least[find(x)] = min(least[find(x)], sets[x][0])
    return sorted((i, len(s), least[find(x)]) for x, (i, s) in enumerate(sets))


@pytest.mark.parametrize("seed", [1, 5])
def test_ngram_join_equals_brute_force(spark, seed):
    rows = documents(seed, 80)
    got = ngram_join.near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == _components(rows)


def test_ngram_join_chains_and_borders(spark):
    """Chains of copies, each a bit further away; pairs right at 3/4."""
    rows, base = [], [f"w{i}" for i in range(104)]
    for i in range(30):
        w = list(base)
        for j in range(i):
            w[3 * j] = f"v{j}"
        rows.append((100 + i, " ".join(w)))
    four = ["a b c d e", "a b c d e f", "a b c d e f g", "A B c d e f g h", "a b c d e f g h i"]
    rows += [(i, t) for i, t in enumerate(four)]
    got = ngram_join.near_duplicates(frame(spark, rows)).collect()
    assert sorted(map(tuple, got)) == _components(rows)


def test_ngram_join_empty_and_keep_one(spark):
    assert ngram_join.near_duplicates(frame(spark, [])).collect() == []
    df = frame(spark, documents()).withColumns({"own": F.lit(1), "component_id": F.lit(2), "n": F.lit(3)})
    kept = ngram_join.keep_one(df, ngram_join.near_duplicates(df.select("doc_id", "text")))
    assert kept.columns == df.columns
    want = {i for i, _, c in _components(documents()) if i == c}
    assert {r.doc_id for r in kept.collect()} == want


def test_ngram_join_null_ids(spark):
    """A row without id has none in the result and names no component that has another id."""
    a, b, c = (" ".join(words(random.Random(i), 50)) for i in range(3))
    rows = [(None, a), (7, a), (None, b), (None, b + " end"), (3, c), (None, ""), (None, None), (2, "")]
    got = ngram_join.near_duplicates(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted(
        [(None, 7), (7, 7), (None, None), (None, None), (3, 3), (None, None), (None, None), (2, 2)], key=str)


def test_sketch_bounds_the_difference():
    """The bound never exceeds the distance, whatever the sizes, and is near it for small ones."""
    rng = np.random.default_rng(3)
    sets = []
    for n in (0, 1, 5, 60, 300, 900, 4000):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        sets += [np.unique(base), np.unique(np.concatenate((base[n // 4:], rng.integers(0, 1 << 63, n // 3 + 1, dtype=np.uint64))))]
    sketches = [ngram_join._sketch(x) for x in sets]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    bound = ngram_join._sketch_bound(sketches, sketches, i, j)
    apart = np.array([len(np.setxor1d(sets[x], sets[y])) for x, y in zip(i, j)])
    assert (bound <= apart).all()
    one = ngram_join._sketch_bound(sketches[6:7], sketches[7:8], np.zeros(1, int), np.zeros(1, int))[0]
    assert one >= 0.7 * len(np.setxor1d(sets[6], sets[7]))


def test_ngram_join_on_a_template_makes_few_candidates(spark, monkeypatch):
    """Documents that share 60 of 84 words link with nothing; four times as many
    documents may not make more than six times the candidates."""
    counts, inner = [], ngram_join._candidates

    def counted(*args):
        out = inner(*args)
        counts.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "_candidates", counted)
    for n in (400, 1600):
        rng = random.Random(n)
        shared = words(random.Random(0), 60)
        rows = [(i, " ".join(shared[:30] + [f"a{rng.randrange(1 << 30)}" for _ in range(12)] + shared[30:]
                             + [f"b{rng.randrange(1 << 30)}" for _ in range(12)])) for i in range(n)]
        got = ngram_join.near_duplicates(frame(spark, rows)).collect()
        assert all(r.component_id == r.doc_id for r in got)
    assert counts[1] <= max(6 * counts[0], 100), counts


def test_keep_one_keeps_one_row_of_a_component(spark):
    """Repeated rows, one id with two texts, and rows without an id."""
    rng = random.Random(8)
    a, b, c, d, e = (" ".join(words(rng, 60)) for _ in range(5))
    rows = [(1, a), (1, a), (2, a), (3, a + " more"), (3, b), (4, b), (5, c), (5, d), (5, d)]  # 3 and 5 have two texts each
    rows += [(None, e), (None, e), (None, e + " more"), (None, "a text of its own"), (9, e), (6, ""), (6, ""), (7, None)]
    rows += [(None, ""), (None, None), (None, "")]
    want = [(1, a), (3, b), (5, c), (5, d), (None, "a text of its own"), (6, ""), (7, None), (None, ""), (None, None), (None, "")]
    df = frame(spark, rows).withColumns({"own": F.lit(1), "row": F.lit("r"), "component": F.lit(2), "k": F.rand(1)})
    for classes in (ngram_join.near_duplicates(df, rows=True), ngram_join.near_duplicates(df)):
        out = ngram_join.keep_one(df, classes)
        got = [(r.doc_id, r.text) for r in out.collect()]
        assert out.columns == df.columns
        kept_e = [x for x in got if x[1] in (e, e + " more")]
        assert len(kept_e) == 1 and kept_e[0][0] is None
        assert sorted((x for x in got if x not in kept_e), key=key) == sorted(want, key=key)


# ---------------------------------------------------------------- winnowing

def _winnow(hashes, k, w):
    """Least k-gram hash of every window, the rightmost of equal ones, as (hash, position)."""
    m = (1 << 64) - 1
    turn = lambda x, s: ((x << s) | (x >> (64 - s))) & m if s else x
    u = [h & m for h in hashes]
    if not u:
        return []
    low = (1 << winnowing.POSITION_BITS) - 1
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    grams = []
    for i in range(len(u) - k + 1):
        x = 0
        for j in range(k):
            x ^= turn(u[i + j], 13 * j % 64)
        grams.append(signed(x & ~low & m) >> winnowing.POSITION_BITS)
    out = []
    for i in range(max(1, len(grams) - w + 1)):
        part = grams[i:i + w]
        best = max(j for j, x in enumerate(part) if x == min(part))
        if (part[best], i + best) not in out:
            out.append((part[best], i + best))
    return out


def test_winnowing_equals_brute_force(spark):
    rows = documents(4) + [(500, "t u v w " * 12)]
    df = frame(spark, rows)
    df = df.withColumn("h", F.transform(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != ""),
                                        lambda x: F.xxhash64(x)))
    for k, w in ((4, 4), (3, 5)):
        got = winnowing.add_fingerprint(df, k=k, w=w).withColumn("p", winnowing.positions(F.col("fingerprint"))) \
            .withColumn("s", F.transform("fingerprint", lambda x: F.shiftright(x, winnowing.POSITION_BITS))).collect()
        for r in got:
            if len(r.h) >= k:
                assert list(zip(r.s, r.p)) == _winnow(r.h, k, w), r.doc_id
            else:
                assert len(r.fingerprint) == (1 if r.h else 0)


def test_winnowing_finds_every_long_shared_stretch(spark):
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(20)) + " s1 s2 s3 s4 s5 s6 s7 " + " ".join(f"e{i}w{j}" for j in range(9)))
            for i in range(12)]
    got = winnowing.add_fingerprint(frame(spark, rows)).select(winnowing.hashes(F.col("fingerprint")).alias("h")).collect()
    assert all(set(got[0].h) & set(r.h) for r in got)


def test_with_next_takes_the_next_document(spark):
    rows = documents(2)
    df = frame(spark, rows, 5).withColumns({c: F.lit(0) for c in ("bucket", "first", "b", "k")})
    got = winnowing.with_next(df, "doc_id").collect()
    order = sorted(rows, key=lambda r: (r[0], r[1] is not None, (r[1] or "").encode()))
    want = Counter((i, t, order[(j + 1) % len(order)][1] or None) for j, (i, t) in enumerate(order))
    assert Counter((r.doc_id, r.text, r.next_text or None) for r in got) == want
    assert winnowing.with_next(frame(spark, []), "doc_id").collect() == []
    one = winnowing.with_next(frame(spark, [(3, "alone")]), "doc_id").collect()
    assert [(r.text, r.next_text) for r in one] == [("alone", "alone")]


def test_one_id_spreads_over_ranges(spark):
    rng = random.Random(8)
    texts = [" ".join(words(rng, 4)) for _ in range(900)] + [None, "", None] + ["copy"] * 40
    rows = [(7, t) for t in texts] + [(None, t) for t in texts[:300]] + [(i, "k %d" % i) for i in range(20, 300)]
    df = frame(spark, rows, 4)
    keyed = df.select(F.coalesce("doc_id", F.lit(-5)).alias("k"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("t"))
    sizes = [r["count"] for r in winnowing.ranges_of(keyed, "k", "t", "b").groupBy("b").count().collect()]
    assert max(sizes) < len(rows) / 8 and len(sizes) > 10
    got = Counter((r.doc_id, r.text, r.next_text or None) for r in winnowing.with_next(df, "doc_id").collect())
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, (r[1] or "").encode()))
    assert got == Counter((i, t, order[(j + 1) % len(order)][1] or None) for j, (i, t) in enumerate(order))


CLASHING = ("own", "to", "key", "tie", "bucket", "next", "first", "least", "h", "n", "k", "i", "copies", "lang", "score", "known",
            "__own", "__to", "__h", "__k", "__key", "__lang", "__score", "__b", "__bucket", "__next", "__first", "__block",
            "_own", "_h", "fingerprint_h", "__fingerprint_h", "fingerprint_w2", "Salt", "part", "at", "weight", "label", "features",
            "name", "bits", "starts", "ends", "set", "size", "rank", "p", "n_source", "vec", "text_id", "place", "word", "words")


def _clashing(df):
    return df.withColumns({c: F.lit(c) for c in CLASHING if c not in df.columns})


def _applied(name, df):
    """The operator on a table (doc_id, text, ...) and the names of the columns that it makes."""
    import public_tokenizers
    file = lambda f: open(public_tokenizers.path(f), "rb").read()
    if name == "quality_gam":
        model = quality_gam.train(df, df.select("doc_id", F.pmod("doc_id", F.lit(2)).cast("int").alias("quality")))
        return quality_gam.score(df, model), {"score"}
    if name == "substring_dedup":
        return substring_dedup.remove_repeats(df), {"n_words", "n_removed"}
    if name == "add_fingerprint":
        return winnowing.add_fingerprint(df), {"fingerprint"}
    if name == "with_next":
        return winnowing.with_next(df, "doc_id", derive=winnowing.add_fingerprint), {"fingerprint", "next_text", "next_fingerprint"}
    if name == "take":
        docs = df.withColumn("source", F.lit("a"))
        return cube_mix.take(docs, cube_mix.mix(docs)), {"source"}
    if name == "bpe":
        return bpe.encode(df, file("byte_bpe_50k.json"), ids_col="ids", decoded_col="decoded"), {"ids", "decoded"}
    if name == "line_chunks":
        return line_chunks.dedup(df, extend=True), {"n_lines", "n_removed"}
    if name == "langid":
        model = langid.train(df.withColumn("lang", F.lit("x")))
        return langid.predict(df, model, lang_col="lang_pred", score_col="p_lang", known_col="p_known"), {"lang_pred", "p_lang", "p_known"}
    if name == "ngram_join":
        return ngram_join.keep_one(df, ngram_join.near_duplicates(df, rows=True)), set()
    raise KeyError(name)


@pytest.mark.parametrize("name", ["quality_gam", "substring_dedup", "add_fingerprint", "with_next", "take", "bpe", "line_chunks",
                                  "langid", "ngram_join"])
def test_clashing_columns_pass_through(spark, name):
    rows = documents(6, 40)
    df = _clashing(frame(spark, rows))
    out, made = _applied(name, df)
    assert set(df.columns) <= set(out.columns) and set(out.columns) - set(df.columns) <= made | {"n_lines", "n_removed"}
    got = out.select("doc_id", *[c for c in CLASHING if c not in made]).collect()
    assert all(r[c] == c for r in got for c in CLASHING if c not in made)
    if name not in ("take", "ngram_join"):
        assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    plain = _applied(name, frame(spark, rows))[0]
    for c in set(plain.columns) & (made | {"text"}):  # as without the columns
        same = [Counter(map(repr, (r[0] for r in x.select(c).collect()))) for x in (out, plain)]
        assert same[0] == same[1], c


def test_op5_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = {r.doc_id: r for r in queries.op5_winnowing(spark, sf).collect()}
    for j, (i, t) in enumerate(docs):
        q = len(t) // 4
        edited = t[:len(t) - q] + docs[(j + 1) % len(docs)][1][:q]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_next <= 1 and 0 <= got[i].near_edited <= 1
    same = defaultdict(set)
    for i, t in docs:
        same[t].add(got[i].fingerprint)
    assert all(len(v) == 1 for v in same.values())
    long = [got[i] for i, t in docs if len(t) > 400]
    assert np.mean([r.near_edited for r in long]) > 0.5 and np.mean([r.near_next for r in long]) < 0.05


# ---------------------------------------------------------------- line chunks

def _lines(rows, how=(2, 3, 2, 50)):
    window, average, least_lines, least_words = how
    chunks = []
    for n, (i, t) in enumerate(rows):
        data, offs = vec.buffer(pa.array([t], type=pa.string()))
        for no, (a, b, _, lines, words) in enumerate(zip(*line_chunks.chunk_spans(data, offs, window, average, least_words))):
            raw = data[a:b].tobytes()
            chunks.append((i, n, no, raw, raw.removesuffix(b"\n"), lines >= least_lines or words >= least_words))
    count = Counter(c[4] for c in chunks if c[5])
    return chunks, count


def test_line_chunks_equal_brute_force(spark):
    rows = documents(6, 50)
    passage = "first line of it\nsecond line of it here\nthird one\nfourth line\nfifth line, long enough\nsixth\n"
    rows += [(200 + i, f"own {i} a\nown {i} b\n{passage}tail {i}\nend {i}") for i in range(8)]
    rows += [(300, "l1\nl2\nl3"), (301, "l1\nl2\nl3\n"), (302, "word " * 60), (303, "head\n" + "word " * 60 + "\nfoot")]
    rows = [r for n, r in enumerate(rows) if r not in rows[:n]]
    chunks, count = _lines(rows)
    first = {}
    order = lambda c: (c[0], c[2])
    for c in sorted(chunks, key=order):
        if c[5]:
            first.setdefault(c[4], c[:3])
    want = defaultdict(bytes)
    for c in chunks:
        if not (c[5] and count[c[4]] > 1 and first[c[4]] != c[:3]):
            want[c[1]] += c[3]
    got = line_chunks.dedup(frame(spark, rows), counts=("n_lines", "n_removed")).collect()
    ids = Counter(i for i, _ in rows)
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and sum(r.n_removed for r in got) > 10
    for n, (i, t) in enumerate(rows):
        if ids[i] == 1:  # which of two rows of one id comes first is settled by a hash of the text
            assert by_id[i].text == (want[n].decode() if t is not None else None), i


def test_line_chunks_repeated_rows_empty_and_clashing_columns(spark):
    text = "\n".join(f"line {i} with words" for i in range(12))
    rows = [(1, text), (1, text), (2, text), (3, None), (4, "")]
    df = frame(spark, rows).withColumns({c: F.lit("x") for c in ("later", "wanted", "own", "key", "no")})
    out = line_chunks.dedup(df)
    assert out.columns == df.columns
    texts = sorted((r.text or "" for r in out.filter("doc_id < 3").collect()), key=len)
    assert texts[-1] == text and all(len(t) < len(text) for t in texts[:-1])
    assert [r.text for r in out.filter("doc_id >= 3").orderBy("doc_id").collect()] == [None, ""]
    assert line_chunks.dedup(frame(spark, [])).collect() == []


def _runs_cut(rows, least_lines=2, least_words=50):
    """Texts without the lines of any run that stands at an earlier place it does not overlap."""
    lines = [re.findall(r"[^\n]*\n|[^\n]+", t or "") for _, t in rows]
    first, gone = {}, [set() for _ in rows]
    for n in sorted(range(len(rows)), key=lambda n: rows[n][0]):
        bare = [x.removesuffix("\n") for x in lines[n]]
        for i in range(len(bare)):
            for j in range(i + 1, len(bare) + 1):
                run = "\n".join(bare[i:j])
                if j - i < least_lines and len(_words(run)) < least_words:
                    continue
                m, at = first.setdefault((j - i, run), (n, i))
                if m != n or at + (j - i) <= i:
                    gone[n].update(range(i, j))
    return ["".join(x for k, x in enumerate(line) if k not in gone[n]) for n, line in enumerate(lines)], [len(g) for g in gone]


def test_extended_chunks_against_repeated_runs(spark):
    """Against a brute force that knows no chunks: whatever goes belongs to a run
    of lines that stands earlier, and of such a run with a cut in it nothing stays."""
    rng = random.Random(4)
    rows = [(i, t) for i, t in documents(7, 40)]
    long, whole = "long " * 60, [" ".join(words(rng, rng.randint(2, 70))) for _ in range(30)]
    planted = []
    for i in range(30):  # passages of 2 to 15 lines between own lines
        a, n = rng.randint(0, 15), 2 + i % 14
        planted.append((100 + i, n))
        rows.append((100 + i, "\n".join([f"own {i}", *whole[a:a + n], f"end {i}"]) + "\n" * (i % 2)))
    rows += [(50, "\n".join(whole)), (201, "\n".join(whole) + "\n"), (202, "\n".join(["again"] * 5)), (203, "x\ny\nx\ny\nx"),
             (204, long), (205, f"head\n{long}\nfoot"), (206, "again\nagain"), (207, "\n\n\n\n"), (208, "one"), (209, "x\n"),
             (210, "p\nq"), (211, "p\nq\nr"), (212, "z\nq\nr\n")]
    ids = Counter(i for i, _ in rows)
    rows = [r for r in rows if ids[r[0]] == 1]  # which of two rows of one id comes first is settled by a hash of the text
    want, n_removed = _runs_cut(rows)
    got = {r.doc_id: r for r in line_chunks.dedup(frame(spark, rows), counts=("n_lines", "n_removed"), extend=True).collect()}
    plain = {r.doc_id: r for r in line_chunks.dedup(frame(spark, rows), counts=("n_lines", "n_removed")).collect()}
    assert len(got) == len(rows)
    for (i, t), least, n in zip(rows, want, n_removed):
        if t is None:
            assert got[i].text is None
            continue
        assert got[i].n_removed <= n and plain[i].n_removed <= got[i].n_removed
        rest = iter(got[i].text.split("\n"))
        assert all(x in rest for x in least.rstrip("\n").split("\n") if x), i  # no line goes that stands nowhere earlier
    assert got[201].n_removed == 30 and got[205].n_removed == 1
    whole_gone = [got[i].n_removed == n for i, n in planted]
    assert sum(whole_gone) >= 20 and all(x for x, (_, n) in zip(whole_gone, planted) if n >= 10), list(zip(whole_gone, planted))
    assert sum(r.n_removed for r in got.values()) > 1.2 * sum(r.n_removed for r in plain.values())


def test_extended_chunks_of_repeated_rows(spark):
    text = "\n".join(f"line {i} with words" for i in range(12))
    got = line_chunks.dedup(frame(spark, [(1, text), (1, text), (2, text), (None, "a\nb"), (None, "a\nb"), (3, "b")]), extend=True).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, ""), (0, "a\nb"), (1, ""), (1, text), (2, ""), (3, "b")]


def test_line_chunks_query(spark, tmp_dir):
    """A copy of a document goes whole; so does a shared passage unless there is
    no cut between its lines, which of 8 lines is so for (2/3)**7 = 6 of 100."""
    base = "\n".join(f"line {i} of it" for i in range(7))
    rows = [(1, base), (2, base)]
    for k in range(40):
        passage = "\n".join(f"short line {i} of {k}" for i in range(8))
        rows += [(10 + 2 * k + side, f"own {k} {side}\n{passage}\nend {k} {side}") for side in (0, 1)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = {r.doc_id: r for r in queries.op8_line_chunks(spark, tmp_dir).collect()}
    assert (got[1].n_removed, got[2].n_removed) == (0, 7)
    assert all(got[10 + 2 * k].n_removed == 0 for k in range(40))
    later = [got[11 + 2 * k].n_removed for k in range(40)]
    assert set(later) <= {0, 8} and later.count(8) >= 34
