"""BPE against the tokenizers library; the trained models on held-out rows."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.util import documents, frame
from tidewater.llm import bpe, langid, quality_gam, queries

SF = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- BPE

@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def _same(library, texts):
    t = bpe.tables(queries.tokenizer_file())
    ids, offs = bpe.encode_texts(texts, t)
    want = [e.ids for e in library.encode_batch([x or "" for x in texts], add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(offs, offs[1:])] == want
    assert bpe.decode_ids(ids, offs, t) == [library.decode(x, skip_special_tokens=False) for x in want]


def test_bpe_equals_the_library_on_odd_texts(library):
    rng = random.Random(2)
    pieces = ["a", "aa", "aaaa", "  ", "\n", " '", "'s", "'ll", "<|endoftext|>", "<|endof", "é", "　", "\x1c", "\x85", "\xa0",
              "1", "２", "!", "日本", "\U0001f600", "\x00", "\t", "\r\n", "̈", "ª", " the", "the ", " ", "ing"]
    _same(library, ["", None, " ", "  ", "<|endoftext|>", "<|endoftext|><|endoftext|> x"])
    _same(library, ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(3000)])
    _same(library, ["the cat " * 5000, "a" * 20000, " " * 3000, "x" + " " * 99 + "y"])
    for batch in (["one"], ["<|endoftext|>"], [""], []):
        _same(library, batch)


def test_bpe_on_code_points(library):
    cps = [c for c in range(0x3000) if not 0xD800 <= c < 0xE000] + list(range(0x1F000, 0x1F700))
    _same(library, ["a" + chr(c) + "1 " + chr(c) + " b" for c in cps])


def test_bpe_memory_of_a_chunk(library):
    """A chunk takes less than 10 bytes for each byte of its texts, the texts aside."""
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(600)]
    t = bpe.tables(queries.tokenizer_file())
    tracemalloc.start()
    bpe.encode_texts(texts, t)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * sum(map(len, texts))
    _same(library, texts[:50])


def test_bpe_frames(spark, library):
    df = frame(spark, documents()).withColumns({"ids": F.lit(1), "decoded": F.lit("x"), "t": F.lit(2)})
    out = bpe.encode(df, queries.tokenizer_file(), decoded_col="decoded")
    assert out.columns == ["doc_id", "text", "t", "ids", "decoded"]
    rows = out.collect()
    assert len(rows) == len(documents())
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == (r.text or "")
    back = bpe.decode(out.select("doc_id", "ids"), queries.tokenizer_file(), text_col="again").collect()
    assert sorted((r.doc_id, r.again) for r in back) == sorted((r.doc_id, r.decoded) for r in rows)
    assert bpe.encode(frame(spark, []), queries.tokenizer_file()).collect() == []


# ---------------------------------------------------------------- language

def test_op9_on_held_out_rows(spark):
    lang = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n"))
    rows = queries.op9_langid(spark, SF).join(lang, "doc_id").collect()
    held = [r for r in rows if r.held_out and r.n > 30]
    assert len(rows) == 1000 and len(held) > 100
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_langid_cases(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.train(docs, sample_rows=400)
    odd = [(1, None), (2, ""), (3, "123 !!"), (4, "日本"), (5, "The and for with"), (5, "The and for with"), (6, "x" * 50_000)]
    df = frame(spark, odd).withColumns({"lang_pred": F.lit("q"), "score": F.lit(3), "lang": F.lit("zz")})
    out = langid.predict(df, model)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert [got[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert got[4][0] in model.langs and got[5][0] == "en" and out.count() == 7
    empty = docs.limit(0)
    none = langid.train(empty)
    assert none.langs == [] and langid.predict(empty, none).collect() == []
    assert {r.lang_pred for r in langid.predict(df, none).collect()} == {"und"}
    unlabelled = langid.train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert unlabelled.langs == []


def test_known_share_tells_unseen_languages_and_junk(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    floor = P.LEAST_KNOWN_SHARE
    rng = random.Random(3)
    junk = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(60))
    odd = ["W czasie gdy wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw",
           "Bütün insanlar hür haysiyet ve haklar bakımından eşit doğarlar akıl ve vicdana sahiptirler",
           "Все люди рождаются свободными и равными в своем достоинстве и правах", "人人生而自由在尊严和权利上一律平等",
           junk("abcdefghijklmnopqrstuvwxyz"), junk("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"), "123 456", "", None]
    clean = [r.text for r in docs.filter("doc_id % 5 = 0 AND text RLIKE '[a-z]'").collect()]
    extra = [(-1 - i, t) for i, t in enumerate(odd)] + [(10_000_000 + i, "+1 (236) 555-3833 4690149265297988 " + t) for i, t in enumerate(clean)]
    model = langid.train(docs.filter("doc_id % 5 != 0"))
    assert model.known(odd).max() < floor and model.known(odd)[-3:].tolist() == [0, 0, 0]
    assert model.known(clean).min() > floor
    assert model.known(["the " * 100_000])[0] == 1.0 and model.known([]).tolist() == []
    table = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    kept = {r.doc_id for r in P.language_id(spark, table, "").select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.collect()} | {10_000_000 + i for i in range(len(clean))}


def test_langid_trains_alike_whatever_the_partitioning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    a, b = (langid.train(d, sample_rows=60) for d in (docs.repartition(1), docs.repartition(5)))
    assert np.array_equal(a.weights, b.weights) and a.temperature == b.temperature


# ---------------------------------------------------------------- quality

def _auc(score, label):
    order = np.argsort(score, kind="stable")
    y = np.array(label)[order]
    return float((np.cumsum(1 - y) * y).sum() / max(y.sum() * (1 - y).sum(), 1))


def test_op1_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    got = queries.op1_quality_gam(spark, SF)
    assert got.count() == 1000 and got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(labels, "doc_id").filter("held_out AND quality IS NOT NULL").collect()
    assert _auc([r.score for r in rows], [r.quality for r in rows]) > 0.95
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_quality_cases(spark):
    df = frame(spark, documents()).withColumns({"score": F.lit("x"), "k": F.lit(1), "y": F.lit(2)})
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(10, 50)] + [(None, 1), (11, None), (12, 0)], "doc_id long, quality int")
    model = quality_gam.train(df.select("doc_id", "text"), labels, sample_rows=30)
    out = quality_gam.score(df, model)
    assert out.columns == ["doc_id", "text", "k", "y", "score"]
    rows = out.collect()
    assert len(rows) == len(documents()) and all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text, r.score) == r.score
    assert by_text[None] == by_text[""]
    for lab, share in ((labels.limit(0), 0.5), (labels.filter("quality = 1"), 1.0)):
        only = quality_gam.train(df.select("doc_id", "text"), lab)
        assert {round(r.score, 4) for r in quality_gam.score(df, only).collect()} == {share}
    assert quality_gam.score(frame(spark, []), model).collect() == []


def test_additive_model_learns_a_pair():
    """An exclusive-or of two features is beyond single tables and within a pair."""
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x, y, np.ones(len(y)), n_pairs=2)
    assert (0, 1) in [(i, j) for i, j, _ in model.pairs]
    assert np.mean((model.score(x) > 0.5) == y) > 0.95
    alone = quality_gam.fit(x, y, np.ones(len(y)), n_pairs=0)
    assert np.mean((alone.score(x) > 0.5) == y) < 0.7


def test_samples_are_bounded_whatever_the_ids(spark, monkeypatch):
    """One id, no id, or the same row on thousands of rows: about ``sample_rows``
    documents come to the driver, and not none."""
    texts = [" ".join(["the", "cat", f"sat{i}", "on", f"mat{i * 7}", "again."] * (1 + i % 5)) for i in range(4000)]
    for key in (7, None):
        docs = spark.createDataFrame([(key, t, "en" if i % 2 else "fr") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
        seen = []
        monkeypatch.setattr(langid, "_ftrl", lambda data, *a, real=langid._ftrl: seen.append(len(data)) or real(data[:50], *a))
        langid.train(docs, sample_rows=1000)
        assert 500 * 0.8 <= seen[0] <= 1100  # a fifth is held back for the temperature
        monkeypatch.undo()
    same = spark.createDataFrame([(1, "one text", "en")] * 3000 + [(2, "un texte", "fr")], "doc_id long, text string, lang string")
    assert langid.train(same, sample_rows=100).langs == ["en", "fr"]

    docs = spark.createDataFrame([(i % 3, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1)] * 4000 + [(1, 0)] * 300 + [(2, 1), (None, 0)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality_gam, "fit", lambda x, y, w, **how: seen.append((len(y), y.mean())))
    quality_gam.train(docs, labels, sample_rows=1000)
    assert 500 <= seen[0][0] <= 1150 and 0.3 < seen[0][1] < 0.7
