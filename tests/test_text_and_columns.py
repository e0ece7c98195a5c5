
from tidewater.functions import columns as C
from tidewater.functions.text import det_key, normalize_key, text_features, tokenize
from tests.fixtures import LEGACY, MASTER_V2, write


def _norm(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(normalize_key("s")).collect()]


def test_normalize_key_nfkc_lower_whitespace(spark):
    out = _norm(spark, ["ぐるっと世界(ｸﾞﾙｯﾄ)", "北丘投信B（株）", None, " A　b\tC\n",
                        "Ｆｕｎｄ　Ａ"])
    assert out == ["ぐるっと世界(グルット)", "北丘投信b(株)", "", "abc", "funda"]


def test_ascii_fast_path_matches_python(spark):
    import re
    import unicodedata
    vals = ["Plain ASCII\tText\x1cwith\x0bseps", "MiXeD Ünïcode  text", "", "   ", "a\u3000b", "x\x85y"]
    want = [re.sub(r"\s+", "", unicodedata.normalize("NFKC", v).lower()) for v in vals]
    assert _norm(spark, vals) == want


def test_distinct_values_are_normalised_once(spark, monkeypatch):
    """The dictionary has one row per different non-ASCII value of all fields, however
    often it stands there; one value is a third of all cells."""
    from tidewater.functions import text
    rows = [("Ｆｕｎｄ　Ａ", "Plain Co") if i % 3 else (f"株式 {i % 7}", "Ｆｕｎｄ　Ａ") for i in range(600)]
    rows += [(None, ""), ("", None), ("ABC d", "(ｸﾞﾙｯﾄ)" * 400), (" ", "\u3000")]
    df = spark.createDataFrame(rows, "key string, hot string").repartition(5)
    written, inner = [], text.materialize
    monkeypatch.setattr(text, "materialize", lambda d, *a: written.append(inner(d, *a)) or written[-1])
    got = text.normalize_distinct(df, ["key", "hot"])
    want = df.withColumns({"key_norm": normalize_key("key"), "hot_norm": normalize_key("hot")})
    assert got.columns == want.columns
    order = lambda r: tuple((x is None, x or "") for x in r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(map(tuple, want.collect()), key=order)
    values = [v for r in rows for v in r if v and not v.isascii()]
    assert [d.count() for d in written] == [len(set(values))]
    empty = text.normalize_distinct(df.limit(0), ["key", "hot"])
    assert empty.collect() == [] and empty.columns == want.columns
    keys = [sorted(r.det_key for r in det_key(df, ["key", "hot"], repeated=x).collect()) for x in (False, True)]
    assert keys[0] == keys[1]


def test_nfkc_makes_nicknames_equal(spark):
    a, b = _norm(spark, ["ぐるっと世界（グルット）", "ぐるっと世界(ｸﾞﾙｯﾄ)"])
    assert a == b


def test_det_key_and_empty_flag(spark):
    df = spark.createDataFrame(
        [("みなと成長株A", "港アセットA", "はばたき"), (None, " ", None)],
        "fund_name string, management_company string, nickname string")
    rows = det_key(df, ["fund_name", "management_company", "nickname"]).collect()
    assert rows[0]["det_key"] == "みなと成長株a_港アセットa_はばたき"
    assert rows[0]["det_key_empty"] is False
    assert rows[1]["det_key"] == "__" and rows[1]["det_key_empty"] is True


def test_tokenizer_drops_prolonged_sound_mark(spark):
    df = spark.createDataFrame([("先進国株式オープンq サーファー投信 世界(グルット)",)], "text string")
    toks = df.select(tokenize("text").alias("t")).first()["t"]
    assert toks == ["先進国株式", "オ", "プン", "q", "サ", "ファ", "投信", "世界", "グルット"]


def test_text_features_coalesces_nulls(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert text_features(df, ["x", "y", "z"]).first()["text"] == "a  c"


def test_rename_map_and_canonicalize(spark, tmp_dir):
    raw = spark.read.option("header", "true").csv(write(tmp_dir, "legacy.csv", LEGACY))
    en = C.rename_map(raw)
    assert en.columns == ["fund_id", "fund_category", "trust_fee_rate", "is_active", "fund_name",
                          "alias_name", "management_company", "hidden_cost", "internal_strategy_code"]
    canon = C.canonicalize_columns(en)
    assert "nickname" in canon.columns and "valid_flag" in canon.columns
    assert "alias_name" not in canon.columns
    direct = C.canonicalize_columns(raw)
    assert direct.columns == ["fund_id", "fund_category", "trust_fee_rate", "valid_flag", "fund_name",
                              "nickname", "management_company", "hidden_cost", "内部戦略コード"]


def test_alias_rules_skip_taken_names():
    m = C.resolve_aliases(["FundName", "fund_name", "Mgmt Company", "NICKNAME", "alias name"])
    # fund_name already exists; NICKNAME takes nickname first, so "alias name" keeps its name
    assert m == {"Mgmt Company": "management_company", "NICKNAME": "nickname"}
    m2 = C.resolve_aliases(["FundName", "alias name", "Fee_Rate_Pct", "取込日付"])
    assert m2 == {"FundName": "fund_name", "alias name": "nickname", "Fee_Rate_Pct": "trust_fee_rate",
                  "取込日付": "ingest_date"}


def test_casts_and_stamp(spark, tmp_dir):
    raw = spark.read.option("header", "true").csv(write(tmp_dir, "legacy.csv", LEGACY))
    df = C.bool_normalize(C.decimal_cast(C.rename_map(raw), ["trust_fee_rate", "hidden_cost"]), ["is_active"])
    df = C.stamp_ingest_date(df, "2025-07-01")
    types = dict(df.dtypes)
    assert types["trust_fee_rate"] == "decimal(5,2)" and types["hidden_cost"] == "decimal(5,2)"
    assert types["is_active"] == "boolean" and types["ingest_date"] == "date"
    r = df.orderBy("fund_id").first()
    assert str(r["hidden_cost"]) == "2.75" and r["is_active"] is True
    bad = spark.createDataFrame([("True",), ("False",), ("yes",), ("nope",), (None,)], "b string")
    assert [x[0] for x in C.bool_normalize(bad, ["b"]).collect()] == [True, False, True, None, None]
    assert [x[0] for x in C.decimal_cast(spark.createDataFrame([("x",), ("1.234",)], "d string"),
                                         ["d"]).collect()] == [None, __import__("decimal").Decimal("1.23")]


def test_master_csv_inference(spark, tmp_dir):
    df = spark.read.option("header", "true").option("inferSchema", "true").csv(
        write(tmp_dir, "fund_master_v2.csv", MASTER_V2))
    types = dict(df.dtypes)
    assert types["is_active"] == "boolean" and types["trust_fee_rate"] == "double"
    assert df.count() == 3


def test_rules_table_round_trip(spark, tmp_dir):
    rules = C.rules_frame(spark)
    assert rules.count() == 8 and rules.schema.simpleString() == \
        "struct<regex:string,canonical_name:string,priority:int>"
    raw = spark.read.option("header", "true").csv(write(tmp_dir, "legacy.csv", LEGACY))
    assert C.canonicalize_columns(raw, rules).columns == C.canonicalize_columns(raw).columns


def test_hashing_tf_equals_counting(spark):
    import hashlib
    from collections import Counter
    from tidewater.functions.text import hashing_tf
    rows = [(1, ["a", "b", "a", None, "名前"]), (2, []), (3, None), (4, [f"w{i % 700}" for i in range(3000)]), (4, ["a"])]
    df = spark.createDataFrame(rows, "sorted int, starts array<string>")
    for dims in (4, 512):
        out = hashing_tf(df, "starts", dims)
        assert out.columns == ["sorted", "starts", "indices", "counts"]
        for r, (k, tokens) in zip(out.collect(), rows):
            want = Counter(int(hashlib.md5(t.encode()).hexdigest()[:7], 16) % dims for t in tokens or [] if t is not None)
            assert r[0] == k and list(zip(r.indices, r.counts)) == sorted(want.items())
