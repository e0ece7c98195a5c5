"""One driver query per operator, over its whole table, in the column form
that the driver compares. The rows come from the operators; the digest
columns are derived here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import align, bpe, cube_mix, embed_dedup, importance, langid, line_chunks, main_text, ngram_join, quality_gam, reply_trees, substring_dedup, winnowing
from tidewater.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> bytes:
    import public_tokenizers
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def _remainder(by: int):
    """crc32 of the document id as text, modulo ``by`` (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(by))


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality_gam.train(docs, labels.filter(_remainder(3) != 1))
    return quality_gam.score(docs, model).select(
        "doc_id", (_remainder(3) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                              "conv_id long, turn long, role string, text string"))
    out = reply_trees.format_paths(reply_trees.best_paths(reply_trees.chain(rows)))
    turns = reply_trees.read_back(F.col("formatted"))
    loss = F.array_join(reply_trees.read_loss(F.col("formatted"), F.col("loss_mask")), "")
    return out.select(
        F.col("conv").alias("conv_id"), F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
               .cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


_OP3_SQL = r"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, (length(role) + length(text)
        + length(role || chr(0) || text) - length(replace(role || chr(0) || text, '\', ''))
        + (length(role || chr(0) || text) - length(replace(role || chr(0) || text, '<s>', ''))) // 3
        + (length(role || chr(0) || text) - length(replace(role || chr(0) || text, '</s>', ''))) // 4
        + (length(role || chr(0) || text) - length(replace(role || chr(0) || text, '[INST]', ''))) // 6
        + (length(role || chr(0) || text) - length(replace(role || chr(0) || text, '[/INST]', ''))) // 7
        + 20) AS chars FROM r)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring_dedup.remove_repeats(docs)
    return out.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def derive(df: DataFrame) -> DataFrame:
        df = winnowing.add_fingerprint(df, "text", "fp")
        return df.withColumn("hs", winnowing.hashes(F.col("fp")))

    both = winnowing.with_next(docs, "doc_id", derive=derive)
    n = F.length("text")
    part = F.floor(n / 4).cast("int")
    both = both.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.left("text", n - part), F.left("next_text", part))).drop("text", "next_text", "next_fp")
    both = winnowing.add_fingerprint(both, "edited", "edited_fp").withColumn(
        "edited_hs", winnowing.hashes(F.col("edited_fp")))

    def digest(c: str):
        return F.lower(F.concat(F.lpad(F.hex(F.xxhash64(c)), 16, "0"), F.lpad(F.hex(F.xxhash64(c, F.lit(5))), 16, "0")))

    return both.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        digest("fp").alias("fingerprint"), digest("edited_fp").alias("edited_fingerprint"),
        winnowing.likeness(F.col("hs"), F.col("edited_hs")).alias("near_edited"),
        winnowing.likeness(F.col("hs"), F.col("next_hs")).alias("near_next"))


def op6_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return cube_mix.mix(docs).select(
        "doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, tokenizer_file(), ids_col="ids", decoded_col="decoded")
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_chunks.dedup(docs, counts=("n_lines", "n_removed"), extend=True)
    kept = F.coalesce("text", F.lit(""))
    return out.select("doc_id", "n_lines", "n_removed", F.length(kept).cast("long").alias("kept_chars"),
                      F.sha2(kept.cast("binary"), 256).alias("kept_sha256"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.filter(_remainder(5) != 0))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (_remainder(5) == 0).alias("held_out"), "lang_pred", "score")


def op10_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.dedup(table(spark, sf_dir, "embeddings"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` drawn towards ``benchmark``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.resample(docs, table(spark, sf_dir, "benchmark").select("text")).select(
        "doc_id", "n_features", "weight", "score", "rank")


_OP11_SQL = r"""
WITH steps AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i:
                 CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t),
texts AS (SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, NULL, text FROM benchmark),
found AS (SELECT side, id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts),
counted AS (SELECT side, id, word, count(*) AS n FROM found GROUP BY ALL),
words AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM counted)),
hashed AS (SELECT word, xor(list_reduce(list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket
           FROM words, steps),
buckets AS (SELECT bucket, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM counted JOIN hashed USING (word) GROUP BY bucket),
gains AS (SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * (CAST((SELECT coalesce(sum(s), 0) FROM buckets) AS DOUBLE) + 10000)
            / ((CAST(coalesce(s, 0) AS DOUBLE) + 1) * (CAST((SELECT coalesce(sum(t), 0) FROM buckets) AS DOUBLE) + 10000)))) AS BIGINT) AS gain FROM buckets),
weights AS (SELECT id, sum(n) AS n_features, sum(n * gain) AS weight
            FROM counted JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 0 GROUP BY id),
scored AS (SELECT d.doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
             CAST(coalesce(weight, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || CAST(d.doc_id AS VARCHAR)), 1, 8) AS BIGINT)
               + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
           FROM documents d LEFT JOIN weights w ON d.doc_id = w.id),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
             count(*) FILTER (n_features >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS "rank" FROM placed"""


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tokenizers over ``documents``, their groups and linked pairs."""
    files = align.Tokenizers(tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    files.open()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = align.align(docs, files).withColumn(
        "groups_sha256", F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")).drop("groups")
    return align.add_counts(materialize(found, "aligned", "parquet"), len(files.b_size)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all ``pages``."""
    return main_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


QUERIES = {
    "op13_main_text": op13_main_text,
    "op12_align": op12_align,
    "op11_importance": op11_importance,
    "op1_quality_gam": op1_quality_gam,
    "op8_line_chunks": op8_line_chunks,
    "op9_langid": op9_langid,
    "op10_embed_dedup": op10_embed_dedup,
    "op2_ngram_join": op2_ngram_join,
    "op3_reply_trees": op3_reply_trees,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_winnowing": op5_winnowing,
    "op6_cube_mix": op6_cube_mix,
    "op7_bpe": op7_bpe,
}

ORACLE: dict[str, str] = {
    "op3_reply_trees": _OP3_SQL,
    "op11_importance": _OP11_SQL,
}
