"""The training-data pipeline over ``documents``.

``STAGES`` lists the stages in order; each takes (spark, docs, sf_dir) and
returns a DataFrame, which the caller writes as Parquet and reads back as the
next stage's ``docs``. All stages but the last return the columns of
``documents`` they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, cube_mix, langid, line_chunks, names, ngram_join
from tidewater.llm.queries import tokenizer_file
from tidewater.session import scratch_path

#: A document goes if no language is found in it, or if the model knows less
#: than this share of its n-grams of letters.
LEAST_KNOWN_SHARE = 0.75


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose text is in a language that the labels know: rows
    without text or letters go, and rows of whose n-grams of letters less than
    ``LEAST_KNOWN_SHARE`` bear a weight in the model (other scripts, distant
    languages, random letters). The share does not depend on how many languages
    there are, as a probability would. An empty table gives an empty result; a
    table without labels teaches no language, so every row goes."""
    model = langid.train(docs.select("doc_id", "text", "lang"))
    lang, score, known = names.free(docs, "lang_pred", "score", "known")
    scored = langid.predict(docs, model, lang_col=lang, score_col=score, known_col=known)
    return scored.filter((F.col(lang) != langid.UNKNOWN) & (F.col(known) >= LEAST_KNOWN_SHARE)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated chunks of lines out of the texts, as far as they repeat on
    both sides; ``n_chars`` follows. A document of which nothing is left stays,
    with an empty text."""
    out = line_chunks.dedup(docs, extend=True)
    if "n_chars" in out.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near copies, of least id."""
    return ngram_join.keep_one(docs, ngram_join.near_duplicates(docs.select("doc_id", "text"), rows=True))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take every document as often as the balanced mix of its source does."""
    return cube_mix.take(docs, cube_mix.mix(docs.select("doc_id", "text", "source")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (packed little-endian 32-bit integers)."""
    coded = bpe.encode(docs.select("doc_id", "source", "text"), tokenizer_file(), ids_col="ids")
    return coded.select("doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: Language scores, cube sampling and BPE are beyond SQL; the tests check the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to
    the shared scratch folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
