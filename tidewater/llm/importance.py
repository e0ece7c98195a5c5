"""Importance resampling towards a target distribution, on hashed n-grams.

A batch of texts is one buffer with a separator between texts. One pass of a
regular expression over it finds all words; ``searchsorted`` on the texts'
offsets tells each word its text, and n-grams whose first and last word differ
in that are masked before ``bincount`` counts the buckets. The hash of an
n-gram is carried on word by word (CRC-32 of its words joined by one space),
so longer n-grams cost one step each.

Corpus and target are counted into ``buckets`` buckets; each task adds up its
own, so that a bucket is one row a task in the shuffle and ``buckets`` rows
reach the driver. A bucket's gain is its log likelihood ratio (add-one
smoothed), a document's weight the sum over its features. A Gumbel number
drawn from a hash of the id is added, and the highest scores are drawn: that
is sampling without replacement in proportion to the likelihood ratios, with
the same result on every run.

Defined cases: a null or empty text has no features and weight 0; a null id
counts as empty text in the draw; empty tables give empty results, and with an
empty target every gain comes from the smoothing alone. Texts are read whole,
whatever their length (a text longer than a chunk is a chunk of its own).
Rows of equal score are ranked by id, then by number of features, weight and
number of words, nulls last; rows alike in all of these take consecutive ranks. Extra columns pass through;
one that bears an output name is replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm import names, vec
from tidewater.session import materialize

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Words are digits, ASCII letters and everything beyond ASCII, here as UTF-8 bytes.
_WORDS = re.compile(rb"([0-9a-z\x80-\xff]+)")
_KNOWN_WORDS = 500_000  # a task's word memo is started afresh beyond this


class _Hashes(dict):
    """CRC-32 of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        out = self[word] = zlib.crc32(word)
        return out


def batch_features(texts: list[str | None], least: int, most: int, buckets: int,
                   known: dict | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number and bucket of each feature, number of words of each text)
    for the n-grams of ``least`` to ``most`` words."""
    known = _Hashes() if known is None else known
    raw = [t.encode("utf-8") if t else b"" for t in texts]
    begins = vec.lengths_to_offsets(np.fromiter((len(t) + 1 for t in raw), dtype=np.int64, count=len(raw)))
    parts = _WORDS.split(b"\0".join(raw).translate(_LOWER))  # gap, word, gap, word, ..., gap
    words = parts[1::2]
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)))
    doc = np.searchsorted(begins, ends[0:-1:2], side="right") - 1  # a word starts where the gap before it ends
    docs, found = [], []
    hashes = list(map(known.__getitem__, words))
    spaced = [b" " + w for w in words] if most > 1 else []
    for n in range(1, most + 1):
        if n > 1:
            hashes = list(map(zlib.crc32, islice(spaced, n - 1, None), hashes))
        if n >= least and hashes:
            own = doc[:len(hashes)] == doc[n - 1:]
            docs.append(doc[:len(hashes)][own])
            found.append((np.fromiter(hashes, dtype=np.uint32, count=len(hashes))[own] % np.uint32(buckets)).astype(np.int64))
    empty = np.zeros(0, dtype=np.int64)
    return (np.concatenate(docs) if docs else empty, np.concatenate(found) if found else empty,
            np.bincount(doc, minlength=len(texts)))


def bucket_counts(df: DataFrame, text_col: str = "text", least: int = 1, most: int = 1, buckets: int = 10_000) -> DataFrame:
    """(bucket, n) of all texts; buckets that nothing falls into are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros(buckets, dtype=np.int64), _Hashes()
        for part in vec.chunks(batches, text_col):
            _, found, _ = batch_features(part.column(0).to_pylist(), least, most, buckets, known)
            total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    return df.select(text_col).mapInArrow(vec.trimmed(run), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _collected(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, dtype=np.int64)
    for r in counts.collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: DataFrame, target: DataFrame, buckets: int = 10_000, scale: float = 1000.0) -> np.ndarray:
    """floor(scale * log likelihood ratio) of each bucket, from two tables of :func:`bucket_counts`."""
    s, t = _collected(corpus, buckets), _collected(target, buckets)
    ratio = (t + 1.0) * float(s.sum() + buckets) / ((s + 1.0) * float(t.sum() + buckets))
    return np.floor(scale * np.log(ratio)).astype(np.int64)


def weigh(df: DataFrame, gain: np.ndarray, text_col: str = "text", least: int = 1, most: int = 1) -> DataFrame:
    """All columns of ``df`` but the text, plus n_words, n_features and weight (longs)."""
    outs = ["n_words", "n_features", "weight"]
    kept = [f for f in df.schema.fields if f.name not in (text_col, *outs)]
    cols = [f.name for f in kept]
    schema = T.StructType(kept + [T.StructField(c, T.LongType()) for c in outs])
    buckets = len(gain)
    shared = df.sparkSession.sparkContext.broadcast(gain)  # 8 bytes a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for part in vec.chunks(batches, text_col):
            doc, found, n_words = batch_features(part.column(text_col).to_pylist(), least, most, buckets, known)
            n = np.bincount(doc, minlength=part.num_rows)
            order = np.argsort(doc, kind="stable") if most > least else slice(None)
            total = np.concatenate(([0], np.cumsum(shared.value[found[order]])))
            ends = np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in cols] + [pa.array(x.astype(np.int64)) for x in (n_words, n, total[ends] - total[ends - n])],
                names=cols + outs)

    return df.select(*cols, text_col).mapInArrow(vec.trimmed(run), schema)


def gumbel(key_col: str, seed: int = 2024, scale: float = 1000.0):
    """floor(scale * a Gumbel number) of a row, from the hash of ``seed:key``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-scale) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def draw(df: DataFrame, key_col: str = "doc_id", percent: int = 10, least_words: int = 20) -> DataFrame:
    """All rows of ``df`` (columns n_words, n_features, weight, score) plus
    ``rank``: 1, 2, 3... of the floor(percent * N / 100) highest scores among
    the N rows of ``least_words`` words or more, null for the others.

    The order is global without a single task that holds it: rows are dealt
    out by ranges of the score, numbered in their partition, and a partition's
    first number is the sum of the sizes before it. Rows alike in score and id
    are spread by where they stand in the table written first, so that ties do
    not pile up in one range."""
    df = df.drop("rank")
    salt, part, at, first = names.free(df, "salt", "part", "at", "first")
    stored = materialize(df, "weighed", "parquet")
    able = stored.filter(F.col("n_words") >= least_words).withColumn(salt, F.xxhash64(F.monotonically_increasing_id()))
    order = [F.desc("score"), F.asc_nulls_last(key_col), F.asc("n_features"), F.asc("weight"), F.asc("n_words"), F.asc(salt)]
    number = F.monotonically_increasing_id()
    placed = able.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, number)
    placed = materialize(placed.drop(salt).withColumn(part, F.shiftright(at, 33)).withColumn(
        at, F.col(at).bitwiseAND((1 << 33) - 1)), "ranked", "parquet")
    sizes = sorted((r[part], r["count"]) for r in placed.groupBy(part).count().collect())  # a row a partition
    before = np.cumsum([0] + [n for _, n in sizes])
    n_drawn = percent * int(before[-1]) // 100
    spark = df.sparkSession
    starts = spark.createDataFrame([(p, int(b)) for (p, _), b in zip(sizes, before)], f"`{part}` long, `{first}` long")
    rank = F.col(first) + F.col(at) + 1
    ranked = placed.join(starts, part).withColumn("rank", F.when(rank <= n_drawn, rank)).select(*df.columns, "rank")
    rest = stored.filter((F.col("n_words") < least_words) | F.col("n_words").isNull())
    return ranked.unionByName(rest.withColumn("rank", F.lit(None).cast("long")))


def resample(df: DataFrame, target: DataFrame, text_col: str = "text", key_col: str = "doc_id", target_col: str = "text",
             least: int = 1, most: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20,
             seed: int = 2024) -> DataFrame:
    """Every row of ``df`` (its columns but the text) with n_words, n_features,
    weight, score and rank, drawn so that it comes near the n-grams of ``target``."""
    gain = gains(bucket_counts(df, text_col, least, most, buckets),
                 bucket_counts(target, target_col, least, most, buckets), buckets)
    weighed = weigh(df.drop("score", "rank"), gain, text_col, least, most)
    return draw(weighed.withColumn("score", F.col("weight") + gumbel(key_col, seed)), key_col, percent, least_words)
