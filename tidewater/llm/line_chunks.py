"""Line dedup with content-defined chunks of lines.

A text is cut into lines (each with its line end). A rolling hash over the
hashes of the last ``window`` lines closes a chunk after a line where it is
0 modulo ``average``; the end of a text closes one too, and a line of
``least_words`` words or more is a chunk of its own. Since the cuts depend on
nearby lines alone, a passage that stands in several documents is cut
alike in all of them, whatever lines were put in before it. A chunk of at
least ``least_lines`` lines (or ``least_words`` words, for a passage on few
lines) that stands anywhere else, in the same document or another, is
removed but for its first place (least document id, then position). Chunks
are matched by a 128-bit hash, and of each group the texts themselves are
compared before anything is removed: a group whose texts are not all equal
byte for byte stays whole.

Such chunks leave the lines of a passage before its first and after its last
cut, and all of it where it holds but one cut. With ``extend`` the lines that
decide a cut (``window`` of them) are an anchor, as is a line of
``least_words`` words; neither depends on what stands around it. Anchors are
extended line by line to both sides, through the next anchor: an extension goes
if it stands, as an extension or as a chunk, at an earlier place that does not
overlap it. It is found by the hash of the whole
stretch and compared byte for byte like a chunk, so every line that goes still
stands at an earlier place, within the same stretch. A repeated passage goes
whole if there is an anchor in it. Each line is part of the extensions of a few
anchors at most, so their number grows with the lines, and only the longest
repeated one on each side of an anchor is fetched and compared.

Defined cases: null text counts as empty: no lines, empty result; a null
document id comes first of all; documents that repeat as rows lose their
later copies' chunks like any other repeat; lines of white space are lines;
rows are told apart by their id and text, so rows alike in both are cut alike
(the first of them keeps what is first). Texts are read whole, whatever their
length; an empty table gives an empty one; extra columns of any name pass
through, but for those that bear the names given for the counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm import names, vec
from tidewater.session import materialize


def _lines(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start, byte end and document of each line of the texts."""
    size = np.diff(offs)
    breaks = np.flatnonzero(data == 10) + 1
    starts = np.unique(np.concatenate((offs[:-1][size > 0], breaks)))
    starts = starts[starts < len(data)]
    if not len(starts):
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    return starts, np.append(starts[1:], len(data)), np.searchsorted(offs, starts, side="right") - 1


def _first_words(data: np.ndarray, offs: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Number of the first word at or after each start, and of words in all."""
    wstart, _, _ = vec.word_spans(data, offs)
    return np.searchsorted(wstart, np.append(starts, len(data)))


def _cuts(data: np.ndarray, offs: np.ndarray, window: int, average: int, least_words: int) -> tuple[np.ndarray, ...]:
    """Of each line its byte start, byte end and document; of each chunk its
    first line, last line (numbered through all texts), number of words, and
    whether the rolling hash closes it."""
    starts, ends, doc = _lines(data, offs)
    if not len(starts):
        return starts, starts, starts, starts, starts, starts, starts.astype(bool)
    # a last line without a line end hashes like the same line with one
    bare = ends - (data[ends - 1] == 10)
    h = vec.span_hashes(data, starts, bare)
    n = len(h)
    roll = h.copy()
    turn = np.uint64(0x9E3779B97F4A7C15)
    inside = np.ones(n, dtype=bool)
    for back in range(1, window):  # the last ``window`` lines of the same document
        inside[back:] &= doc[back:] == doc[:-back]
        inside[:back] = False
        older = np.zeros(n, dtype=np.uint64)
        older[back:] = h[:-back] * (turn ** np.uint64(back))
        roll = roll + np.where(inside, older, np.uint64(0))
    last = np.ones(n, dtype=bool)
    last[:-1] = doc[1:] != doc[:-1]
    hit = inside & ((vec.mix(roll) >> np.uint64(32)) % np.uint64(average) == 0)
    close = last | hit
    first_word = _first_words(data, offs, starts)
    long = np.diff(first_word) >= least_words
    close |= long
    close[:-1] |= long[1:]
    to = np.flatnonzero(close)
    at = np.concatenate(([0], to[:-1] + 1))
    return starts, ends, doc, at, to, first_word[to + 1] - first_word[at], hit[to]


def chunk_spans(data: np.ndarray, offs: np.ndarray, window: int, average: int, least_words: int) -> tuple[np.ndarray, ...]:
    """Byte start, byte end, document, lines and words of each chunk of the texts."""
    starts, ends, doc, at, to, words, _ = _cuts(data, offs, window, average, least_words)
    return starts[at], ends[to], doc[to], to - at + 1, words


CHUNK, BACK, FORWARD = 0, 1, 2


def _candidates(data: np.ndarray, offs: np.ndarray, window: int, average: int, least_lines: int, least_words: int,
                extend: bool) -> tuple[np.ndarray, ...]:
    """Byte start, byte end, document, first line in it, lines and kind of all
    that may be removed: the chunks that are long enough and, with ``extend``,
    their extensions, each stretch of lines once."""
    starts, ends, doc, at, to, words, hit = _cuts(data, offs, window, average, least_words)
    keep = (to - at + 1 >= least_lines) | (words >= least_words)
    kind = np.zeros(int(keep.sum()), dtype=np.int64)
    if extend and len(at):
        sure = hit | ((at == to) & (words >= least_words))  # wherever its lines stand, such an anchor is one
        a_at, a_to = np.where(hit, to - window + 1, at)[sure], to[sure]  # in order of their last lines
        same = doc[a_at[1:]] == doc[a_at[:-1]]
        first, last = np.searchsorted(doc, doc[a_at]), np.searchsorted(doc, doc[a_at], side="right") - 1
        reach_back, reach_on = first.copy(), last.copy()
        reach_back[1:] = np.where(same, np.minimum(a_at[:-1], a_at[1:]), first[1:])
        reach_on[:-1] = np.where(same, a_to[1:], last[:-1])
        back, on = a_at - reach_back, reach_on - a_to
        at, to, kind = (np.concatenate(x) for x in (
            (at[keep], a_at, vec.ranges(reach_back, back), np.repeat(a_at, on)),
            (to[keep], a_to, np.repeat(a_to, back), vec.ranges(a_to + 1, on)),
            (kind, np.zeros(len(a_at), dtype=np.int64), np.full(int(back.sum()), BACK), np.full(int(on.sum()), FORWARD))))
        _, one = np.unique(at * (len(doc) + 1) + to, return_index=True)
        at, to, kind = at[one], to[one], kind[one]
    else:
        at, to = at[keep], to[keep]
    return starts[at], ends[to], doc[at], at - np.searchsorted(doc, doc[at]), to - at + 1, kind


_SPAN = 1 << 31  # a stretch of lines in one integer: first line, lines


def _listed(part: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Document and stretch of the lists of ``column``."""
    lists = part.column(column)
    return np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()


def _hashes(data: np.ndarray, start: np.ndarray, bare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (vec.span_hashes(data, start, bare).view(np.int64),
            vec.mix(vec.span_hashes(data[::-1], len(data) - bare, len(data) - start) + np.uint64(77)).view(np.int64))


def _chunks(df: DataFrame, how: tuple) -> DataFrame:
    """(key, own, span, kind, h1, h2) of every stretch of lines that may be removed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in vec.chunks(batches, "text"):
            data, offs = vec.buffer(part.column("text"))
            start, end, doc, line, n, kind = _candidates(data, offs, *how)
            if not len(start):
                continue
            h1, h2 = _hashes(data, start, end - (data[end - 1] == 10))  # one at a text's end may lack its line end
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [part.column("key").take(at), part.column("own").take(at), pa.array(line * _SPAN + n),
                 pa.array(kind.astype(np.int8)), pa.array(h1), pa.array(h2)], names=["key", "own", "span", "kind", "h1", "h2"])

    return df.mapInArrow(vec.trimmed(run), "key long, own long, span long, kind byte, h1 long, h2 long")


def _texts(df: DataFrame) -> DataFrame:
    """(h1, h2, chunk): the text of each stretch of lines in the list ``wanted``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in vec.chunks(batches, "text"):
            data, offs = vec.buffer(part.column("text"))
            starts, ends, doc = _lines(data, offs)
            of, span = _listed(part, "wanted")
            at = np.searchsorted(doc, of) + span // _SPAN
            start, end = starts[at], ends[at + span % _SPAN - 1]
            bare = end - (data[end - 1] == 10)
            h1, h2 = _hashes(data, start, bare)
            raw = data.tobytes()
            found = [raw[a:b].decode("utf-8") for a, b in zip(start.tolist(), bare.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), pa.array(found, type=pa.string())], names=["h1", "h2", "chunk"])

    return df.mapInArrow(vec.trimmed(run), "h1 long, h2 long, chunk string")


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = 2, average: int = 3,
          least_lines: int = 2, least_words: int = 50, counts: tuple[str, str] | None = None,
          extend: bool = False) -> DataFrame:
    """All rows and columns of ``df`` with the repeated chunks (with ``extend``,
    as far as they repeat on both sides) cut out of ``text``; with ``counts``,
    two more columns: lines, and lines removed."""
    how = (window, average, least_lines, least_words, extend)
    rows = df.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("key"),
                     F.xxhash64(F.col(text)).alias("own"), F.col(text).alias("text"))
    line, lines = F.floor(F.col("span") / _SPAN), F.col("span") % _SPAN
    meta = materialize(_chunks(rows, how), "chunks", "parquet")
    # rows alike in id and text: all but one are later copies; equal texts have equally many lines
    groups = meta.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("key", "own", "span")).alias("first"))
    groups = materialize(groups.filter("n > 1").drop("n"), "repeats", "parquet")
    # a stretch over lines of its own first place stays with it
    is_first = (F.struct("key", "own") == F.struct("first.key", "first.own")) & (line - F.floor(F.col("first.span") / _SPAN) < lines)
    hits = meta.join(groups, ["h1", "h2"]).select("key", "own", "kind", "span", "h1", "h2", "first", is_first.alias("is_first"))
    # of the extensions of one anchor to one side, the longest
    anchor = F.when(F.col("kind") == BACK, line + lines).otherwise(line)
    pick = F.struct(lines.alias("lines"), "span", "h1", "h2", "first")
    best = hits.groupBy("key", "own", "kind", anchor.alias("anchor")).agg(
        F.max(F.when(~F.col("is_first"), pick)).alias("later"), F.max(pick).alias("any"))
    picked = best.select("key", "own", F.explode(F.array(
        F.struct(F.lit(True).alias("is_later"), F.col("later").alias("p")),
        F.struct(F.lit(False).alias("is_later"), F.col("any").alias("p")))).alias("x")).filter("x.p IS NOT NULL").select(
        "key", "own", "x.is_later", "x.p.span", "x.p.h1", "x.p.h2", "x.p.first")
    picked = materialize(picked, "hits", "parquet")
    places = picked.select("key", "own", "span").unionByName(
        picked.groupBy("h1", "h2").agg(F.first("first").alias("f")).select("f.key", "f.own", "f.span"))
    wanted = places.groupBy("key", "own").agg(F.collect_set("span").alias("wanted"))
    same = (_texts(rows.join(wanted, ["key", "own"])).groupBy("h1", "h2", "chunk").agg(F.lit(1).alias("one"))
            .groupBy("h1", "h2").agg(F.count("*").alias("texts"))  # byte comparison: one row per different text
            .filter("texts = 1").select("h1", "h2"))
    cut = materialize(picked.join(same, ["h1", "h2"]).groupBy("key", "own").agg(
        F.collect_set(F.when(F.col("is_later"), F.col("span"))).alias("later"),
        F.collect_set("span").alias("all_of_them")), "cuts", "parquet")
    return _without(df, cut, key, text, counts)


def _without(df: DataFrame, cut: DataFrame, key: str, text: str, counts: tuple[str, str] | None) -> DataFrame:
    """``df`` without the stretches of lines that ``cut`` lists for each (key, own)."""
    cols = [c for c in df.columns if not counts or c not in counts]
    kept = df.select(*cols)
    k, o, ck, co, later, every, nth, gone_col = names.free(kept, "key", "own", "cut_key", "cut_own", "later", "all", "nth", "cut")
    c = cut.select(F.col("key").alias(ck), F.col("own").alias(co), F.col("later").alias(later), F.col("all_of_them").alias(every))
    joined = (kept.withColumns({k: F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))), o: F.xxhash64(F.col(text))})
              .join(c, (F.col(k) == F.col(ck)) & (F.col(o) == F.col(co)), "left").drop(ck, co))
    # rows alike in id and text: only one of them holds the first places
    joined = joined.withColumn(nth, F.when(F.col(later).isNotNull(), F.row_number().over(
        Window.partitionBy(k, o).orderBy(k))).otherwise(1))
    joined = joined.withColumn(gone_col, F.coalesce(F.when(F.col(nth) == 1, F.col(later)).otherwise(F.col(every)),
                                                    F.array().cast("array<long>"))).drop(k, o, nth, later, every)
    fields = [f for f in kept.schema.fields] + ([T.StructField(x, T.LongType()) for x in counts] if counts else [])
    at_text = cols.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in vec.chunks(batches, text):
            data, offs = vec.buffer(part.column(text))
            start, end, doc = _lines(data, offs)
            of, span = _listed(part, gone_col)
            gone = np.zeros(len(doc), dtype=bool)
            gone[vec.ranges(np.searchsorted(doc, of) + span // _SPAN, span % _SPAN)] = True
            out = [part.column(c) for c in cols]
            if gone.any():
                keep = vec.ranges(start[~gone], (end - start)[~gone])
                size = np.bincount(doc[~gone], weights=(end - start)[~gone], minlength=part.num_rows).astype(np.int64)
                new = vec.lengths_to_offsets(size)
                raw = data[keep].tobytes()
                values = [raw[a:b].decode("utf-8") for a, b in zip(new.tolist(), new[1:].tolist())]
                valid = part.column(text).is_valid().to_numpy(zero_copy_only=False)
                out[at_text] = pa.array([v if ok else None for v, ok in zip(values, valid)], type=pa.string())
            if counts:
                out.append(pa.array(np.bincount(doc, minlength=part.num_rows).astype(np.int64)))
                out.append(pa.array(np.bincount(doc[gone], minlength=part.num_rows).astype(np.int64)))
            yield pa.RecordBatch.from_arrays(out, names=cols + list(counts or ()))

    return joined.mapInArrow(vec.trimmed(run), T.StructType(fields))
