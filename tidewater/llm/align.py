"""Alignment of two tokenizers' tokens over the same text.

Both token sequences cover the same bytes. Every token points to the token of
the other side that overlaps it and reaches farthest right, as long as that
one ends later; a token that no other outreaches points to itself (of two that
end together, the second side's points to the first's). Doubling all pointers
of a batch at once (``successor = successor[successor]``) leads every token to
the terminal token of its component, and tokens with the same terminal form a
group: the smallest stretch at whose ends tokens of both sides end. Every pair
of a first-side and a second-side token in a group is a link.

A text is tokenized in segments cut before each space that follows a character
which is no white space. Neither vocabulary has a token that crosses such a
cut (:func:`check_vocabulary` tests it), so the tokens are those of the whole
text; segments recur as words do, so a task aligns each but once and remembers
it within a bound.

How many documents hold a pair of ids linked is a corpus count: each chunk of
documents (``chunk_bytes`` of text) sends one row per distinct pair, the pairs
are counted, and each chunk gets the counts of its own pairs back. The table
of pairs grows with the corpus and is only ever shuffled; what is broadcast is
a row per id of the first vocabulary.

Defined cases: texts that are null or empty, or whose joined tokens differ
from space + text on either side, have no tokens: zeros, and '' for groups.
Long texts are tokenized whole (one longer than ``chunk_bytes`` is a chunk of
its own); repeated rows each count as a document; an empty table gives an empty
one. Extra columns pass through; one that bears an output name is replaced.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm import vec
from tidewater.session import materialize

_SPACED = re.compile(r"[\s\u180e] ")
_CUT = re.compile(r"(?<=[^\s\u180e])(?= )")
_REMEMBERED = 4_000_000     # distinct pairs remembered before a task starts afresh

OUTPUTS = ["n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times", "chunk"]


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable
    bytes stand for themselves, the others for the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Tokenizers:
    """The contents of the two vocabulary files: a byte-level BPE (JSON) and a
    piece BPE with byte fallback (model)."""
    byte_level: bytes
    pieces: bytes

    def open(self) -> None:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        import tokenizers
        self.a = tokenizers.Tokenizer.from_str(self.byte_level.decode("utf-8"))
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=self.pieces)
        letters = _byte_letters()
        size = self.a.get_vocab_size(with_added_tokens=True)
        entries = [self.a.id_to_token(i) or "" for i in range(size)]
        self.a_bytes = [bytes(letters[c] for c in e) if all(c in letters for c in e) else e.encode() for e in entries]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8")
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.b_space = [self.b.piece_to_id("▁")]
        self.a_size = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], dtype=np.int64)

    def check_vocabulary(self) -> list[str]:
        """Entries that would cross a cut between segments (none, for the cuts to be right)."""
        return [repr(t) for t in [*self.a_bytes, *self.b_bytes] if _CUT.search(t.decode("utf-8", "replace"))]

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both sides of all segments (a word stands for space + word),
        one after the other, how many each segment has, and which segments the
        tokens of both sides join to; the others have none. Segments that end
        in no white space are encoded as one text, as they would stand in it."""
        plain = [i for i, w in enumerate(words) if w and not w[-1].isspace() and not w.endswith("\u180e") and "▁" not in w]
        a, b, na, nb = self._joined([words[i] for i in plain])
        if a is None or len(plain) < len(words):
            rest = range(len(words)) if a is None else sorted(set(range(len(words))) - set(plain))
            each_a, each_b = [None] * len(words), [None] * len(words)
            for i in rest:
                each_a[i], each_b[i] = self._single(words[i])
            if a is not None:
                for ids, n, each in ((a, na, each_a), (b, nb, each_b)):
                    for i, x in zip(plain, np.split(ids, np.cumsum(n)[:-1])):
                        each[i] = x
            na, nb = (np.array([len(x) for x in each], dtype=np.int64) for each in (each_a, each_b))
            a, b = (np.concatenate([np.asarray(x, dtype=np.int64) for x in each]) for each in (each_a, each_b))
        return a, b, na, nb, na > 0

    def _joined(self, words: list[str]):
        if not words:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none, none
        text = " ".join(words)
        raw = (" " + text).encode("utf-8")
        size = pc.binary_length(pa.array(words, type=pa.large_string())).to_numpy().astype(np.int64) + 1
        ends = np.cumsum(size)
        out = []
        for ids, sizes, entries in ((self.a.encode(" " + text, add_special_tokens=False).ids, self.a_size, self.a_bytes),
                                    (self.b.encode(text), self.b_size, self.b_bytes)):  # the model puts the space before
            if b"".join([entries[t] for t in ids]) != raw:
                return None, None, None, None
            ids = np.array(ids, dtype=np.int64)
            out.append((ids, np.diff(np.searchsorted(np.cumsum(sizes[ids]), ends, side="right"), prepend=0)))
        return out[0][0], out[1][0], out[0][1], out[1][1]

    def _single(self, word: str) -> tuple[list[int], list[int]]:
        a = self.a.encode(" " + word, add_special_tokens=False).ids
        b = self.b.encode(word) if word else self.b_space  # the model puts no space before nothing
        raw = (" " + word).encode("utf-8")
        whole = b"".join([self.a_bytes[t] for t in a]) == raw and b"".join([self.b_bytes[t] for t in b]) == raw
        return (a, b) if whole else ([], [])


def groups_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of both sides, numbered from 0 in order, from
    the byte offsets where the tokens of two covers of the same bytes end."""
    n, m = len(a_ends), len(b_ends)
    over_a = np.searchsorted(b_ends, a_ends, side="left")  # the b token that holds the a token's last byte
    over_b = np.searchsorted(a_ends, b_ends, side="left")
    at = np.arange(n, dtype=np.int64)
    successor = np.concatenate((np.where(b_ends[over_a] > a_ends, n + over_a, at), over_b))
    while True:
        jumped = successor[successor]
        if np.array_equal(jumped, successor):
            break
        successor = jumped
    terminal = np.zeros(n + 1, dtype=np.int64)
    terminal[1:] = np.cumsum(successor[:n] == at)
    label = terminal[successor]  # every terminal is an a token
    return label[:n], label[n:n + m]


def _pairs(a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray, n_groups: int, width: int):
    """(group, a * width + b, times) of the links, groups in order. Groups of
    many tokens on both sides go by distinct ids, so that what is held is
    bounded by distinct pairs, not by links."""
    na, nb = np.bincount(ga, minlength=n_groups), np.bincount(gb, minlength=n_groups)
    large = na * nb > 4096
    if large.any():
        keep_a, keep_b = ~large[ga], ~large[gb]
        g, code, times = _pairs(a[keep_a], b[keep_b], ga[keep_a], gb[keep_b], n_groups, width)
        more = []
        for x in np.flatnonzero(large):
            ua, ca = np.unique(a[np.searchsorted(ga, x):np.searchsorted(ga, x, "right")], return_counts=True)
            ub, cb = np.unique(b[np.searchsorted(gb, x):np.searchsorted(gb, x, "right")], return_counts=True)
            more.append((np.full(len(ua) * len(ub), x), (ua[:, None] * width + ub).ravel(), (ca[:, None] * cb).ravel()))
        g, code, times = (np.concatenate(x) for x in zip((g, code, times), *more))
        order = np.argsort(g, kind="stable")
        return g[order], code[order], times[order]
    first_b = vec.lengths_to_offsets(nb)
    each = nb[ga]
    partner = b[vec.ranges(first_b[ga], each)]
    return np.repeat(ga, each), np.repeat(a, each) * width + partner, np.ones(len(partner), dtype=np.int64)


def _words(text: str) -> list[str]:
    """The segments of space + text, each without its first space."""
    if _SPACED.search(text) or text[0] == " " or text[-1] == " ":
        return [s[1:] for s in _CUT.split(" " + text)]
    return text.split(" ")


class Segments:
    """Alignments of the segments met so far, in growing arrays."""

    def __init__(self, files: Tokenizers):
        self.files = files
        self.width = len(files.b_size)
        self.spell = [f"{i}{mark}" for i in range(max(len(files.a_size), len(files.b_size))) for mark in ",|;"]
        self.restart()

    def restart(self) -> None:
        self.index: dict[str, int] = {}
        self.text: list[str] = []
        self.stats = [np.zeros((0, 5), dtype=np.int64)]  # whole, n_a, n_b, n_groups, n_links
        self.codes, self.times = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        self.sizes = [np.zeros(0, dtype=np.int64)]
        self.held = 0

    def _settle(self) -> None:
        for c in ("stats", "codes", "times", "sizes"):
            setattr(self, c, [np.concatenate(getattr(self, c))])

    def add(self, words: list[str]) -> None:
        """Align segments not met before, all at once."""
        ai, bi, na, nb, whole = self.files.encode(words)
        ga, gb = groups_of(np.cumsum(self.files.a_size[ai]), np.cumsum(self.files.b_size[bi])) if len(ai) else (ai, bi)
        n_groups = int(ga[-1]) + 1 if len(ga) else 0
        g, code, times = _pairs(ai, bi, ga, gb, n_groups, self.width)
        seg_of_group = np.zeros(n_groups, dtype=np.int64)
        seg_of_group[ga] = np.repeat(np.arange(len(words)), na)
        groups = np.bincount(seg_of_group, minlength=len(words))
        seg = seg_of_group[g]
        links = np.bincount(seg, weights=times, minlength=len(words)).astype(np.int64)
        self.stats.append(np.stack([whole.astype(np.int64), na, nb, groups, links], axis=1))
        self.codes.append(code)
        self.times.append(times)
        self.sizes.append(np.bincount(seg, minlength=len(words)))
        self.held += len(code)
        self.text += self._spelled(ai, bi, ga, gb, n_groups, na + nb)
        self.index.update(zip(words, range(len(self.index), len(self.index) + len(words))))

    def _spelled(self, ai, bi, ga, gb, n_groups, per_segment) -> list[str]:
        """``a1,a2|b1;a3|b2;`` of each segment: every token with the mark after
        it, the first side's tokens of a group before the second's."""
        na, nb = np.bincount(ga, minlength=n_groups), np.bincount(gb, minlength=n_groups)
        last_a, last_b = np.cumsum(na) - 1, np.cumsum(nb) - 1
        mark_a, mark_b = np.zeros(len(ai), dtype=np.int64), np.zeros(len(bi), dtype=np.int64)
        mark_a[last_a], mark_b[last_b] = 1, 2
        flat = np.empty(len(ai) + len(bi), dtype=np.int64)
        flat[np.arange(len(ai)) + (np.cumsum(nb) - nb)[ga]] = ai * 3 + mark_a
        flat[np.arange(len(bi)) + np.cumsum(na)[gb]] = bi * 3 + mark_b
        each = list(map(self.spell.__getitem__, flat.tolist()))
        cut = vec.lengths_to_offsets(per_segment).tolist()
        return ["".join(each[x:y]) for x, y in zip(cut, cut[1:])]

    def documents(self, texts: list[str | None]):
        """For texts: (n, 4) counts, the spelled groups, and per text its
        distinct pairs in order with the times they are linked."""
        if self.held > _REMEMBERED:
            self.restart()
        cut = [_words(t) if t else [] for t in texts]
        flat = list(chain.from_iterable(cut))
        at = list(map(self.index.get, flat))
        new = list(dict.fromkeys([w for w, i in zip(flat, at) if i is None]))
        if new:
            self.add(new)
            at = list(map(self.index.__getitem__, flat))
        self._settle()
        n = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        idx = np.array(at, dtype=np.int64)
        doc = np.repeat(np.arange(len(texts)), n)
        stats = np.zeros((len(texts), 5), dtype=np.int64)
        full = np.flatnonzero(n)
        if len(full):
            stats[full] = np.add.reduceat(self.stats[0][idx], vec.lengths_to_offsets(n)[full], axis=0)
        good = (stats[:, 0] == n) & (n > 0)  # every segment's tokens join to it
        stats[~good] = 0
        ends = vec.lengths_to_offsets(n).tolist()
        spelled = ["".join(map(self.text.__getitem__, at[x:y]))[:-1] if ok else "" for x, y, ok in zip(ends, ends[1:], good.tolist())]
        use = good[doc]
        idx, doc = idx[use], doc[use]
        size = self.sizes[0][idx]
        where = vec.ranges(vec.lengths_to_offsets(self.sizes[0])[idx], size)
        key = (np.repeat(doc, size) << 32) | self.codes[0][where]
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, dtype=np.int64)
        times = np.add.reduceat(self.times[0][where][order], first) if len(key) else first
        key = key[first]
        cuts = np.searchsorted(key, np.arange(len(texts) + 1) << 32)
        code = key & 0xFFFFFFFF
        if sum(map(len, new)) > 1 << 21:  # texts with hardly a space are not worth remembering
            self.restart()
        return stats[:, 1:], spelled, code, times, cuts


def align(df: DataFrame, files: Tokenizers, text_col: str = "text", chunk_bytes: int = 8 << 20) -> DataFrame:
    """All columns of ``df`` but the text, plus n_a, n_b, n_groups, n_links,
    ``groups`` (``a1,a2|b1;a3|b2,b3``: ids of each group in order), ``pairs``
    (the distinct linked pairs, a * size of the second vocabulary + b, packed
    as ascending little-endian 32-bit integers), ``times`` (how often each is
    linked, packed likewise) and ``chunk`` (the number of the row's chunk)."""
    kept = [f for f in df.schema.fields if f.name not in (text_col, *OUTPUTS)]
    cols = [f.name for f in kept]
    kinds = [T.LongType()] * 4 + [T.StringType(), T.BinaryType(), T.BinaryType(), T.LongType()]
    schema = T.StructType(kept + [T.StructField(c, k) for c, k in zip(OUTPUTS, kinds)])
    shared = df.sparkSession.sparkContext.broadcast((files.byte_level, files.pieces))  # two files of about 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tokenizers(*shared.value)
        own.open()
        known = Segments(own)
        chunk, filled = TaskContext.get().partitionId() << 32, 0
        for part in vec.chunks(batches, text_col, min(1 << 20, chunk_bytes)):
            column = part.column(text_col)
            size = column.nbytes
            if filled and filled + size > chunk_bytes:
                chunk, filled = chunk + 1, 0
            filled += size
            stats, spelled, code, times, cuts = known.documents(column.to_pylist())
            packed = [x.astype("<u4") for x in (code, times)]
            cut = list(zip(cuts, cuts[1:]))
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in cols] + [pa.array(stats[:, i]) for i in range(4)] + [pa.array(spelled, type=pa.string())]
                + [pa.array([x[i:j].tobytes() for i, j in cut], type=pa.binary()) for x in packed]
                + [pa.array(np.full(part.num_rows, chunk, dtype=np.int64))], names=cols + OUTPUTS)

    return df.select(*cols, text_col).mapInArrow(vec.trimmed(run), schema)


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All packed integers of a binary column, and how many each row has."""
    rows = [np.frombuffer(x, dtype="<u4") for x in column.to_pylist()]
    n = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
    return (np.concatenate(rows) if rows else np.zeros(0, dtype=np.uint32)).astype(np.int64), n


def chunk_pairs(aligned: DataFrame) -> DataFrame:
    """(chunk, pair, n): in how many rows of a chunk a pair is linked. The rows
    of a chunk stand together in the table, so a task adds them up itself; a
    chunk read by two tasks has its pairs twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = defaultdict(list)

        def told(chunk: int) -> pa.RecordBatch:
            pair, n = np.unique(np.concatenate(held.pop(chunk)), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), chunk)), pa.array(pair), pa.array(n.astype(np.int64))],
                                              names=["chunk", "pair", "n"])

        for batch in batches:
            pair, n = _unpacked(batch.column("pairs"))
            chunk = batch.column("chunk").to_numpy()
            of = np.repeat(chunk, n)
            for c in np.unique(chunk):
                held[int(c)].append(pair[of == c])
            for c in [c for c in held if c != int(chunk[-1])]:
                yield told(c)
        for c in list(held):
            yield told(c)

    return aligned.select("chunk", "pairs").mapInArrow(vec.trimmed(run), "chunk long, pair long, n long")


def pair_counts(asked: DataFrame, width: int) -> DataFrame:
    """(pair, n, best) from :func:`chunk_pairs`: in how many documents a pair is
    linked, and whether that is the most of all pairs of its first-side id."""
    counts = materialize(asked.groupBy("pair").agg(F.sum("n").alias("n")), "pairs", "parquet")
    a = F.floor(F.col("pair") / width)
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))  # a row per id of the first vocabulary
    return counts.withColumn("a", a).join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def add_counts(aligned: DataFrame, width: int) -> DataFrame:
    """All columns of ``aligned`` (a table from :func:`align`, as written; its
    packed columns are needed) but pairs, times and chunk, plus n_best (links whose pair is linked in most documents
    of all pairs of its first-side id) and count_sum (that number, summed over the links)."""
    asked = materialize(chunk_pairs(aligned), "asked", "parquet")
    counts = pair_counts(asked, width)
    told = asked.select("chunk", "pair").distinct().join(counts, "pair")
    kept = [f for f in aligned.schema.fields if f.name not in ("pairs", "times", "chunk", "n_best", "count_sum")]
    cols = [f.name for f in kept]
    schema = T.StructType(kept + [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def score(rows: pa.Table, told: pa.Table) -> pa.Table:
        order = np.argsort(told.column("pair").to_numpy(), kind="stable")
        pair, n, best = (told.column(c).to_numpy()[order] for c in ("pair", "n", "best"))
        ask, size = _unpacked(rows.column("pairs").combine_chunks())
        times, _ = _unpacked(rows.column("times").combine_chunks())
        at = np.searchsorted(pair, ask)
        sums = []
        for x in (times * best[at], times * n[at]) if len(pair) else (times, times):
            total = np.concatenate(([0], np.cumsum(x, dtype=np.int64)))
            ends = np.cumsum(size)
            sums.append(pa.array(total[ends] - total[ends - size], type=pa.int64()))
        return pa.table([rows.column(c) for c in cols] + sums, names=[f.name for f in schema.fields])

    return aligned.select(*cols, "pairs", "times", "chunk").groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(score, schema)
