"""Quality classifier: a generalised additive model with pairwise interactions.

Every text gives a row of surface features. Each feature is cut into bins at
quantiles of a bounded training sample; cyclic boosting fits, feature after
feature and round after round, a shallow tree on the bins, and the trees of a
feature add up to one lookup table. The pairs of features that explain most
of what is left get two-dimensional tables the same way. A score is the
intercept plus the table entries of the text's bins, through the logistic
function.

Defined cases: a null or empty text has all features 0 and is scored like any
other; a null label or document id is never learned from; documents that
repeat are learned from as often as they stand in both tables; labels of one
class only (or none) give the share of that class as every score (0.5
without labels). Extra columns pass through; a column that bears an output
name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm import vec

FEATURES = ["log_bytes", "log_words", "word_bytes", "longest_word", "unique_words", "unique_pairs",
            "short_words", "line_words", "unique_lines", "short_lines", "upper", "lower", "beyond_ascii",
            "digits", "stops", "commas", "marks", "odd_marks", "bars", "ends_in_mark"]


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=np.int64)
    out[[ord(c) for c in chars]] = 1
    return out


_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _class("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _class("0123456789")
_STOP = _class(".?!")
_COMMA = _class(",;:")
_MARK = _class("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_ODD = _class("#$%&*+<=>@\\^_`{}~")
_BAR = _class("|")
_HIGH = (np.arange(256) >= 128).astype(np.int64)
_NEWLINE = ord("\n")


def _per_doc(values: np.ndarray, offs: np.ndarray, op=np.add) -> np.ndarray:
    """``op`` over each document's stretch of values; 0 where it is empty."""
    out = np.zeros(len(offs) - 1, dtype=np.int64)
    full = np.flatnonzero(offs[1:] > offs[:-1])
    if len(full):
        out[full] = op.reduceat(values, offs[full])
    return out


def _distinct(hashes: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Number of different hashes in each document (of a chunk of < 2**16 documents)."""
    key = np.sort((doc.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16)))
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    return np.bincount((key[first] >> np.uint64(48)).astype(np.int64), minlength=n)


def features(column: pa.Array) -> np.ndarray:
    """(documents, features) of a chunk of texts."""
    data, offs = vec.buffer(column)
    n = len(offs) - 1
    size = np.diff(offs)
    starts, ends, doc = vec.word_spans(data, offs)
    width = ends - starts
    words = np.bincount(doc, minlength=n)
    word_offs = vec.lengths_to_offsets(words)
    h = vec.span_hashes(data, starts, ends) if len(starts) else np.zeros(0, dtype=np.uint64)
    pairs = vec.window_hashes(h, 2)
    inner = doc[1:] == doc[:-1] if len(doc) > 1 else np.zeros(0, dtype=bool)
    breaks = np.flatnonzero(data == _NEWLINE)
    line_start = np.unique(np.concatenate((offs[:-1][size > 0], breaks + 1)))
    line_start = line_start[line_start < len(data)]
    line_doc = np.searchsorted(offs, line_start, side="right") - 1
    line_end = np.append(line_start[1:], len(data))
    line_hash = vec.span_hashes(data, line_start, line_end) if len(line_start) else np.zeros(0, dtype=np.uint64)
    lines = np.bincount(line_doc, minlength=n)
    short = np.bincount(line_doc, weights=(line_end - line_start) < 20, minlength=n)
    byte = {k: _per_doc(c[data], offs) for k, c in
            dict(upper=_UPPER, lower=_LOWER, high=_HIGH, digit=_DIGIT, stop=_STOP, comma=_COMMA,
                 mark=_MARK, odd=_ODD, bar=_BAR).items()}
    in_mark = np.bincount(doc, weights=_MARK[data[ends - 1]], minlength=n) if len(ends) else np.zeros(n)
    each = lambda x, of: x / np.maximum(of, 1)
    letters = byte["upper"] + byte["lower"] + byte["high"]
    return np.stack([
        np.log1p(size), np.log1p(words), each(np.bincount(doc, weights=width, minlength=n), words),
        _per_doc(width, word_offs, np.maximum), each(_distinct(h, doc, n), words),
        each(_distinct(pairs[inner], doc[1:][inner], n) if len(pairs) else np.zeros(n), words - 1),
        each(np.bincount(doc, weights=width <= 3, minlength=n), words), each(words, lines),
        each(_distinct(line_hash, line_doc, n), lines), each(short, lines),
        each(byte["upper"], letters), each(byte["lower"], size), each(byte["high"], size), each(byte["digit"], size),
        each(byte["stop"], words), each(byte["comma"], words), each(byte["mark"], size), each(byte["odd"], size),
        each(byte["bar"], words), each(in_mark, words),
    ], axis=1).astype(np.float64)


@dataclass
class Model:
    """Edges of each feature's bins, its table, and the tables of the pairs."""
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)])

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        if self.edges:
            b = self.bins(x)
            for j, t in enumerate(self.tables):
                total += t[b[j]]
            for i, j, t in self.pairs:
                total += t[b[i], b[j]]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def _cut(g: np.ndarray, h: np.ndarray, least: float, l2: float) -> tuple[float, int]:
    """(gain, first bin of the right side) of the best cut of a row of bins."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gt, ht = g.sum(), h.sum()
    ok = (hl >= least) & (ht - hl >= least)
    if not ok.any():
        return 0.0, 0
    gain = np.where(ok, gl**2 / (hl + l2) + (gt - gl)**2 / (ht - hl + l2) - gt**2 / (ht + l2), 0.0)
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, least: float, l2: float, leaves: int = 4) -> np.ndarray:
    """A tree of up to ``leaves`` leaves on a row of bins, as one value per bin."""
    spans = [(0, len(g))]
    while len(spans) < leaves:
        best = max(((*_cut(g[a:b], h[a:b], least, l2), a, b) for a, b in spans), key=lambda c: c[0])
        gain, at, a, b = best
        if gain <= 1e-9:
            break
        spans.remove((a, b))
        spans += [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in spans:
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + l2)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, least: float, l2: float) -> tuple[float, np.ndarray]:
    """Cut one feature, then each side along the other; the better of both orders."""
    best = (-1.0, np.zeros_like(g))
    for flip in (False, True):
        gg, hh = (g.T, h.T) if flip else (g, h)
        gain, at = _cut(gg.sum(1), hh.sum(1), least, l2)
        if gain <= 0:
            continue
        out = np.zeros_like(gg)
        for rows in (slice(0, at), slice(at, len(gg))):
            gs, hs = gg[rows].sum(0), hh[rows].sum(0)
            more, c = _cut(gs, hs, least, l2)
            gain += more
            for cols in ((slice(0, c), slice(c, None)) if more > 0 else (slice(0, None),)):
                out[rows, cols] = -gs[cols].sum() / (hs[cols].sum() + l2)
        if gain > best[0]:
            best = (gain, out.T if flip else out)
    return best


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, n_bins: int = 32, rounds: int = 120, rate: float = 0.15,
        n_pairs: int = 8, pair_rounds: int = 40, least: float = 2.0, l2: float = 1.0) -> Model:
    """Boost the tables on the sample's features."""
    share = float((y * weight).sum() / weight.sum()) if len(y) else 0.5
    if not len(y) or share in (0.0, 1.0):
        return Model(float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    edges = []
    for j in range(x.shape[1]):
        q = np.unique(np.quantile(x[:, j], np.linspace(0, 1, n_bins + 1)[1:-1]))
        edges.append(q)
    model = Model(float(np.log(share / (1 - share))), edges)
    b = model.bins(x)
    model.tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return weight * (p - y), weight * p * (1 - p)

    for _ in range(rounds):
        for j, t in enumerate(model.tables):
            g, h = slopes()
            step = rate * _tree(np.bincount(b[j], g, len(t)), np.bincount(b[j], h, len(t)), least, l2)
            t += step
            total += step[b[j]]

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        shape = (len(edges[i]) + 1, len(edges[j]) + 1)
        return np.bincount(b[i] * shape[1] + b[j], v, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    gains = []
    for i in range(len(edges)):
        for j in range(i + 1, len(edges)):
            gains.append((_pair_tree(grid(i, j, g), grid(i, j, h), least, l2)[0], i, j))
    chosen = [(i, j) for gain, i, j in sorted(gains, reverse=True)[:n_pairs] if gain > 0]
    model.pairs = [(i, j, np.zeros((len(edges[i]) + 1, len(edges[j]) + 1))) for i, j in chosen]
    for _ in range(pair_rounds):
        for i, j, t in model.pairs:
            g, h = slopes()
            step = rate * _pair_tree(grid(i, j, g), grid(i, j, h), least, l2)[1]
            t += step
            total += step[b[i], b[j]]
    return model


def train(docs: DataFrame, labels: DataFrame, key_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_rows: int = 20_000, **how) -> Model:
    """Fit on about ``sample_rows`` labelled documents, half of them of either
    class as far as it has rows, weighted back to the shares of all labels.
    The sample is chosen by a hash of the key among the distinct labelled keys
    and, where keys stand on several documents, by a hash of key and text among
    those; rows alike in both count once. What comes to the
    driver is one row of features per sampled document, about ``sample_rows``
    (the share is drawn by hash, so a few per cent more or less)."""
    rows = labels.select(F.col(key_col).alias("k"), F.col(label_col).cast("int").alias("y")).filter(
        F.col("k").isNotNull() & F.col("y").isin(0, 1)).distinct()
    n = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}  # two rows
    steps = 1 << 30
    take = {y: min(1.0, sample_rows / 2 / c) for y, c in n.items()}

    def drawn(hashed, share: dict):
        keep = F.lit(False)
        for y, r in share.items():
            keep = keep | ((F.col("y") == y) & (F.pmod(hashed, F.lit(steps)) < int(steps * r)))
        return keep

    sample = F.broadcast(rows.filter(drawn(F.xxhash64(F.col("k").cast("string"), F.lit(1)), take)))  # bounded by sample_rows
    joined = docs.select(F.col(key_col).alias("k"), F.col(text_col).alias("text")).join(sample, "k")
    both = F.xxhash64(F.col("k").cast("string"), F.coalesce("text", F.lit("")), F.lit(2))
    found = {r["y"]: r["m"] for r in joined.groupBy("y").agg(F.approx_count_distinct(both, 0.02).alias("m")).collect()}
    again = {y: min(1.0, sample_rows / 2 / m) if m > 0.6 * sample_rows else 1.0 for y, m in found.items()}
    take = {y: r * again.get(y, 1.0) for y, r in take.items()}
    joined = joined.filter(drawn(both, again)).select("y", "text", both.alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in vec.chunks(batches, "text"):
            x = features(part.column("text")).astype("<f8")
            yield pa.RecordBatch.from_arrays([part.column("y"), part.column("h"), pa.array([r.tobytes() for r in x], type=pa.binary())],
                                             names=["y", "h", "x"])

    got = joined.mapInArrow(vec.trimmed(run), "y int, h long, x binary").distinct().collect()
    got.sort(key=lambda r: (r["y"], bytes(r["x"])))
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in got), dtype="<f8").reshape(len(got), len(FEATURES))
    y = np.array([r["y"] for r in got], dtype=np.float64)
    weight = np.array([1 / take[r["y"]] for r in got])
    if len(got):
        weight /= weight.mean()
    return fit(x, y, weight, **how)


def score(df: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of ``df`` plus the quality score of each whole text (0 to 1)."""
    kept = [f for f in df.schema.fields if f.name != score_col]
    names = [f.name for f in kept]
    shared = df.sparkSession.sparkContext.broadcast(model)  # bins and tables: a few hundred KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in vec.chunks(batches, text_col):
            s = shared.value.score(features(part.column(text_col)))
            yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [pa.array(s, type=pa.float64())],
                                             names=names + [score_col])

    return df.mapInArrow(vec.trimmed(run), T.StructType(kept + [T.StructField(score_col, T.DoubleType())]))
