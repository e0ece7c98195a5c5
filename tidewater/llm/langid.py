"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Character 1- to 3-grams of the lower-cased text are hashed into a fixed
number of features; a document's weight of a feature is its share of the
n-grams times the feature's inverse document frequency. The weights are
learned by follow-the-regularised-leader (per-coordinate rates, L1 and L2
penalties) on a bounded, documented sample of labelled rows, and a temperature
fitted on held-back sample rows calibrates the probabilities. A text is
scored whole: the class weights of all its n-grams are looked up and averaged.

Defined cases: a null text or one without a letter is ``und`` with score 0;
rows with a null label are never learned from; without any labelled row every
text is ``und``; an empty table gives an empty result. Rows that repeat and equal
texts get equal results whatever else is in the table; very long texts are scored
whole, in chunks of rows bounded by their text;
of equally likely languages the first in code point order is taken. Extra
columns pass through; a column that bears an output name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm import vec

UNKNOWN = "und"
BITS = 16
SCALE = 30.0  # keeps the shares of n-grams near unit size for the penalties
_LETTER = regex.compile(r"\p{L}").search
_WORDS_ONLY = regex.compile(r"[^\p{L}\p{M}\s]+")
_K = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]


def _grams(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
    """Feature numbers of the 1-, 2- and 3-grams at each character (2**BITS
    where the gram would leave its text), and the offsets of the texts."""
    low = [" ".join(t.lower().split()) if t else "" for t in texts]
    offs = vec.lengths_to_offsets(np.array([len(t) for t in low], dtype=np.int64))
    c = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = []
    h = np.zeros(len(c), dtype=np.uint32)
    for n in range(3):
        if n:
            h = h[:-1] if len(h) else h
        h = h * _K[3] + c[n:] * _K[n] + np.uint32(n + 1)
        f = np.full(len(c), 1 << BITS, dtype=np.int32)
        x = (h ^ (h >> np.uint32(15))) * _K[0]
        f[:len(h)] = (x >> np.uint32(32 - BITS)).astype(np.int32)
        for back in range(1, n + 1):
            at = offs[1:] - back
            f[at[at >= 0]] = 1 << BITS
        out.append(f)
    return out, offs


@dataclass
class Model:
    """Learned languages in code point order, and one row of class weights per feature."""
    langs: list[str]
    weights: np.ndarray  # (2**BITS + 1, languages), last row zero
    bias: np.ndarray
    temperature: float = 1.0
    prior: np.ndarray | float = 0.0  # log shares of the languages against those in the sample

    def logits(self, texts: list[str | None]) -> np.ndarray:
        grams, offs = _grams(texts)
        sums = np.zeros((len(texts), len(self.langs)))
        if offs[-1]:
            each = self.weights[grams[0]]
            for f in grams[1:]:
                each += self.weights[f]
            full = np.flatnonzero(offs[1:] > offs[:-1])
            sums[full] = np.add.reduceat(each, offs[full], axis=0, dtype=np.float64)
        n = np.diff(offs)
        count = n + np.maximum(n - 1, 0) + np.maximum(n - 2, 0)
        return sums / np.maximum(count, 1)[:, None] + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        score = np.zeros(len(texts))
        if not self.langs:
            return [UNKNOWN] * len(texts), score
        p = _softmax(self.logits(texts) / self.temperature + self.prior)
        best = p.argmax(axis=1)
        names = [self.langs[b] if t and _LETTER(t) else UNKNOWN for t, b in zip(texts, best)]
        score = np.where(np.array([x == UNKNOWN for x in names], dtype=bool), 0.0, p.max(axis=1))
        return names, score


    def known(self, texts: list[str | None]) -> np.ndarray:
        """Per text: the share of its n-grams that bear a weight for some
        language, of n-grams of letters and blanks only (numbers, signs and what
        they border are left out). Texts in the learned languages come near 1,
        however many languages there are; a text without letters has 0."""
        bears = np.append((self.weights[:-1] != 0).any(axis=1), False)
        grams, offs = _grams([_WORDS_ONLY.sub(" ", t) if t else None for t in texts])
        out = np.zeros(len(texts))
        if offs[-1]:
            full = np.flatnonzero(offs[1:] > offs[:-1])
            at = offs[full]
            hit = sum(np.add.reduceat(bears[f], at, dtype=np.int64) for f in grams)
            every = sum(np.add.reduceat(f < 1 << BITS, at, dtype=np.int64) for f in grams)
            out[full] = hit / every
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _sample_counts(df: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """(label, h, features, counts) of each row: its distinct n-grams, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in vec.chunks(batches, text_col, 1 << 20):
            texts = part.column(text_col).to_pylist()
            grams, offs = _grams(texts)
            ids, counts = [], []
            for a, b in zip(offs, offs[1:]):
                f, n = np.unique(np.concatenate([g[a:b] for g in grams]), return_counts=True)
                keep = f < 1 << BITS
                ids.append(f[keep].astype("<i4").tobytes())
                counts.append(n[keep].astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column(label_col), part.column("h"), pa.array(ids, type=pa.binary()), pa.array(counts, type=pa.binary())],
                names=["label", "h", "features", "counts"])

    return df.mapInArrow(vec.trimmed(run), "label string, h long, features binary, counts binary")


def train(df: DataFrame, text_col: str = "text", label_col: str = "lang", key_col: str = "doc_id",
          sample_rows: int = 3000, epochs: int = 4, alpha: float = 0.3, beta: float = 1.0,
          l1: float = 0.02, l2: float = 0.1) -> Model:
    """Fit on a sample of about ``sample_rows`` labelled rows, the same share
    of them for each language as far as it has rows. The sample is chosen by
    a hash of ``key_col`` and the text among the rows that differ in either; rows
    alike in both count once. Only n-gram counts come to the driver, and
    their size is bounded by ``sample_rows`` (drawn by hash, so a few per cent
    more or less) and the number of features."""
    rows = df.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    both = F.xxhash64(F.col(key_col).cast("string"), F.col(text_col), F.lit(9))
    found = rows.groupBy(label_col).agg(F.count("*"), F.approx_count_distinct(both, 0.02)).collect()  # one row per language
    n, distinct = {r[0]: r[1] for r in found}, {r[0]: r[2] for r in found}
    langs = sorted(n)
    if not langs:
        return Model([], np.zeros(((1 << BITS) + 1, 0), dtype=np.float32), np.zeros(0))
    share = sample_rows / len(langs)
    steps = 1 << 30
    rate = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(int(steps * min(1.0, share / max(distinct[k], 1)))))])
    drawn = rows.filter(F.pmod(both, F.lit(steps)) < rate[F.col(label_col)]).select(label_col, text_col, both.alias("h"))
    got = _sample_counts(drawn, text_col, label_col).distinct().collect()
    got.sort(key=lambda r: (r["label"], bytes(r["features"]), bytes(r["counts"])))
    order = np.random.default_rng(9).permutation(len(got))
    docs = [(langs.index(got[i]["label"]), np.frombuffer(got[i]["features"], dtype="<i4"),
             np.frombuffer(got[i]["counts"], dtype="<i4").astype(np.float64)) for i in order]
    docs = [d for d in docs if len(d[1])]
    df_count = np.zeros(1 << BITS)
    for _, f, _ in docs:
        df_count[f] += 1
    idf = np.log((1 + len(docs)) / (1 + df_count)) + 1
    data = [(y, f, SCALE * c / c.sum() * idf[f]) for y, f, c in docs]
    held, kept = data[::5], [d for i, d in enumerate(data) if i % 5]
    w, bias = _ftrl(kept or data, len(langs), epochs, alpha, beta, l1, l2)
    temperature = _temperature(held, w, bias)
    full = np.zeros(((1 << BITS) + 1, len(langs)), dtype=np.float32)
    full[:-1] = w * idf[:, None] * SCALE
    sampled = np.bincount([d[0] for d in docs], minlength=len(langs)) if docs else np.ones(len(langs))
    prior = np.log([n[k] for k in langs]) - np.log(np.maximum(sampled, 1))
    return Model(langs, full, bias, temperature, prior - prior.max())


def _ftrl(data, n_classes: int, epochs: int, alpha: float, beta: float, l1: float, l2: float):
    """Follow-the-regularised-leader, one document at a time."""
    dim = (1 << BITS) + 1  # the last feature is the bias, with value 1 and no penalty
    z, n = np.zeros((dim, n_classes)), np.zeros((dim, n_classes))

    def weights(zf, nf):
        return np.where(np.abs(zf) <= l1, 0.0, (np.sign(zf) * l1 - zf) / ((beta + np.sqrt(nf)) / alpha + l2))

    for _ in range(epochs):
        for y, f, x in data:
            zf, nf, zb, nb = z[f], n[f], z[-1], n[-1]
            w, b = weights(zf, nf), -zb / ((beta + np.sqrt(nb)) / alpha)
            g = _softmax(x @ w + b)
            g[y] -= 1
            gf = x[:, None] * g
            root = np.sqrt(nf + gf * gf)
            z[f] = zf + gf - (root - np.sqrt(nf)) / alpha * w
            n[f] = nf + gf * gf
            z[-1] = zb + g - (np.sqrt(nb + g * g) - np.sqrt(nb)) / alpha * b
            n[-1] = nb + g * g
    return weights(z[:-1], n[:-1]), -z[-1] / ((beta + np.sqrt(n[-1])) / alpha)


def _temperature(held, w: np.ndarray, bias: np.ndarray) -> float:
    """The temperature of least log loss on the held-back documents."""
    if not held:
        return 1.0
    logits = np.array([x @ w[f] + bias for _, f, x in held])
    y = np.array([d[0] for d in held])

    def loss(t: float) -> float:
        p = _softmax(logits / t)
        return -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()

    grid = np.exp(np.linspace(np.log(0.1), np.log(10), 121))
    return float(min(grid, key=loss))


def predict(df: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred",
            score_col: str = "score", known_col: str | None = None) -> DataFrame:
    """All columns of ``df`` plus the predicted language and its calibrated
    probability, and under ``known_col``, if named, the share of known n-grams
    (:meth:`Model.known`)."""
    added = [T.StructField(lang_col, T.StringType()), T.StructField(score_col, T.DoubleType())]
    if known_col:
        added.append(T.StructField(known_col, T.DoubleType()))
    new = [f.name for f in added]
    kept = [f for f in df.schema.fields if f.name not in new]
    names = [f.name for f in kept]
    shared = df.sparkSession.sparkContext.broadcast(model)  # a few MB, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in vec.chunks(batches, text_col, 1 << 20):
            texts = part.column(text_col).to_pylist()
            langs, score = shared.value.predict(texts)
            out = [pa.array(langs, type=pa.string()), pa.array(score, type=pa.float64())]
            if known_col:
                out.append(pa.array(shared.value.known(texts), type=pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + out, names=names + new)

    return df.mapInArrow(vec.trimmed(run), T.StructType(kept + added))
