"""Embedding near-dedup: cross-polytope hashing with multiprobe, pairs verified.

Vectors that are equal in every bit are one class from the start. A class is
hashed in several tables: random signs and fast Hadamard transforms rotate
the vector, and the axis (with sign) of its largest coordinate is one part of
a bucket's code; the next-largest axes give probe buckets, in which the class
is entered as well. Classes that share a bucket are compared by their cosine
in double precision. A bucket of any size is compared in full: beyond
``block`` classes it is dealt into blocks, and every pair of blocks is a task
of its own. A pair that shares several buckets counts in the first of them
only, which either row's list of codes tells. Links are never written out as
pairs: a task returns one row per class with the vectors it links to there
and a spanning set of links.

Buckets are found from ids and codes alone. Those with one class are dropped,
and of buckets that hold the same classes the one of least code stays (which
is the first that any pair in them shares, so nothing is lost); only then are
vectors and codes fetched, once for each block that a class stands in.

A code has ``parts`` parts whatever the number of classes, so the same pairs
are candidates at every size. More parts make smaller buckets of unlike vectors
(2 * dimension to the power of ``parts`` of them in a table) and lose a few more
pairs: of random pairs at a cosine of 0.95, the shares found with 1, 2 and 3
parts are tested to be 0.99 or more in 64 and in 384 dimensions.

Defined cases: a null vector, one with null or non-finite components, or a
zero vector links with nothing; vectors of different lengths do not link;
rows that repeat a vector link with each other; a null id is kept and links
with nothing; an empty table gives an empty table. Only the two named columns
are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm import vec
from tidewater.llm.components import connected_components
from tidewater.session import materialize


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (length a power of two)."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(n, d)
        h *= 2
    return x


def codes(x: np.ndarray, tables: int, parts: int, probes: int, seed: int = 10) -> np.ndarray:
    """(vectors, tables, probes) bucket codes of unit vectors, own bucket first."""
    n, dim = x.shape
    d = max(2, 1 << (dim - 1).bit_length())
    padded = np.zeros((n, d))
    padded[:, :dim] = x
    reach = min(d, 4)
    out = np.empty((n, tables, probes), dtype=np.int64)
    for t in range(tables):
        axes, losses = [], []
        for k in range(parts):
            y = padded
            rng = np.random.default_rng([seed, t, k, d])
            for _ in range(3):
                y = _hadamard(y * rng.choice((-1.0, 1.0), d)) / math.sqrt(d)
            size = np.abs(y)
            top = np.argsort(-size, axis=1, kind="stable")[:, :reach]
            large = np.take_along_axis(size, top, 1)
            axes.append(2 * top + (np.take_along_axis(y, top, 1) < 0))
            losses.append((large[:, :1] - large) ** 2)
        combos = sorted(product(range(reach), repeat=parts), key=lambda c: (sum(c), c))
        loss = np.stack([sum(losses[k][:, c[k]] for k in range(parts)) for c in combos], axis=1)
        best = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        code = np.zeros((n, len(combos)), dtype=np.int64)
        for k in range(parts):
            code = code * (2 * d) + axes[k][:, [c[k] for c in combos]]
        got = np.take_along_axis(code, best, 1)
        if got.shape[1] < probes:
            got = np.repeat(got, -(-probes // got.shape[1]), axis=1)[:, :probes]
        out[:, t] = got + (np.int64(t) << 56)
    return out


def _rows(column: pa.Array, dtype: str) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), dtype=dtype).astype(np.float64).reshape(len(raw), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _compare(x: np.ndarray, n: np.ndarray, sig: np.ndarray, rep: np.ndarray, left: np.ndarray, right: np.ndarray,
             code: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the classes of one task: vectors newly linked to each, and each
    one's least linked class (through links of this task)."""
    a, b = np.flatnonzero(left), np.flatnonzero(right)
    link = x[a] @ x[b].T >= least
    i, j = np.nonzero(link)
    i, j = a[i], b[j]
    keep = i < j if a is b or np.array_equal(a, b) else i != j
    i, j = i[keep], j[keep]
    linked = np.zeros(len(x), dtype=np.int64)
    label = np.arange(len(x))
    if len(i):
        first = np.full(len(i), np.iinfo(np.int64).max)
        for t in range(sig.shape[1]):
            for p, q in product(range(sig.shape[2]), repeat=2):
                same = sig[i, t, p] == sig[j, t, q]
                first = np.where(same, np.minimum(first, sig[i, t, p]), first)
        own = first == code
        np.add.at(linked, i[own], n[j[own]])
        np.add.at(linked, j[own], n[i[own]])
        while True:  # least label along the links
            was = label.copy()
            np.minimum.at(label, i, was[j])
            np.minimum.at(label, j, was[i])
            label = label[label]
            if np.array_equal(label, was):
                break
    return linked, rep[label]


def dedup(df: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.95,
          tables: int = 8, probes: int = 3, parts: int = 3, block: int = 512) -> DataFrame:
    """(key, n_links, component_id, kept), one row per row of ``df``."""
    double = "double" in df.schema[vector].dataType.simpleString()
    dtype, width = ("<f8", 8) if double else ("<f4", 4)
    numbers = F.col(vector).cast("array<double>")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            raw = [np.array(v, dtype=dtype).tobytes() for v in part.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(raw, type=pa.binary())], names=["id", "vec"])

    fine = (F.size(numbers) > 0) & F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & \
        F.exists(numbers, lambda x: x != 0) & F.col(key).isNotNull()
    ids = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), F.coalesce(fine, F.lit(False)).alias("fine"))
    good = materialize(ids.filter("fine").select("id", "v").mapInArrow(vec.trimmed(pack), "id long, vec binary"), "vectors", "parquet")
    classes = materialize(good.groupBy("vec").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "classes", "parquet")
    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                raw = part.column("vec").to_pylist()
                dims = np.array([len(v) // width for v in raw])
                for d in np.unique(dims):
                    mine = part.filter(pa.array(dims == d))
                    sig = codes(_unit(_rows(mine.column("vec"), dtype)), tables, parts, probes)
                    flat = pa.array(sig.ravel())
                    offsets = pa.array(np.arange(len(sig) + 1, dtype=np.int32) * (tables * probes))
                    yield pa.RecordBatch.from_arrays(
                        [mine.column("rep"), mine.column("n"), pa.array(np.full(len(sig), d, dtype=np.int32)), mine.column("vec"),
                         pa.ListArray.from_arrays(offsets, flat)], names=["rep", "n", "dim", "vec", "sig"])

    hashed = materialize(classes.select("rep", "n", "vec").mapInArrow(
        vec.trimmed(enter), "rep long, n long, dim int, vec binary, sig array<long>"), "hashed", "parquet")
    entries = hashed.select("rep", "dim", F.explode(F.array_distinct("sig")).alias("code"))
    buckets = entries.groupBy("dim", "code").agg(
        F.count("*").alias("load"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y"))
    load = (buckets.filter("load > 1").groupBy("dim", "load", "x", "y").agg(F.min("code").alias("code"))
            .select("dim", "code", F.ceil(F.col("load") / block).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = (entries.join(load, ["dim", "code"]).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("code", "dim", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "rep"))
    dealt = dealt.join(hashed.drop("dim"), "rep").select("code", "dim", "lo", "hi", "own", "rep", "n", "vec", "sig")
    task = ["code", "dim", "lo", "hi"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            whole = pa.Table.from_batches([batch])
            whole = pa.concat_tables([rest, whole]) if rest is not None else whole
            whole = whole.combine_chunks()
            cuts = _cuts(whole)
            if len(cuts) > 1:
                yield from _run(whole.slice(0, cuts[-1]), cuts)
            rest = whole.slice(cuts[-1])
        if rest is not None and rest.num_rows:
            yield from _run(rest.combine_chunks(), _cuts(rest) + [rest.num_rows])

    def _cuts(t: pa.Table) -> list[int]:
        cols = [t.column(c).to_numpy() for c in task]
        new = np.zeros(t.num_rows, dtype=bool)
        new[:1] = True
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        return np.flatnonzero(new).tolist()

    def _run(t: pa.Table, cuts: list[int]) -> Iterator[pa.RecordBatch]:
        code, lo, hi, own_, rep, n = (t.column(c).to_numpy() for c in ("code", "lo", "hi", "own", "rep", "n"))
        out_rep, out_linked, out_low = [], [], []
        for a, b in zip(cuts, cuts[1:]):
            if b - a < 2:
                continue
            part = t.slice(a, b - a)
            x = _unit(_rows(part.column("vec"), dtype))
            sig = part.column("sig").combine_chunks().flatten().to_numpy().reshape(b - a, tables, probes)
            linked, low = _compare(x, n[a:b], sig, rep[a:b], own_[a:b] == lo[a], own_[a:b] == hi[a], int(code[a]), least)
            some = (linked > 0) | (low != rep[a:b])
            out_rep.append(rep[a:b][some])
            out_linked.append(linked[some])
            out_low.append(low[some])
        if out_rep:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in (out_rep, out_linked, out_low)],
                                             names=["rep", "linked", "low"])

    found = materialize(dealt.repartition(*task).sortWithinPartitions(*task).mapInArrow(
        vec.trimmed(compare), "rep long, linked long, low long"), "linked", "parquet")
    linked = found.groupBy("rep").agg(F.sum("linked").alias("linked"))
    comps = connected_components(found.filter("rep != low").select(F.col("rep").alias("a"), F.col("low").alias("b")))
    result = (classes.join(linked.withColumnRenamed("rep", "r1"), F.col("rep") == F.col("r1"), "left")
              .join(comps, F.col("rep") == F.col("node"), "left")
              .select("vec", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
                      F.coalesce("component", "rep").alias("component_id")))
    members = good.join(result, "vec").select(F.col("id").alias(key), "n_links", "component_id")
    alone = ids.filter("NOT fine").select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"),
                                          F.col("id").alias("component_id"))
    return members.unionByName(alone).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
