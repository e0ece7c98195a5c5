"""Mixing sources to target weights by cube-method balanced sampling.

Each source gets a target number of words; target over size is how often a
document of it is to be taken on average. The whole part of that is taken for
certain. The rest is an inclusion probability, and the cube method moves all
probabilities of a source to 0 or 1 along directions that leave two totals as
they are: expected words and expected documents (three documents at a time
span one such direction). Blocks of some thousand documents move on their own;
the one or two documents that a block cannot settle go on to the next round,
where many blocks meet. In the last round a dozen documents of each source are
held out; with the two that the flight leaves at most they make the landing
problem, settled by the choice that leaves the words nearest to their total.

Random choices are drawn from the seed and the block, units are ordered by a
hash of their key, so reruns agree whatever the partitioning.

Defined cases: null text has size 0; null is a source of its own, last in the
order of sources; empty documents are taken or not without bearing on words;
rows that repeat are units of their own; an empty table gives an empty result.
Target sizes need one row per source in one place (a sort of the sources);
documents are never gathered beyond a block.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm import names
from tidewater.session import materialize

BLOCK = 4096
MEET = 512  # blocks that meet in the next round
RESERVE = 12  # units of a source that are settled in the landing
_EPS = 1e-9
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, share: float = 1.5, weights: tuple[int, ...] = (5, 2, 1),
            most: float = 2.0) -> DataFrame:
    """``sources`` (source, source_size) with rank and target.

    The sources in code point order, null last, weigh ``weights`` in turn and
    share ``share`` times all sizes; no target is above ``most`` times its
    source's size, the excess is reshared by weight. That is the level at which
    min(cap, level * weight) add up; the sources are sorted by the level at
    which they fill up, and running sums give the level."""
    everywhere = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = (sources.withColumn("rank", F.row_number().over(everywhere)).withColumn("weight", w)
              .withColumn("cap", most * F.col("source_size")).withColumn("full_at", F.col("cap") / F.col("weight")))
    up = Window.orderBy("full_at", "rank")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    whole = up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (share * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    found = (ranked.withColumn("level", level)
             .withColumn("level", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "rank", "level")))
                         .over(whole)["level"]))
    return found.select("source", "source_size", "rank",
                        F.least(F.col("cap"), F.coalesce(F.col("level"), F.lit(float("inf"))) * F.col("weight")).alias("target"))


def flight(size: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move probabilities to 0 or 1, keeping sum(p) and sum(size * p), until
    no three units (or two of one size) are undecided."""
    p = p.copy()
    draws = rng.random(2 * len(p) + 4).tolist()
    values, sizes = p.tolist(), size.tolist()
    rest = [i for i, x in enumerate(values) if _EPS < x < 1 - _EPS][::-1]
    hand: list[int] = []
    at = 0
    while True:
        while rest and len(hand) < 3:
            hand.append(rest.pop())
        if len(hand) == 3:
            a, b, c = (sizes[i] for i in hand)
            u = (b - c, c - a, a - b) if not a == b == c else (1.0, -1.0, 0.0)
        elif len(hand) == 2 and sizes[hand[0]] == sizes[hand[1]]:
            u = (1.0, -1.0)
        else:
            break
        up = down = math.inf
        for i, d in zip(hand, u):
            x = values[i]
            if d > 0:
                up, down = min(up, (1 - x) / d), min(down, x / d)
            elif d < 0:
                up, down = min(up, -x / d), min(down, (x - 1) / d)
        step = up if draws[at] * (up + down) < down else -down
        at += 1
        kept = []
        for i, d in zip(hand, u):
            x = values[i] + step * d
            x = 0.0 if x < _EPS else 1.0 if x > 1 - _EPS else x
            values[i] = x
            if 0.0 < x < 1.0:
                kept.append(i)
        hand = kept
        if at >= len(draws):
            draws += rng.random(len(p) + 4).tolist()
    return np.array(values)


def land(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Settle the last undecided units (14 at most): of all choices whose
    documents stay within one of their total, the one whose words stay
    nearest to theirs."""
    p = p.copy()
    open_ = np.flatnonzero((p > _EPS) & (p < 1 - _EPS))
    if len(open_):
        s = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
        words = np.abs(s @ size[open_] - size[open_] @ p[open_])
        docs = np.abs(s.sum(1) - p[open_].sum())
        p[open_] = s[np.lexsort((docs, words, docs >= 1))[0]]
    return np.round(p)


def _mover(seed: int, r: int, last: bool):
    """The flight over one block of round ``r``, and in the last one the landing."""
    def move(pdf: pd.DataFrame) -> pd.DataFrame:
        # neighbours in size trade places, and what stays open at the end is small
        pdf = pdf.sort_values(["size", "h", "p"], ascending=False, kind="stable")
        key = [seed, r, int(pdf["rank"].iloc[0]), int(pdf["__block"].iloc[0])]
        size, p = pdf["size"].to_numpy(dtype=float), pdf["p"].to_numpy(dtype=float).copy()
        rng = np.random.default_rng(key)
        if last:  # a few units are kept for the landing
            kept = np.flatnonzero((p > _EPS) & (p < 1 - _EPS))
            kept = kept[np.argsort(pdf["h"].to_numpy()[kept], kind="stable")[:RESERVE]]
            own = p[kept].copy()
            p[kept] = 0
            p = flight(size, p, rng)
            p[kept] = own
            p = land(size, p)
        else:
            p = flight(size, p, rng)
        pdf["p"] = p
        return pdf

    return move


def sample(units: DataFrame, seed: int = 6) -> DataFrame:
    """Cube sampling within each source: ``units`` (any columns, among them
    h: a long to order by, rank: the source's number, size, p, n_source: its
    number of units) come back with p at 0 or 1."""
    schema = units.schema
    names = units.columns
    blocks = units.agg(F.max("n_source")).first()[0] or 0
    blocks = max(1, -(-blocks // BLOCK))
    rounds = 1 + math.ceil(math.log(blocks, MEET) - 1e-12) if blocks > 1 else 1
    own = F.pmod(F.xxhash64("h", F.lit(seed)), F.greatest(F.lit(1), F.ceil(F.col("n_source") / BLOCK)).cast("long"))
    todo, settled = units.withColumn("__block", own), None
    for r in range(rounds):
        last = r == rounds - 1
        moved = materialize(todo.groupBy("rank", "__block").applyInPandas(_mover(seed, r, last), todo.schema), "cube", "parquet")
        is_open = (F.col("p") > 0) & (F.col("p") < 1)
        done = moved.filter(~is_open).select(*names)
        settled = done if settled is None else settled.unionByName(done)
        todo = moved.filter(is_open).withColumn("__block", F.floor(F.col("__block") / MEET).cast("long"))
    return settled.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", share: float = 1.5,
        weights: tuple[int, ...] = (5, 2, 1), most: float = 2.0, seed: int = 6) -> DataFrame:
    """(key, h, size, source_size, target, copies), one row per document:
    ``copies`` is how often the mix takes it. ``h`` tells rows of one key
    apart by their text and source; rows alike in all three are alike here."""
    rows = materialize(docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        F.xxhash64(F.col(key).cast("string"), F.col(text), F.col(source)).alias("h")), "sizes", "parquet")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_source"))
    goal = targets(sources.select("source", "source_size"), share, weights, most)
    goal = materialize(goal.join(sources.select(F.col("source").alias("s"), "n_source"), F.col("source").eqNullSafe(F.col("s")))
                       .drop("s").withColumnRenamed("source", "s"), "targets", "parquet")
    units = (rows.join(goal, F.col("source").eqNullSafe(F.col("s"))).drop("s", "source")
             .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
             .withColumn("sure", F.floor(F.col("rate") + _EPS).cast("int"))
             .withColumn("p", F.greatest(F.lit(0.0), F.col("rate") - F.col("sure"))))
    out = sample(units, seed)
    return out.select(F.col("key").alias(key), "h", "size", "source_size", "target",
                      (F.col("sure") + F.when(F.col("p") > 0.5, 1).otherwise(0)).alias("copies"))


def take(docs: DataFrame, mixed: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as ``mixed`` (of the
    same table) takes it, with the columns of ``docs``."""
    h, n, copies, i = names.free(docs, "h", "n", "copies", "i")
    hashed = F.xxhash64(F.col(key).cast("string"), F.col(text), F.col(source))
    left = docs.withColumn(h, hashed).withColumn(n, F.row_number().over(Window.partitionBy(h).orderBy(h)))
    right = (mixed.select(F.col("h").alias(h), F.col("copies").alias(copies))
             .withColumn(n, F.row_number().over(Window.partitionBy(h).orderBy(copies))))
    return (left.join(right, [h, n]).withColumn(i, F.explode(F.sequence(F.lit(1), F.col(copies))))
            .filter(F.col(copies) > 0).select(*docs.columns))
