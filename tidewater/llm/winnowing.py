"""Document fingerprints by winnowing, DataFrame functions only.

The words of a text are hashed, every ``k`` successive hashes give a rolling
k-gram hash (a cyclic polynomial), and of every ``w`` successive k-gram hashes
the least is chosen, the rightmost of equal ones. What is chosen, with its
position, is the fingerprint: any stretch of ``w + k - 1`` words that two
texts share leaves a common hash in both, and nothing shorter than ``k``
words ever does.

A k-gram hash and its position travel in one long: the hash in the upper
bits, the position counted down in the lower ones. The least long of a window
is then the least hash at its rightmost position, found by halving windows
(least of two, of four, ...) instead of a scan per window.

Defined cases: null text counts as empty; a text without words has an empty
fingerprint, one of fewer than ``k`` words the hash of all its words, one of
fewer than ``w`` k-grams the least of those; two empty fingerprints are
alike (1.0), an empty and another one are not (0.0). Positions are exact to
2**21 words; beyond that they count on from 0 again, hashes stay right.
An empty table gives an empty result. Repeated rows, ties and extra columns,
whatever their names, change nothing; a column that bears an output name is
replaced. Very long texts are one row like any other.
"""

from __future__ import annotations

from collections import Counter
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm import names

POSITION_BITS = 21
_LOW = (1 << POSITION_BITS) - 1
_WORDS = r"[\x20\x09-\x0D]+"


def _pairwise(a: Column, n: Column, step: int) -> Column:
    """Least of each value and the one ``step`` on; ``n`` values come out."""
    return F.transform(F.slice(a, F.lit(1), n), lambda x, i: F.least(x, F.get(a, i + step)))


def add_fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint", k: int = 4, w: int = 4) -> DataFrame:
    """All columns of ``df`` plus ``out``: array of longs, one per chosen
    k-gram in the order of the text; see ``hashes`` and ``positions``.

    Each step is a column of its own, so that no array is worked out twice."""
    h, g = names.free(df, f"{out}_h", f"{out}_g")
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), _WORDS), lambda x: x != "")
    df = df.withColumn(h, F.transform(words, lambda x: F.xxhash64(x)))
    at = F.col(h)
    n = F.size(at)

    def gram(x: Column, i: Column) -> Column:
        # cyclic polynomial: each word's hash turned by its place in the gram
        rolled = x
        for j in range(1, k):
            y = F.get(at, i + j)
            rolled = rolled.bitwiseXOR(F.shiftleft(y, 13 * j % 64).bitwiseOR(F.shiftrightunsigned(y, 64 - 13 * j % 64)))
        return rolled.bitwiseAND(F.lit(~_LOW)).bitwiseOR((F.lit(_LOW) - i.cast("long")).bitwiseAND(F.lit(_LOW)))

    short = F.array(F.xxhash64(at).bitwiseAND(F.lit(~_LOW)).bitwiseOR(F.lit(_LOW)))
    df = df.withColumn(g, F.when(n == 0, F.array().cast("array<bigint>")).when(n < k, short)
                       .otherwise(F.transform(F.slice(at, F.lit(1), F.greatest(n - (k - 1), F.lit(0))), gram)))
    temp = [h, g]
    # windows of 2, 4, .. up to w by halves; a rest that is no power of two overlaps
    have, cur = 1, g
    while have < w:
        step = min(have, w - have)
        nxt, = names.free(df, f"{out}_w{have + step}")
        a = F.col(cur)
        df = df.withColumn(nxt, F.when(F.size(a) > step, _pairwise(a, F.size(a) - step, step))
                           .when(F.size(a) > 1, F.array(F.array_min(a))).otherwise(a))
        temp.append(nxt)
        cur, have = nxt, have + step
    return df.withColumn(out, F.array_distinct(cur)).drop(*temp)


def hashes(fingerprint: Column) -> Column:
    """The distinct chosen hashes."""
    return F.array_distinct(F.transform(fingerprint, lambda x: F.shiftright(x, POSITION_BITS)))


def positions(fingerprint: Column) -> Column:
    """The word position of each chosen k-gram."""
    return F.transform(fingerprint, lambda x: F.lit(_LOW) - x.bitwiseAND(F.lit(_LOW)))


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes among all of two hash arrays (0 to 1)."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every == 0, 1.0).otherwise(both / every)


def _constant(values: list[int]) -> Column:
    """An array of longs as one constant of the plan."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _tie_cuts(df: DataFrame, key: str, tie: str, shares: dict[int, int]) -> dict[int, list[int]]:
    """Bounds of ``tie`` within each key that fills two ranges or more: as many
    as its share, rounded down to a power of two, so all of them together are
    no more than there are ranges. One pass for each power that occurs."""
    out = {}
    for power in sorted({n.bit_length() - 1 for n in shares.values() if n > 1}):
        keys, n = [k for k, share in shares.items() if share.bit_length() - 1 == power], 1 << power
        got = (df.filter(F.array_contains(_constant(keys), F.col(key))).groupBy(key)
               .agg(F.percentile_approx(tie, [i / n for i in range(1, n)], 10 * n)).collect())
        out.update({r[0]: sorted(set(r[1])) for r in got})
    return out


def ranges_of(df: DataFrame, key: str, tie: str, bucket: str) -> DataFrame:
    """All rows with ``bucket``: the number of their range of (``key``,
    ``tie``) (longs, not null), at most four ranges to a shuffle partition. Rows
    alike in both share one.

    The bounds are approximate quantiles of the key over all rows, and of the
    tie within keys that several of them fall on; they stand as array constants
    in the plan, and each row finds its range in two steps (root of the bounds
    each)."""
    parts = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    got = df.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)], 10 * parts)).first()[0]
    times = Counter(got or [])
    if not times:
        return df.withColumn(bucket, F.lit(0))
    bounds = sorted(times)
    within_key = _tie_cuts(df, key, tie, times)
    cuts = [[-(1 << 63), *within_key.get(b, [])] for b in bounds]  # fewer than ``parts`` in all, or as many
    shares = [len(c) for c in cuts]
    firsts = [1 + before for before in accumulate([0, *shares[:-1]])]
    step = max(1, int(len(bounds) ** 0.5))
    k = F.col(key)
    group = F.size(F.filter(_constant(bounds[::step]), lambda x: x <= k))
    near = F.slice(_constant(bounds), F.greatest(group - 1, F.lit(0)) * step + 1, F.lit(step))
    at = (group - 1) * step + F.size(F.filter(near, lambda x: x <= k)) - 1  # the last bound not above the key
    first, share = F.get(_constant(firsts), at).cast("int"), F.get(_constant(shares), at).cast("int")
    mine = F.slice(_constant([c for of_key in cuts for c in of_key]), first, share)
    sub = F.when(F.get(_constant(bounds), at) == k, F.size(F.filter(mine, lambda x: x <= F.col(tie)))).otherwise(share)
    return df.withColumn(bucket, F.when(group == 0, F.lit(0)).otherwise(first + sub - 1).cast("int"))


def with_next(df: DataFrame, key: str, text: str = "text", prefix: str = "next_", derive=None) -> DataFrame:
    """``derive(df)``, each row with ``prefix + column`` for ``text`` and the
    derived columns of the next row by ascending ``key`` (of equal keys by
    text; null keys first; after the last row comes the first).

    Rows are dealt into ranges of the key and the first seven bytes of the
    text, so that one id of a third of all rows spreads over as many ranges
    as its texts tell apart there; a window covers one range. Of the other ranges only
    the first row is looked up, one row per range."""
    derive = derive or (lambda x: x)
    k, tie, bucket, b, nxt, first, least = names.free(derive(df), "key", "tie", "bucket", "to", "next", "first", "least")
    start = F.rpad(F.hex(F.substring(F.col(text).cast("binary"), 1, 7)), 14, "0")
    keyed = df.withColumn(k, F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))).withColumn(
        tie, F.coalesce(F.conv(start, 16, 10).cast("long"), F.lit(-1)))
    ranged = ranges_of(keyed, k, tie, bucket)
    heads = ranged.groupBy(bucket).agg(F.min(k).alias(least)).withColumnRenamed(bucket, b)  # one row per range
    firsts = derive(ranged.join(F.broadcast(heads), (F.col(bucket) == F.col(b)) & (F.col(k) == F.col(least)))
                    .groupBy(bucket).agg(F.min(F.coalesce(F.col(text), F.lit(""))).alias(text)))
    carried = firsts.columns[1:]
    by_bucket = Window.orderBy(bucket)  # as many rows as ranges
    follow = firsts.select(
        F.col(bucket).alias(b), F.lead(F.struct(*carried)).over(by_bucket).alias(first),
        F.first(F.struct(*carried)).over(by_bucket).alias(least)).select(b, F.coalesce(first, least).alias(first))
    w = Window.partitionBy(bucket).orderBy(k, F.col(text).asc_nulls_first())
    out = (derive(ranged.repartition(bucket)).withColumn(nxt, F.lead(F.struct(*carried)).over(w))
           .join(follow, F.col(bucket) == F.col(b), "left")
           .withColumn(nxt, F.coalesce(nxt, first)))
    hidden = {k, tie, bucket, b, nxt, first, *[prefix + c for c in carried]}
    return out.select(*[c for c in out.columns if c not in hidden],
                      *[F.col(nxt)[c].alias(prefix + c) for c in carried])
