"""Entity resolution between a current and a legacy master (J1-J5, A1, A2, O2,
F5-F7).

Scale notes
-----------
* Exact matching joins on a SHA-256 digest of the composite key, not on the
  key text, so the shuffle moves 64 bytes per row whatever the text size.
* A hot key (one key held by a third of all rows) must not turn into N x M
  output: the legacy side is first reduced to one row per key
  (representative id = smallest id, plus the group size) with a map-side
  partial aggregate, and each current row then links to that one row.
  Output is linear in the input.
* The similarity join is exact Jaccard with prefix filtering: tokens are
  ordered rarest-first by document frequency (on 64-bit token hashes), and
  the threshold is a fraction, so the prefix lengths are exact integers. The
  shorter set of a pair needs a shorter prefix than the longer one; a common
  word of short names falls out of both. Candidates are verified on the real
  tokens. Identical token sets on one side are collapsed first, by digest, so
  a hot group of copies costs one row, not a quadratic block; the member
  tables tell which rows stand behind a set or key, linear in the input.
* MinHash LSH (AND within a band, OR across bands) is an equi-join on band
  hashes over the same collapsed sets, verified exactly. The signatures come
  from portable integer arithmetic on md5 values, or from MLlib.
* What both joins write grows with the tokens, not with the pairs that share one.
  Token sets are one line of text each and cross the network once; the index is
  dealt to buckets, one row per set and bucket with the set's keys there and one
  parity sketch (:mod:`.meet`). A task tells the pairs of its bucket by sizes and
  sketches, and only those that pass are written.
* An index list of more than ``BLOCK_ROWS`` rows on a side is cut into blocks,
  and each pair of blocks is a key of its own, so one hot token or band is many
  buckets' work.
* Candidates are verified in cells of near copies that share a partner, so a set's
  tokens are shuffled once for each cell it stands in, not for each candidate.
* A set's sketch is repeated in each bucket it stands in, so buckets are met in
  rounds: only one round's index rows are on disk at a time. A bucket is what a task
  holds, so their number follows from the bytes in one (``BUCKET_BYTES``).
"""

from __future__ import annotations

import os
from collections.abc import Callable
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import TOKEN_PATTERN, digest, token_set
from ..session import delete_path, materialize, release_shuffles
from . import meet

MAX_DISTANCE = 0.5
LSH_BANDS, LSH_ROWS = 20, 3
BLOCK_ROWS = 1024
#: Sets of a side that are verified together in a task, about.
CELL_ROWS = 256
#: Tokens whose frequency is known to all tasks, lists that are cut into blocks: so many at most.
COMMON_TOKENS, HOT_LISTS = 100_000, 50_000
#: Index entries in a bucket, bytes that its task holds, about; the least number of buckets.
BUCKET_ENTRIES, BUCKET_BYTES, LEAST_BUCKETS = 3_000_000, 96 << 20, 12
#: Buckets that are shuffled in a round, about, unless that takes more rounds than this.
ROUND_BUCKETS, MOST_ROUNDS = 12, 16
TF_NUM_FEATURES = 1 << 18
_MINHASH_PRIME = (1 << 31) - 1


def exact_match_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str,
                      key: str = "det_key", empty_col: str | None = None,
                      out_left: str = "v2_id", out_right: str = "lg_id",
                      key_is_digest: bool = False) -> DataFrame:
    """Each left row whose key occurs on the right, linked to the right group.

    Columns: ``out_left``, ``out_right`` (smallest right id with that key),
    ``n_right`` (right rows with that key), ``key_sha256`` (``key`` itself
    when it already is the digest).
    """
    def keyed(df, idc):
        d = df
        if empty_col and empty_col in df.columns:
            d = d.filter(~F.col(empty_col))
        k = F.col(key) if key_is_digest else digest(key)
        return d.select(F.col(idc).alias("_id"), k.alias("key_sha256"))

    r = (keyed(right, right_id).groupBy("key_sha256")
         .agg(F.min("_id").alias(out_right), F.count(F.lit(1)).alias("n_right")))
    return (keyed(left, left_id).withColumnRenamed("_id", out_left)
            .join(r, "key_sha256", "inner")
            .select(out_left, out_right, "n_right", "key_sha256"))


def exact_match_members(left: DataFrame, right: DataFrame, left_id: str, right_id: str,
                        key: str = "det_key", empty_col: str | None = None,
                        key_is_digest: bool = False) -> DataFrame:
    """J1, complete: (key_sha256, side, id) of every row of either side whose
    key stands on both (side 0 = left). Joining it with itself on the key gives
    all matched pairs; the table itself is linear in the input."""
    def keyed(df, idc, side):
        d = df.filter(~F.col(empty_col)) if empty_col and empty_col in df.columns else df
        k = F.col(key) if key_is_digest else digest(key)
        return d.select(k.alias("key_sha256"), F.lit(side).alias("side"), F.col(idc).alias("id"))

    rows = keyed(left, left_id, 0).unionByName(keyed(right, right_id, 1))
    both = (rows.groupBy("key_sha256").agg(F.min("side").alias("lo"), F.max("side").alias("hi"))
            .filter("lo < hi").select("key_sha256"))
    return rows.join(both, "key_sha256")


def unmatched(side: DataFrame, other: DataFrame, key: str = "det_key",
              empty_col: str | None = None, key_is_digest: bool = False) -> DataFrame:
    """Rows of ``side`` whose key has no exact counterpart in ``other``.

    The keys both sides share are found first from 64-byte digest rows
    (distinct on each side, so a hot key collapses map-side); only then are
    the full ``side`` rows anti-joined against that matched-key set, which
    AQE broadcasts when it measures small -- the wide rows (texts, token
    arrays) then never cross the network for this step.
    """
    k = F.col(key) if key_is_digest else digest(key)
    o = other
    if empty_col and empty_col in other.columns:
        o = o.filter(~F.col(empty_col))
    other_keys = o.select(k.alias("_k")).distinct()
    side_keys = side.select(k.alias("_k")).distinct()
    matched = side_keys.join(other_keys, "_k", "left_semi")
    return side.withColumn("_k", k).join(matched, "_k", "left_anti").drop("_k")


def load_counts(sides: dict[str, DataFrame]) -> DataFrame:
    """A1: row count per named input, as one small table."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("side", F.lit(name))
             for name, df in sides.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("side", "n_rows")


# ---------------------------------------------------------------- Jaccard join

def _side_tokens(df: DataFrame, id_col: str, text_col: str | None, tokens_col: str | None,
                 pattern: str, side: int) -> DataFrame:
    toks = F.sort_array(F.array_distinct(F.col(tokens_col))) if tokens_col \
        else token_set(text_col, pattern)
    return (df.select(F.col(id_col).alias("_id"), toks.alias("toks"))
            .filter(F.size("toks") > 0).withColumn("side", F.lit(side)))


def _sets(left: DataFrame, left_id: str, right: DataFrame, right_id: str, text_col: str | None,
          tokens_col: str | None, pattern: str, digest_col: str | None = None, token_sets: DataFrame | None = None) -> DataFrame:
    """Distinct token sets: (side, rep, cnt, name, n, toks).

    Identical sets collapse into one row, keyed by the smallest member id
    (``rep``, unique within the side); ``name`` is a hash of the set. Sets are
    grouped by the SHA-256 digest of the sorted tokens; the partial aggregate runs
    before the shuffle, so a hot group of copies is already one row per map task.
    Both sides go through one aggregation (side 0 = ``left``).

    With ``token_sets`` the sides carry only the digest (``digest_col``, null
    without tokens), and the tokens, whatever the side, come from there: the
    only wide rows that are shuffled then are one per set and task.
    """
    members = [F.min("_id").alias("rep"), F.count(F.lit(1)).alias("cnt")]
    if token_sets is not None:
        rows = [df.select(F.lit(side).alias("side"), F.col(digest_col).alias("_d"), F.col(idc).alias("_id")).filter("_d IS NOT NULL")
                for side, df, idc in ((0, left, left_id), (1, right, right_id))]
        reps = rows[0].unionByName(rows[1]).groupBy("side", "_d").agg(*members)
        d = (token_sets.select(F.col(digest_col).alias("_d"), "toks").filter("_d IS NOT NULL")
             .groupBy("_d").agg(F.first("toks").alias("toks")).join(reps, "_d"))
    else:
        d = _side_tokens(left, left_id, text_col, tokens_col, pattern, 0).unionByName(
            _side_tokens(right, right_id, text_col, tokens_col, pattern, 1))
        d = d.select("side", "_id", set_digest("toks").alias("_d"), (pack_tokens("toks") if _packs(tokens_col, pattern) else F.col("toks")).alias("toks"))
        d = d.groupBy("side", "_d").agg(*members, F.first("toks").alias("toks"))
    d = d.filter("rep IS NOT NULL")
    return d.select("side", "rep", "cnt", F.xxhash64("_d").alias("name"), F.size(_tokens(d)).alias("n"), "toks")


def _packs(tokens_col: str | None, pattern: str) -> bool:
    """Whether tokens are known to hold no space."""
    return tokens_col is None and pattern == TOKEN_PATTERN


def pack_tokens(c: Column | str) -> Column:
    """A token set as one line of text, which takes a third of the array's room."""
    return F.array_join(c, " ")


def _tokens(sets: DataFrame, col: str = "toks") -> Column:
    return F.split(col, " ") if dict(sets.dtypes)[col] == "string" else F.col(col)


def set_digest(toks: Column | str) -> Column:
    return F.sha2(F.array_join(toks, "\x00"), 256)


def set_members(left: DataFrame, right: DataFrame, left_id: str, right_id: str, text_col: str | None = "text",
                tokens_col: str | None = None, pattern: str = TOKEN_PATTERN) -> DataFrame:
    """J4, complete: (side, rep, id), the rows behind each representative of
    the similarity joins (side 0 = left). Rows without tokens are in no set."""
    d = _side_tokens(left, left_id, text_col, tokens_col, pattern, 0).unionByName(
        _side_tokens(right, right_id, text_col, tokens_col, pattern, 1)).select("side", "_id", set_digest("toks").alias("_d"))
    reps = d.groupBy("side", "_d").agg(F.min("_id").alias("rep"))
    return d.join(reps, ["side", "_d"]).select("side", "rep", F.col("_id").alias("id"))


def block_pairs(entries: DataFrame, keys: list[str], row: str, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Both sides of ``entries`` (``side`` 0 and 1), ready to be joined on
    ``keys + ["_bl", "_br"]``: the rows that share ``keys`` with the other side,
    cut into ceil(n / ``block_rows``) blocks a side by a hash of ``row``, each row
    once for every block of the other side. Every pair of rows of a key meets
    exactly once; a key without a partner is gone before that."""
    n = [F.count(F.when(F.col("side") == i, 1)) for i in (0, 1)]
    sizes = (entries.groupBy(*keys).agg(n[0].alias("_nl"), n[1].alias("_nr")).filter("_nl > 0 AND _nr > 0")
             .select(*keys, *[F.ceil(F.col(c) / block_rows).cast("int").alias(k) for c, k in (("_nl", "_kl"), ("_nr", "_kr"))]))
    met = entries.join(sizes, keys)
    own = F.xxhash64(row, *keys)
    out = []
    for side, mine, other, k_mine, k_other in ((0, "_bl", "_br", "_kl", "_kr"), (1, "_br", "_bl", "_kr", "_kl")):
        out.append(met.filter(F.col("side") == side).withColumn(mine, F.pmod(own, F.col(k_mine)).cast("int"))
                   .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(k_other) - 1))).drop("side", "_kl", "_kr"))
    return out[0], out[1]


def _common_tokens(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ascending; rank by frequency) of the most frequent tokens,
    ``COMMON_TOKENS`` at most: those above the least quarter power of two that so
    few reach."""
    freq = sets.select(F.explode("hashes").alias("tok")).groupBy("tok").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    freq = freq.withColumn("step", F.floor(F.log2("df") * 4).cast("int"))
    freq = _staged(freq, "token_counts", "parquet")
    least, known = 1 << 30, 0
    for step, many in sorted(((r[0], r[1]) for r in freq.groupBy("step").count().collect()), reverse=True):
        known += many
        if known > COMMON_TOKENS:
            break
        least = step
    got = freq.filter(F.col("step") >= least).select("tok", "df").toArrow()
    tok, df = got.column("tok").to_numpy().view(np.uint64), got.column("df").to_numpy()
    rank = np.empty(len(tok), dtype=np.int64)
    rank[np.lexsort((tok, df))] = np.arange(len(tok))
    order = np.argsort(tok)
    return tok[order], rank[order]


def _lists(index: DataFrame) -> DataFrame:
    """(side, tok, n): the lengths of the lists of an index."""
    return index.select("side", F.explode("keys").alias("tok")).groupBy("side", "tok").agg(F.count(F.lit(1)).alias("n"))


def _dealt(lists: DataFrame, index: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(hot keys, numbers of blocks of both sides, number of buckets, side that tasks hold),
    from the lengths of the index lists (side, tok, n) and the index (``meet.INDEX``).
    Lists beyond ``BLOCK_ROWS`` are hot, or beyond such a share of all entries that there
    are ``HOT_LISTS`` at most."""
    total = lists.agg(F.sum("n")).first()[0] or 0
    most = max(BLOCK_ROWS, total // HOT_LISTS)
    nl, nr = (F.max(F.when(F.col("side") == i, F.col("n"))) for i in (0, 1))
    hot = (lists.groupBy("tok").agg(nl.alias("nl"), nr.alias("nr")).filter(F.greatest("nl", "nr") > most)
           .filter("nl IS NOT NULL AND nr IS NOT NULL").orderBy("tok").toArrow())
    keys = hot.column("tok").to_numpy().view(np.uint64)
    long = np.stack([hot.column(c).to_numpy() for c in ("nl", "nr")], axis=1).astype(np.int64)
    blocks = -(-long // most)
    copies = 1 + float((long * (blocks[:, ::-1] - 1)).sum()) / max(1, total)
    order = np.argsort(keys)
    groups = _groups(index)
    held = min(groups, key=lambda side: sum(sets * (width + meet.ROW_BYTES) + keys * meet.ENTRY_BYTES for width, sets, keys in groups[side]))
    least = max(LEAST_BUCKETS, -(-int(total * copies) // BUCKET_ENTRIES))
    return keys[order], blocks[order], meet.buckets_for(groups[held], copies, BUCKET_BYTES, least), held


def _groups(index: DataFrame) -> dict[int, list[tuple[int, int, int]]]:
    """(bytes of a sketch, sets, their keys) of sets alike in size, by side."""
    many = F.size("keys")
    rows = (index.groupBy("side", F.length("sketch").alias("width"), F.floor(F.log2(F.greatest(many, F.lit(1))) * 4).alias("step"))
            .agg(F.count(F.lit(1)).alias("sets"), F.sum(many).alias("keys")).collect())
    return {side: [(r.width, r.sets, r["keys"]) for r in rows if r.side == side] for side in (0, 1)}


def jaccard_candidates(prefix: DataFrame, p: int, q: int) -> DataFrame:
    """(ka, kb): names of the sets that may be more alike than ``p / q``, from
    their index entries dealt to buckets (``meet.PACKED``)."""
    return (prefix.repartition("bucket").sortWithinPartitions("bucket", "side")
            .mapInArrow(meet.meeting(p, q), "ka long, kb long").distinct())


def _rounds(index: DataFrame, lists: DataFrame, ranked: bool, p: int, q: int, cut_lineage: bool, name: str) -> DataFrame:
    """The candidates of all buckets of ``index`` (``meet.INDEX``), met in rounds. The names
    that a round finds are written with those found before, and its shuffles are
    released before the next one starts."""
    hot, blocks, buckets, held = _dealt(lists, index)
    rounds = max(1, min(MOST_ROUNDS, -(-buckets // ROUND_BUCKETS))) if cut_lineage else 1
    found = None
    for i in range(rounds):
        part_of = (buckets * i // rounds, buckets * (i + 1) // rounds)
        cand = jaccard_candidates(index.mapInArrow(meet.pack_keys(hot, blocks, buckets, held, ranked, part_of), meet.PACKED), p, q)
        if cut_lineage:
            cand = _staged(cand, name, "parquet")
        if found is not None:
            both = _staged(found.unionByName(cand).distinct(), name, "parquet")
            for old in (found, cand):
                delete_path(old.sparkSession, os.path.dirname(old.inputFiles()[0]))
            cand = both
        found = cand
    return found


def _staged(df: DataFrame, name: str, how: str) -> DataFrame:
    """:func:`materialize`; the shuffles behind the table are released."""
    out = materialize(df, name, how)
    release_shuffles(out.sparkSession)
    return out


def _cells(cand: DataFrame) -> DataFrame:
    """(ka, kb, fam, bl, br): the candidates dealt to cells. A left set goes with its
    smallest partner (``fam``), so near copies of one text mostly share a cell; more
    than ``CELL_ROWS`` sets on a side are cut into blocks."""
    own = cand.groupBy("ka").agg(F.min("kb").alias("fam"), F.count(F.lit(1)).alias("met"))
    size = own.groupBy("fam").agg(F.count(F.lit(1)).alias("nl"), F.max("met").alias("nr"))
    own = own.join(size, "fam").select("ka", "fam", *[F.ceil(F.col(c) / CELL_ROWS).alias(k) for c, k in (("nl", "kl"), ("nr", "kr"))])
    return cand.join(own, "ka").select("ka", "kb", "fam", *[F.pmod(F.xxhash64(c, "fam"), F.col(k)).cast("int").alias(b)
                                                            for c, k, b in (("ka", "kl", "bl"), ("kb", "kr", "br"))])


def cell_rows(cand: DataFrame, both: DataFrame) -> DataFrame:
    """The rows that verification reads: each set once for every cell in which it has
    candidates, a right set with the names of its candidates there (``mates``)."""
    met = _cells(cand)
    cell = ["fam", "bl", "br"]
    left = met.select(*cell, F.col("ka").alias("name")).distinct().withColumn("mates", F.lit(None).cast("array<bigint>"))
    right = met.groupBy(*cell, F.col("kb").alias("name")).agg(F.collect_list("ka").alias("mates"))
    rows = [x.join(both.filter(F.col("side") == i), "name").select(*cell, "side", "name", "rep", "cnt", "n", "toks", "mates")
            for i, x in enumerate((left, right))]
    return rows[0].unionByName(rows[1])


def _verified(cand: DataFrame, both: DataFrame) -> DataFrame:
    """The candidates with their representatives, counts, and exact overlap. Tokens
    are shuffled once for a set and cell, not for each pair."""
    rep = both.schema["rep"].dataType.simpleString()
    return (cell_rows(cand, both).repartition("fam", "bl", "br").sortWithinPartitions("fam", "bl", "br", "side")
            .mapInArrow(meet.overlaps, f"_ra {rep}, _rb {rep}, n_left long, n_right long, inter long, uni long"))


def jaccard_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str,
                 max_distance: float, text_col: str | None = "text",
                 tokens_col: str | None = None, pattern: str = TOKEN_PATTERN,
                 out_left: str = "v2_id", out_right: str = "lg_id",
                 cut_lineage: bool = True, digest_col: str | None = None,
                 token_sets: DataFrame | None = None, release: Callable[[], None] | None = None) -> DataFrame:
    """Exact Jaccard similarity join, ``distance < max_distance``.

    Columns: ``out_left``, ``out_right`` (representative ids of distinct token
    sets), ``n_left``, ``n_right`` (rows sharing that set), ``inter``,
    ``uni``, ``jaccard_dist``. Distances are computed in double as
    ``1 - inter / union``.

    Filters, all exact (no true pair is lost), for similarity above ``s``:

    * prefix, tokens rarest first: of a pair, the longer set needs its first
      ``n - floor(s n)`` tokens, the shorter only ``n - floor(2 s n / (1 + s))``.
      The order is by frequency for the most frequent tokens and by hash for all
      others, which come first; any one order of all tokens is exact;
    * length: ``s|A| <= |B| <= |A|/s``;
    * sketch: the overlap is at most half of ``|A| + |B|`` less the number of
      bits in which the sets' parity sketches differ; a sketch is at least 2.5
      times as wide as its set (up to 8192 bits). Sets that share common tokens
      but not enough of them fall out here, before a candidate is written.

    An index list of any length is joined block by block (:mod:`.meet`).

    The threshold is read as a decimal fraction, so all bounds are integer
    arithmetic. The distinct token sets, the lengths of the index lists and the
    candidates are written as tables in the shared checkpoint folder
    (``cut_lineage``) because several later stages read each of them.

    ``digest_col`` and ``token_sets``: see :func:`_sets`; the sides then need no
    tokens (``toks`` of ``token_sets`` is made by :func:`pack_tokens`). ``release``
    is called once the token sets are written: from then on nothing reads the inputs.
    """
    s = 1 - Fraction(str(max_distance))  # candidates need similarity > s
    if not 0 <= s < 1:
        raise ValueError("max_distance must be in (0, 1]")
    p, q = s.numerator, s.denominator
    both = _sets(left, left_id, right, right_id, text_col, tokens_col, pattern, digest_col, token_sets)
    if cut_lineage:
        both = _staged(both, "jaccard_sets", "zstd")
        if release:
            release()

    # order on token hashes: a collision can only join two tokens, and the
    # candidates it adds are verified on the tokens themselves
    hashed = both.select("side", "name", "n", F.transform(_tokens(both), lambda t: F.xxhash64(t)).alias("hashes"))
    common, rank = _common_tokens(hashed)
    index = hashed.mapInArrow(meet.prefix_keys(common, rank, p, q), meet.INDEX)
    if cut_lineage:
        index = _staged(index, "jaccard_index", "parquet")
    lists = _lists(index)
    if cut_lineage:
        lists = _staged(lists, "jaccard_prefix", "parquet")
    cand = _rounds(index, lists, True, p, q, cut_lineage, "jaccard_met")
    out = (_verified(cand, both)
           .withColumn("jaccard_dist",
                       F.lit(1.0) - F.col("inter").cast("double") / F.col("uni").cast("double"))
           .filter(F.col("jaccard_dist") < F.lit(max_distance)))
    return out.select(F.col("_ra").alias(out_left), F.col("_rb").alias(out_right),
                      "n_left", "n_right", "inter", "uni", "jaccard_dist")


# ---------------------------------------------------------------- MinHash LSH

def minhash_constants(n: int) -> list[tuple[int, int]]:
    """(a, b) of the ``n`` hash functions ``(a x + b) mod (2**31 - 1)``: powers
    of two fixed generators."""
    return [(pow(48271, j + 1, _MINHASH_PRIME), pow(69621, j + 1, _MINHASH_PRIME)) for j in range(n)]


def _md5_bands(both: DataFrame, num_bands: int, rows_per_band: int) -> DataFrame:
    """(side, name, n, sketch, keys): MinHash of the first 28 bits of each token's
    md5, the least values of a band as one key."""
    return _token_numbers(both).mapInArrow(
        meet.minhash_keys(minhash_constants(num_bands * rows_per_band), _MINHASH_PRIME, rows_per_band), meet.INDEX)


def _token_numbers(both: DataFrame) -> DataFrame:
    number = F.transform(_tokens(both), lambda t: F.conv(F.substring(F.md5(t), 1, 7), 16, 10).cast("long"))
    return both.select("side", "name", "n", number.alias("hashes"))


def _mllib_bands(both: DataFrame, num_features: int, num_bands: int, rows_per_band: int, seed: int) -> DataFrame:
    """The same from MLlib: ``HashingTF`` (F5), then ``MinHashLSH`` (F6) fitted
    on the union of both sides (U1)."""
    from pyspark.ml.feature import HashingTF, MinHashLSH
    from pyspark.ml.functions import vector_to_array

    both = both.withColumn("toks", _tokens(both))
    tf = HashingTF(inputCol="toks", outputCol="tf", numFeatures=num_features).transform(both)
    model = MinHashLSH(inputCol="tf", outputCol="hashes", numHashTables=num_bands * rows_per_band,
                       seed=seed).fit(tf.select("tf"))
    hashed = model.transform(tf).withColumn(
        "h", F.transform("hashes", lambda v: vector_to_array(v)[0])).drop("hashes")
    keys = F.transform(F.sequence(F.lit(0), F.lit(num_bands - 1)),
                       lambda i: F.xxhash64(i, F.slice("h", i * rows_per_band + 1, rows_per_band)))
    hashed = hashed.withColumn("keys", keys)
    number = F.transform("toks", lambda t: F.xxhash64(t)).alias("hashes")
    return hashed.select("side", "name", "n", number, "keys").mapInArrow(meet.add_sketches, meet.INDEX)


def lsh_similarity_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str,
                        threshold: float = MAX_DISTANCE, num_bands: int = LSH_BANDS, rows_per_band: int = LSH_ROWS,
                        hashing: str = "md5", num_features: int = TF_NUM_FEATURES,
                        seed: int = 1, text_col: str | None = "text",
                        tokens_col: str | None = None, pattern: str = TOKEN_PATTERN,
                        out_left: str = "v2_id", out_right: str = "lg_id",
                        cut_lineage: bool = True, digest_col: str | None = None,
                        token_sets: DataFrame | None = None) -> DataFrame:
    """J3 + F5 + F6: MinHash-LSH similarity join, distance ``< threshold``.

    ``hashing="md5"``: signatures by integer arithmetic on md5 values, the
    same in any engine. ``hashing="mllib"``: ``HashingTF(num_features)`` and
    ``MinHashLSH`` with ``seed``; with ``rows_per_band=1`` that is MLlib's
    ``approxSimilarityJoin`` candidate rule (any one table collides). More
    rows per band AND the hashes of a band together, which cuts candidates of
    low similarity. Candidates are the pairs that share a band and its
    hash, met bucket by bucket (:mod:`.meet`), and are verified with the exact Jaccard
    distance of the token sets. A pair counts once whatever bands it shares (A6);
    pairs whose sizes or parity sketches rule out the distance are not written.

    A pair of similarity s is found with probability
    ``1 - (1 - s ** rows_per_band) ** num_bands``: with the defaults 0.93 at 0.5,
    0.99 at 0.6, 0.9998 at 0.7.

    As in :func:`jaccard_join`, identical token sets are collapsed first
    (columns ``n_left`` / ``n_right`` count the rows behind each
    representative id), so copies never meet in a bucket pairwise. Rows
    with no token are skipped (an empty set has no minimum). ``digest_col`` and
    ``token_sets`` as there.
    """
    s = max(Fraction(0), 1 - Fraction(str(threshold)) - Fraction(1, 10 ** 9))  # distances are compared in doubles
    p, q = s.numerator, s.denominator
    both = _sets(left, left_id, right, right_id, text_col, tokens_col, pattern, digest_col, token_sets)
    if cut_lineage:  # read three times: hashing, and both sides of the verification
        both = _staged(both, "lsh_sets", "zstd")
    bands = (_md5_bands(both, num_bands, rows_per_band) if hashing == "md5"
             else _mllib_bands(both, num_features, num_bands, rows_per_band, seed))
    if cut_lineage:
        bands = _staged(bands, "lsh_bands", "parquet")
    cand = _rounds(bands, _lists(bands), False, p, q, cut_lineage, "lsh_met")
    return (_verified(cand, both)
            .select(F.col("_ra").alias(out_left), F.col("_rb").alias(out_right), "n_left", "n_right",
                    (F.lit(1.0) - F.col("inter").cast("double") / F.col("uni")).alias("jaccard_dist"))
            .filter(F.col("jaccard_dist") < F.lit(threshold)))


# ---------------------------------------------------------------- enrichment

def fee_diff(pairs: DataFrame, left: DataFrame, right: DataFrame, left_id: str,
             right_id: str, fee_col: str, pair_left: str = "v2_id",
             pair_right: str = "lg_id", out: str = "fee_diff") -> DataFrame:
    """J5 + F7: bring both sides' fee to each pair, ``abs(a - b)``."""
    fl = left.select(F.col(left_id).alias(pair_left), F.col(fee_col).alias("_fee_l"))
    fr = right.select(F.col(right_id).alias(pair_right), F.col(fee_col).alias("_fee_r"))
    return (pairs.join(fl, pair_left).join(fr, pair_right)
            .withColumn(out, F.abs(F.col("_fee_l") - F.col("_fee_r")))
            .drop("_fee_l", "_fee_r"))


def distance_summary(pairs: DataFrame, col: str = "jaccard_dist", digits: int = 6) -> DataFrame:
    """A2: count / mean / sample stddev / min / max in one aggregate pass, over all
    pairs of rows: a pair of sets counts ``n_left * n_right`` times, where ``pairs``
    has these columns."""
    d = F.col(col).cast("double")
    times = F.col("n_left") * F.col("n_right") if {"n_left", "n_right"} <= set(pairs.columns) else F.lit(1).cast("long")
    times = F.when(d.isNotNull(), times)
    n, x, xx = F.sum(times), F.sum(times * d), F.sum(times * d * d)
    return pairs.agg(
        F.coalesce(n, F.lit(0).cast("long")).alias("n"),
        F.round(x / n, digits).alias("mean"),
        F.when(n > 1, F.round(F.sqrt(F.greatest(F.lit(0.0), xx - x * x / n) / (n - 1)), digits)).alias("stddev"),
        F.min(col).alias("min"),
        F.max(col).alias("max"))


def match_preview(pairs: DataFrame, n: int = 10, order: list[str] | None = None) -> DataFrame:
    """O2: the first ``n`` pairs in a total order (closest first)."""
    order = order or ["jaccard_dist", "v2_id", "lg_id"]
    return pairs.orderBy(*order).limit(n)


# ---------------------------------------------------------------- the whole job

KEY_FIELDS = ["fund_name", "management_company", "nickname"]


def resolve_masters(current: DataFrame, legacy: DataFrame, id_col: str = "fund_id",
                    key_fields: list[str] | None = None, fee_col: str | None = "trust_fee_rate",
                    max_distance: float = MAX_DISTANCE,
                    snapshot_col: str | None = "ingest_date", load_seq: str = "load_seq") -> dict[str, DataFrame]:
    """Exact then similarity matching of two masters, end to end.

    1. latest snapshot per id when the inputs carry ``snapshot_col`` (a
       master holds one row per load date; matching on the id alone would
       fan out over snapshots), the highest ``load_seq`` of a date;
    2. column canonicalisation (P3), composite key (F1, F2), text (F3);
    3. exact pairs (J1), both remainders (J2), exact Jaccard on the
       remainders (J4), fee difference (J5), and the member tables behind
       both kinds of pairs.

    Returns the named intermediate and final frames; nothing is computed
    until one of them is used.
    """
    from ..functions.columns import canonicalize_columns
    from ..functions.text import det_key, text_features
    from .dims import latest_snapshot

    fields = key_fields or KEY_FIELDS

    def prep(df):
        df = canonicalize_columns(df)
        if snapshot_col and snapshot_col in df.columns:
            df = latest_snapshot(df, [id_col], snapshot_col, [load_seq])
        df = det_key(df, fields)
        return text_features(df, [f"{f}_norm" for f in fields])

    cur, leg = prep(current), prep(legacy)
    out = {"current": cur, "legacy": leg,
           "exact": exact_match_pairs(cur, leg, id_col, id_col, empty_col="det_key_empty"),
           "unmatched_current": unmatched(cur, leg, empty_col="det_key_empty"),
           "unmatched_legacy": unmatched(leg, cur, empty_col="det_key_empty")}
    out["exact_members"] = exact_match_members(cur, leg, id_col, id_col, empty_col="det_key_empty")
    out["set_members"] = set_members(out["unmatched_current"], out["unmatched_legacy"], id_col, id_col)
    out["similar"] = jaccard_join(out["unmatched_current"], out["unmatched_legacy"], id_col, id_col,
                                  max_distance, text_col="text")
    if fee_col:
        out["similar_with_fee"] = fee_diff(out["similar"], cur, leg, id_col, id_col, fee_col)
    return out
