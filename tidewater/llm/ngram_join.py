"""N-gram Jaccard join with set-relation skipping; exact, in links or classes.

A document's set is its distinct word shingles. Documents of one set are one
class from the start. The join finds every class pair of similarity >= 3/4
(as 4 * common >= 3 * all, in integers), in steps that each leave out only
what cannot link:

1. *Single shingles.* In a fixed part of the hash space every shingle is
   counted. A set can only link if at least what is left of that part after
   taking away a quarter of the set also stands in another set. Few sets pass.
2. *Answers by relation.* Sets that agree in a band of min-hashes are compared
   with one leader, the set that shares the most bands. A set near its leader
   is kept as the difference to it: two sets of one leader then have the
   distance (size of the symmetric difference) that their small differences
   have, so all pairs of one leader are settled from the differences, block by
   block, and only a spanning set of links is written.
3. *Index lists with skipping.* Of the sets that passed, the first quarter of
   the shingles (common ones ordered last) goes into index lists. A list that
   lies within one component or one leader's sets is skipped. The others are
   cut into blocks by
   set size; a pair of blocks is skipped where its sizes, positions or
   components rule out every pair in it, and inside a pair of blocks the
   position filter is applied to all pairs at once.
4. *Answers derived.* For a candidate pair the leaders are compared, once
   per pair of leaders. Distances are a metric, and the triangle inequality
   settles most candidates either way; only the undecided ones are compared
   themselves.

What is written out grows with the number of sets and of candidates between
different components, never with the pairs inside a group of near copies.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. Shingles and sets
are named by 64-bit hashes of their words.

Defined cases: a document of fewer than ``k`` words has its whole sequence as
one shingle; without words (or with null text) its set is empty and links
with nothing, itself being its component; repeated rows are one set; a text of
any length is read whole; an empty table gives an empty result. A null key
comes back as null and is never the key of a component that has another one; a
component of rows without key has none. Of equal keys or texts nothing is
chosen here (a tie changes no row); only key and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm import names, vec
from tidewater.llm.components import connected_components
from tidewater.session import materialize

U64 = np.uint64
COUNTED = U64(3 << 61)  # shingles below this hash are counted: 3/8 of them
COMMON = 100_000  # so many of the most frequent counted shingles are known as common
BLOCK = 512
BANDS, ROWS = 8, 3
FLUSH = 2_000_000
NO_KEY = -(1 << 63)  # stands for a null key between the steps
SKETCH = (256, 2048)  # bits of a sketch: the power of two above 5/4 of the set's size, within these


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offs = vec.buffer(column)
    data = vec.lower_ascii(data)
    start, end, doc = vec.word_spans(data, offs)
    n_docs = len(offs) - 1
    words = vec.span_hashes(data, start, end) if len(start) else np.zeros(0, dtype=U64)
    count = np.bincount(doc, minlength=n_docs)
    at = vec.lengths_to_offsets(count).tolist()
    full = vec.window_hashes(words, k)
    short = {n: vec.window_hashes(words, n, 100 + n) for n in set(count[(count > 0) & (count < k)].tolist())}
    out = []
    for i, n in enumerate(count.tolist()):
        a = at[i]
        if n >= k:
            x = np.sort(full[a:a + n - k + 1])
            out.append(x[np.append(True, x[1:] != x[:-1])])
        else:
            out.append(short[n][a:a + 1] if n else full[:0])
    return out


def _name(x: np.ndarray) -> int:
    """64-bit name of a set: the same for any order of its shingles."""
    total = vec.mix(x + U64(0x51ED270B)).sum(dtype=U64, keepdims=True) + vec.mix(np.array([len(x)], dtype=U64))
    return int(vec.mix(total).view(np.int64)[0])


def _most_apart(n: np.ndarray) -> np.ndarray:
    """How many shingles of a set of size n a linked set may lack."""
    return n - (3 * n + 3) // 4


def _sketch(x: np.ndarray) -> bytes:
    """Parity sketch of a set. The width is a power of two, so that a wide sketch
    folds to a narrow one by xor."""
    wide = min(max(1 << int(5 * len(x) // 4).bit_length(), SKETCH[0]), SKETCH[1])
    odd = np.bincount((x & U64(wide - 1)).astype(np.int64), minlength=wide) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(sketches: list[bytes], width: int) -> np.ndarray:
    """Sketches as rows of ``width`` bytes."""
    out = np.empty((len(sketches), width), dtype=np.uint8)
    for i, x in enumerate(sketches):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(x, dtype=np.uint8).reshape(-1, width), axis=0)
    return out.view(np.uint64)


def _sketch_bound(a: list[bytes], b: list[bytes], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """In how many shingles the sets a[i] and b[j] differ at least."""
    width = min(map(len, a + b))
    x, y = _folded(a, width), _folded(b, width)
    out = np.empty(len(i), dtype=np.int64)
    for at in range(0, len(i), 1 << 15):
        part = slice(at, at + (1 << 15))
        out[part] = np.bitwise_count(x[i[part]] ^ y[j[part]]).sum(axis=1, dtype=np.int64)
    return out


# Packets of step 1. kind 0: for sets (a: set names, b: counts); 1: shingles
# that a task saw in one set (a: shingles, b: set names, c: shingles per set
# name); 2: shingles it saw in several (a: shingles, b: in how many); 3:
# shingles with their number of sets (a, b).
_PACKET = pa.schema([("to", pa.int32()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
_PACKET_SQL = "to int, kind int, a binary, b binary, c binary"


def _packets(kind: int, to: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((b, to)) if kind == 1 else np.argsort(to, kind="stable")
    to, a, b = to[order], a[order], b[order]
    cuts = [0, *(np.flatnonzero(to[1:] != to[:-1]) + 1).tolist(), len(to)] if len(to) else [0]
    rows: list[list] = [[] for _ in _PACKET]
    for i, j in zip(cuts, cuts[1:]):
        x, c = b[i:j], b""
        if kind == 1:
            head = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
            c = np.diff(np.append(head, len(x))).astype("<u4").tobytes()
            x = x[head]
        for column, value in zip(rows, (int(to[i]), kind, a[i:j].tobytes(), x.tobytes(), c)):
            column.append(value)
    if rows[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(rows, _PACKET)], schema=_PACKET)


def _read(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    part = table.filter(pa.array(table.column("kind").to_numpy() == kind))
    get = lambda c, d: np.frombuffer(b"".join(part.column(c).to_pylist()), dtype=d)
    if kind == 1:
        return get("a", "<u8"), np.repeat(get("b", "<i8"), get("c", "<u4"))
    return get("a", "<i8" if kind == 0 else "<u8"), get("b", "<u4")


def _sum_by(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(key, return_inverse=True)
    return keys, np.bincount(where, weights=value, minlength=len(keys)).astype(np.int64)


def _by_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of one ``to`` each, from rows sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        to = batch.column("to").to_numpy()
        cuts = [0, *(np.flatnonzero(to[1:] != to[:-1]) + 1).tolist(), len(to)] if len(to) else [0]
        for a, b in zip(cuts, cuts[1:]):
            if held and held[-1].column("to")[0].as_py() != int(to[a]):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _split(x: np.ndarray, own: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """What a task tells of its (shingle, set) pairs, each shingle once."""
    order = np.lexsort((own, x))
    x, own = x[order], own[order]
    keep = np.append(True, (x[1:] != x[:-1]) | (own[1:] != own[:-1])) if len(x) else np.zeros(0, dtype=bool)
    x, own = x[keep], own[keep]
    head = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, dtype=np.int64)
    many = np.diff(np.append(head, len(x)))
    alone = head[many == 1]
    several = head[many > 1]
    place = lambda v: ((vec.mix(v) >> U64(33)) % U64(parts)).astype(np.int32)
    yield from _packets(1, place(x[alone]), x[alone], own[alone])
    yield from _packets(2, place(x[several]), x[several], many[many > 1].astype("<u4"))
    live = own[np.repeat(many, many) > 1]
    sets, n = np.unique(live, return_counts=True)
    yield from _packets(0, (sets % parts).astype(np.int32), sets, n.astype("<u4"))


def _passed(docs: DataFrame, k: int) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """Step 1: (sets of documents, sets that may link, common shingles)."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in vec.chunks(batches, "text"):
            sets = shingle_sets(part.column("text"), k)
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("row"), pa.array([_name(x) for x in sets], type=pa.int64()),
                 pa.array([len(x) for x in sets], type=pa.int64()),
                 pa.array([int(np.searchsorted(x, COUNTED)) for x in sets], type=pa.int64())],
                names=["key", "row", "own", "n", "counted"])

    sets = materialize(docs.select("key", "row", "text").mapInArrow(
        vec.trimmed(measure), "key long, row long, own long, n long, counted long"), "sets", "parquet")

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs, owns, held = [], [], 0
        for part in vec.chunks(batches, "text"):
            for x in shingle_sets(part.column("text"), k):
                if len(x):
                    y = x[:np.searchsorted(x, COUNTED)]
                    xs.append(y)
                    owns.append(np.full(len(y), _name(x), dtype=np.int64))
                    held += len(y)
            if held >= FLUSH:
                yield from _split(np.concatenate(xs), np.concatenate(owns), parts)
                xs, owns, held = [], [], 0
        if xs:
            yield from _split(np.concatenate(xs), np.concatenate(owns), parts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_place(batches):
            own, n = _read(table, 0)  # already for sets: pass
            yield from _packets(0, (own % parts).astype(np.int32), own, n)
            x, own = _read(table, 1)
            order = np.lexsort((own, x))
            x, own = x[order], own[order]
            if len(x):
                keep = np.append(True, (x[1:] != x[:-1]) | (own[1:] != own[:-1]))
                x, own = x[keep], own[keep]
            several, in_sets = _read(table, 2)
            names, df = _sum_by(np.concatenate((x, several)), np.concatenate((np.ones(len(x)), in_sets)))
            live = np.isin(x, names[df > 1])
            who, n = np.unique(own[live], return_counts=True)
            yield from _packets(0, (who % parts).astype(np.int32), who, n.astype("<u4"))
            often = df >= 16
            yield from _packets(3, np.zeros(int(often.sum()), dtype=np.int32), names[often], df[often].astype("<u4"))

    told = materialize(docs.select("text").mapInArrow(vec.trimmed(tell), _PACKET_SQL).repartition("to").sortWithinPartitions("to")
                       .mapInArrow(vec.trimmed(count), _PACKET_SQL), "shingles", "parquet")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_place(batches):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _sum_by(*_read(table, 0))], names=["own", "live"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, df = _read(pa.Table.from_batches([batch]), 3)
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(df.astype(np.int64))], names=["x", "df"])

    live = (told.filter("kind = 0").repartition("to").sortWithinPartitions("to").mapInArrow(vec.trimmed(total), "own long, live long"))
    often = told.filter("kind = 3").mapInArrow(vec.trimmed(spread), "x long, df long")
    steps = {r[0]: r[1] for r in often.groupBy(F.floor(F.log2("df")).alias("s")).count().collect()}  # a row per power of two
    least, known = 64, 0
    for s in sorted(steps, reverse=True):
        if known + steps[s] > COMMON:
            break
        least, known = s, known + steps[s]
    common = np.sort(np.array([r[0] for r in often.filter(F.floor(F.log2("df")) >= least).select("x").collect()],
                              dtype=np.int64).view(U64))  # COMMON numbers at most
    classes = sets.filter("n > 0").groupBy("own").agg(F.min(F.struct("key", "row")).alias("first"), F.max("n").alias("n"),
                                                     F.max("counted").alias("counted"))
    apart = F.col("n") - F.floor((3 * F.col("n") + 3) / 4)
    passed = (classes.join(live.withColumnRenamed("own", "o"), F.col("own") == F.col("o"), "left")
              .filter(F.coalesce("live", F.lit(0)) >= F.col("counted") - apart).select("own", "n", "first"))
    return sets, passed, common


def _compared(pairs: DataFrame, texts: DataFrame, k: int, differences: bool = False) -> DataFrame:
    """(a, b, na, nb, apart) of the pairs (a, b): sizes and exact distance;
    with ``differences`` also the shingles that stand in one of the two only,
    for sets near each other (else null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in vec.chunks(batches, "ta"):
            left, right = (shingle_sets(part.column(c), k) for c in ("ta", "tb"))
            apart, delta = [], []
            for x, y in zip(left, right):
                d = np.setxor1d(x, y, assume_unique=True)
                apart.append(len(d))
                delta.append(d.tobytes() if _near(len(d), len(x) + len(y)) else None)
            out = [part.column("a"), part.column("b"), pa.array([len(x) for x in left], type=pa.int64()),
                   pa.array([len(x) for x in right], type=pa.int64()), pa.array(apart, type=pa.int64())]
            yield pa.RecordBatch.from_arrays(out + [pa.array(delta, type=pa.binary())] * differences,
                                             names=["a", "b", "na", "nb", "apart"] + ["delta"] * differences)

    ta = texts.select(F.col("own").alias("oa"), F.col("text").alias("ta"))
    tb = texts.select(F.col("own").alias("ob"), F.col("text").alias("tb"))
    return (pairs.join(ta, F.col("a") == F.col("oa")).join(tb, F.col("b") == F.col("ob"))
            .select("a", "b", "ta", "tb").mapInArrow(
                vec.trimmed(run), "a long, b long, na long, nb long, apart long" + ", delta binary" * differences))


def _near(apart: int, sizes: int) -> bool:
    """Whether a set is kept as the difference to its leader (similarity 0.4 or more)."""
    return 7 * apart <= 3 * sizes


def _links(compared: DataFrame) -> DataFrame:
    """4 * common >= 3 * all, told from sizes and distance."""
    return compared.filter("7 * apart <= na + nb")


def _label(sets: DataFrame, comps: DataFrame) -> DataFrame:
    return sets.join(comps, F.col("own") == F.col("node"), "left").select(
        *sets.columns, F.coalesce("component", "own").alias("comp"))


def _by_leaders(texts: DataFrame, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Step 2: (links, component of each set, leader of each set near one with
    its distance)."""
    seeds = vec.constants(BANDS * ROWS, 57)

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in vec.chunks(batches, "text"):
            sets = shingle_sets(part.column("text"), k)
            size = np.array([len(x) for x in sets])
            full = np.flatnonzero(size)
            if not len(full):
                continue
            flat, at = np.concatenate(sets), vec.lengths_to_offsets(size)[:-1][full]
            keys = np.zeros((len(full), BANDS), dtype=U64)
            for j, s in enumerate(seeds):
                least = np.minimum.reduceat(vec.mix(flat ^ s), at)
                keys[:, j // ROWS] = vec.mix(keys[:, j // ROWS] + least)
            own = part.column("own").to_numpy()[full]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(own, BANDS)), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(full))),
                 pa.array(keys.reshape(-1).view(np.int64))], names=["own", "band", "key"])

    found = materialize(texts.select("own", "text").mapInArrow(vec.trimmed(bands), "own long, band int, key long"), "bands", "parquet")
    shared = found.groupBy("band", "key").agg(F.count("*").alias("c")).filter("c > 1")
    met = materialize(found.join(shared, ["band", "key"]), "met", "parquet")
    score = met.groupBy("own").agg(F.sum("c").alias("score")).withColumnRenamed("own", "o")
    scored = met.join(score, F.col("own") == F.col("o")).drop("o")
    leaders = scored.groupBy("band", "key").agg(F.max(F.struct("score", "own")).alias("lead"))
    star = materialize(met.join(leaders, ["band", "key"]).select("own", "lead").distinct(), "star", "parquet")
    best = star.groupBy("own").agg(F.max("lead").alias("lead")).filter("own != lead.own").select(
        F.col("own").alias("a"), F.col("lead.own").alias("b"))
    best = materialize(best, "leaders", "parquet")
    tops = _top_leaders(best)
    pairs = best.unionByName(tops).distinct()
    first = materialize(_compared(pairs, texts, k, True), "first", "parquet")
    sets = texts.select("own")
    comps = materialize(_label(sets, connected_components(_links(first))), "comps", "parquet")
    # a set near its top leader is kept as the difference to that one, else to its own leader
    t = tops.select(F.col("a").alias("ta"), F.col("b").alias("tb"))
    near = (first.filter("delta IS NOT NULL").join(t, F.col("a") == F.col("ta"))
            .groupBy("a").agg(F.max(F.struct((F.col("b") == F.col("tb")).alias("top"), "b", "na", "apart", "delta")).alias("v"))
            .select(F.col("a").alias("own"), F.col("v.b").alias("lead"), F.col("v.na").alias("n"), "v.apart", "v.delta"))
    near = materialize(near, "near", "parquet")
    links = _links(first).select("a", "b").unionByName(_within_leaders(near, comps))
    comps = materialize(_label(sets, connected_components(links)), "comps", "parquet")
    c1 = comps.select(F.col("own").alias("o1"), F.col("comp").alias("c1"))
    c2 = comps.select(F.col("own").alias("o2"), F.col("comp").alias("c2"))
    again = (star.join(c1, F.col("own") == F.col("o1")).join(c2, F.col("lead.own") == F.col("o2")).filter("c1 != c2")
             .groupBy("own", "c2").agg(F.max("lead").alias("lead"))
             .select(F.col("own").alias("a"), F.col("lead.own").alias("b"))
             .join(pairs.select(F.col("a").alias("fa"), F.col("b").alias("fb")),
                   (F.col("a") == F.col("fa")) & (F.col("b") == F.col("fb")), "left_anti"))
    second = materialize(_compared(again, texts, k), "second", "parquet")
    links = links.unionByName(_links(second).select("a", "b"))
    comps = materialize(_label(sets, connected_components(links)), "comps", "parquet")
    return links, comps, near.select("own", F.col("lead").alias("anchor"), "apart")


def _top_leaders(leaders: DataFrame) -> DataFrame:
    """(a, b): each set's leader's leader and so on, up to one without. Ranks
    only rise along the way, so pointers end; they are doubled each round."""
    up = leaders
    while True:
        above = up.select(F.col("a").alias("a2"), F.col("b").alias("b2"))
        jumped = materialize(up.join(above, F.col("b") == F.col("a2"), "left").select(
            "a", F.coalesce("b2", "b").alias("b"), F.col("b2").isNotNull().alias("moved")), "tops", "parquet")
        up = jumped.select("a", "b")
        if jumped.filter("moved").isEmpty():
            return up


def _within_leaders(near: DataFrame, comps: DataFrame) -> DataFrame:
    """A spanning set of the links (a, b) among sets kept as differences to
    the same leader, where they join components."""
    c = comps.select(F.col("own").alias("o"), "comp")
    rows = materialize(near.join(c, F.col("own") == F.col("o")).select("lead", "own", "n", "delta", "comp"), "near", "parquet")
    load = rows.groupBy("lead").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"),
                                    F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).filter("c0 < c1")
    dealt = (rows.join(load.select(F.col("lead").alias("l"), "blocks"), F.col("lead") == F.col("l"))
             .withColumn("mine", F.pmod(F.xxhash64("own"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("lead", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "mine", "own", "n",
                     "comp", "delta"))
    task = ["lead", "lo", "hi"]

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _by_columns(batches, task):
            own, n, comp, mine = (t.column(c).to_numpy() for c in ("own", "n", "comp", "mine"))
            if len(own) < 2 or comp.min() == comp.max():
                continue
            deltas = [np.frombuffer(x, dtype="<u8") for x in t.column("delta").to_pylist()]
            label = _settled(deltas, n, comp, mine == t.column("lo")[0].as_py(), mine == t.column("hi")[0].as_py())
            moved = np.flatnonzero(label != np.arange(len(own)))
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array(own[moved]), pa.array(own[label[moved]])], names=["a", "b"])

    return dealt.repartition(*task).sortWithinPartitions(*task).mapInArrow(vec.trimmed(resolve), "a long, b long")


def _settled(deltas: list[np.ndarray], n: np.ndarray, comp: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of sets given as differences to one leader, the least row that links
    between ``left`` and ``right`` rows of different components reach."""
    size = np.array([len(d) for d in deltas])
    row = np.repeat(np.arange(len(deltas)), size)
    flat = np.concatenate(deltas)
    _, col, count = np.unique(flat, return_inverse=True, return_counts=True)
    several = count[col] > 1
    row, col = row[several], np.unique(col[several], return_inverse=True)[1]
    a, b = np.flatnonzero(left), np.flatnonzero(right)
    both = np.zeros((len(a), len(b)), dtype=np.float32)
    for at in range(0, int(col.max()) + 1 if len(col) else 0, 4096):  # shared shingles, some columns at a time
        part = (col >= at) & (col < at + 4096)
        m = np.zeros((len(deltas), 4096), dtype=np.float32)
        m[row[part], col[part] - at] = 1
        both += m[a] @ m[b].T
    apart = size[a][:, None] + size[b][None, :] - 2 * both.astype(np.int64)
    i, j = np.nonzero((7 * apart <= n[a][:, None] + n[b][None, :]) & (comp[a][:, None] != comp[b][None, :]))
    i, j = a[i], b[j]
    label = np.arange(len(deltas))
    while True:
        was = label.copy()
        np.minimum.at(label, i, was[j])
        np.minimum.at(label, j, was[i])
        label = label[label]
        if np.array_equal(label, was):
            return label


def _by_columns(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """Tables of one value of ``columns`` each, from rows sorted by them."""
    rest = None
    for batch in batches:
        whole = pa.Table.from_batches([batch])
        whole = (pa.concat_tables([rest, whole]) if rest is not None else whole).combine_chunks()
        new = np.zeros(whole.num_rows, dtype=bool)
        for c in columns:
            v = whole.column(c).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(new).tolist()]
        for x, y in zip(cuts, cuts[1:]):
            yield whole.slice(x, y - x)
        rest = whole.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield rest


def _candidates(texts: DataFrame, comps: DataFrame, anchors: DataFrame, common: np.ndarray, k: int) -> DataFrame:
    """Step 3: distinct pairs (a, b) of different components and leaders that
    pass the size and position filters at a shingle of both index parts."""
    shared = texts.sparkSession.sparkContext.broadcast(common)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for part in vec.chunks(batches, "text"):
            sets = shingle_sets(part.column("text"), k)
            xs, pos, count, sketch = [], [], [], []
            for x in sets:
                place = np.where(x < COUNTED, 0, 1)
                if len(often):
                    at = np.minimum(np.searchsorted(often, x), len(often) - 1)
                    place = np.where(often[at] == x, 2, place)
                p = int(_most_apart(np.array([len(x)]))[0]) + 1 if len(x) else 0
                xs.append(x[np.argsort(place, kind="stable")[:p]])
                pos.append(np.arange(len(xs[-1]), dtype=np.int32))
                count.append(len(xs[-1]))
                sketch += [_sketch(x), *[None] * (count[-1] - 1)] if len(x) else []
            who = np.repeat(np.arange(len(sets)), count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(xs).view(np.int64)), pa.array(part.column("own").to_numpy()[who]),
                 pa.array(np.array([len(x) for x in sets], dtype=np.int32)[who]), pa.array(np.concatenate(pos)),
                 pa.array(part.column("comp").to_numpy()[who]), pa.array(part.column("anchor").to_numpy()[who]),
                 pa.array(sketch, type=pa.binary())],  # with a set's first entry only
                names=["x", "own", "n", "pos", "comp", "anchor", "sketch"])

    known = comps.join(anchors.select(F.col("own").alias("ao"), "anchor"), F.col("own") == F.col("ao"), "left").select(
        F.col("own").alias("o"), "comp", F.coalesce("anchor", "own").alias("anchor"))
    with_comp = texts.join(known, F.col("own") == F.col("o")).select("own", "text", "comp", "anchor")
    entries = materialize(with_comp.mapInArrow(
        vec.trimmed(enter), "x long, own long, n int, pos int, comp long, anchor long, sketch binary"), "index", "parquet")
    mixed = entries.groupBy("x").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("anchor").alias("a0"), F.max("anchor").alias("a1")
    ).filter("lo < hi AND a0 < a1").select(F.col("x").alias("mx"))
    listed = entries.drop("sketch").join(mixed, F.col("x") == F.col("mx")).withColumn(
        "cls", F.floor(F.log("n") / F.log(F.lit(4 / 3)) + F.lit(1e-9)).cast("int")).drop("mx")
    listed = materialize(listed, "lists", "parquet")
    load = listed.groupBy("x", "cls").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).select(
        F.col("x").alias("lx"), F.col("cls").alias("lc"), "blocks")
    entry = F.struct("own", "comp", "n", "pos", "anchor", "sketch")
    sketches = entries.filter("sketch IS NOT NULL").select(F.col("own").alias("so"), "sketch")
    blocks = (listed.join(sketches, F.col("own") == F.col("so")).join(load, (F.col("x") == F.col("lx")) & (F.col("cls") == F.col("lc")))
              .withColumn("no", F.pmod(F.xxhash64("own"), F.col("blocks")).cast("int"))
              .groupBy("x", "cls", "no").agg(
                  F.min("n").alias("n0"), F.max("n").alias("n1"), F.min("pos").alias("p0"),
                  F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.collect_list(entry).alias("e")))
    blocks = materialize(blocks, "blocks", "parquet")
    a = blocks.select("x", F.explode(F.array(F.col("cls"), F.col("cls") + 1)).alias("with"), "cls",
                      *[F.col(c).alias("a_" + c) for c in ("no", "n0", "n1", "p0", "c0", "c1", "e")])
    b = blocks.select(F.col("x").alias("bx"), F.col("cls").alias("bc"),
                      *[F.col(c).alias("b_" + c) for c in ("no", "n0", "n1", "p0", "c0", "c1", "e")])
    # what two sets of the blocks can have in common at most, against what they need at least
    most = F.least(F.col("a_n1") - F.col("a_p0"), F.col("b_n1") - F.col("b_p0"))
    pairs = (a.join(b, (F.col("x") == F.col("bx")) & (F.col("with") == F.col("bc")))
             .filter("cls < bc OR a_no <= b_no").filter("NOT (a_c0 = a_c1 AND b_c0 = b_c1 AND a_c0 = b_c0)")
             .filter((3 * F.col("b_n0") <= 4 * F.col("a_n1")) & (3 * F.col("a_n0") <= 4 * F.col("b_n1")))
             .filter(7 * most >= 3 * (F.col("a_n0") + F.col("b_n0"))).select("a_e", "b_e"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for c in ("a_e", "b_e"):
                lists = batch.column(c)
                flat = lists.flatten()
                sides.append((vec.lengths_to_offsets(lists.value_lengths().to_numpy()),
                              *[flat.field(f).to_numpy() for f in ("own", "comp", "n", "pos", "anchor")], flat.field("sketch")))
            for r in range(batch.num_rows):
                (ao, ac, an, ap, al, asks), (bo, bc, bn, bp, bl, bsks) = ([v[s[0][r]:s[0][r + 1]] for v in s[1:]] for s in sides)
                need = 3 * (an[:, None].astype(np.int64) + bn[None, :])
                ok = 7 * np.minimum((an - ap)[:, None], (bn - bp)[None, :]).astype(np.int64) >= need
                ok &= (ac[:, None] != bc[None, :]) & (al[:, None] != bl[None, :])
                i, j = np.nonzero(ok)
                if len(i):
                    may = 7 * _sketch_bound(asks.to_pylist(), bsks.to_pylist(), i, j) <= an[i].astype(np.int64) + bn[j]
                    i, j = i[may], j[may]
                if len(i):
                    u, v = ao[i], bo[j]
                    both = np.unique(np.stack((np.minimum(u, v), np.maximum(u, v))), axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])

    return pairs.mapInArrow(vec.trimmed(compare), "a long, b long").distinct()


def _derived(candidates: DataFrame, texts: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """Step 4: the candidates that link, as (a, b)."""
    sizes = texts.select(F.col("own").alias("o"), F.col("n").alias("n"))
    cand = candidates
    for s in ("a", "b"):
        near = anchors.select(F.col("own").alias(f"o{s}"), F.col("anchor").alias(f"l{s}"), F.col("apart").alias(f"d{s}"))
        cand = (cand.join(near, F.col(s) == F.col(f"o{s}"), "left").withColumn(f"l{s}", F.coalesce(f"l{s}", s))
                .withColumn(f"d{s}", F.coalesce(f"d{s}", F.lit(0))).drop(f"o{s}")
                .join(sizes.withColumnRenamed("n", f"n{s}"), F.col(s) == F.col("o")).drop("o"))
    cand = materialize(cand, "candidates", "parquet")
    known = materialize(_compared(cand.select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct(), texts, k),
                        "anchors", "parquet").select(F.col("a").alias("ka"), F.col("b").alias("kb"), F.col("apart").alias("d"))
    told = cand.join(known, (F.col("la") == F.col("ka")) & (F.col("lb") == F.col("kb")))
    most = F.expr("d + da + db")
    least = F.expr("greatest(d - da - db, da - d - db, db - d - da, abs(na - nb))")
    told = materialize(told.select("a", "b", F.when(7 * most <= F.col("na") + F.col("nb"), True)
                                   .when(7 * least > F.col("na") + F.col("nb"), False).alias("linked")), "told", "parquet")
    open_ = _links(_compared(told.filter("linked IS NULL").select("a", "b"), texts, k)).select("a", "b")
    return told.filter("linked").select("a", "b").unionByName(open_)


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, rows: bool = False) -> DataFrame:
    """(key, n_shingles, component_id) of every row: the size of its set and
    the least key that links reach from it. With ``rows``, two more columns
    that tell rows of one key (or of none) apart: row, a hash of the text, and
    component, a name of the component (null for an empty set)."""
    docs = df.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("key"), F.col(text).alias("text"),
                     F.xxhash64(F.col(text)).alias("row"))
    sets, passed, common = _passed(docs, k)
    wanted = passed.select("own", "n", F.col("first.key").alias("fk"), F.col("first.row").alias("fr"))
    texts = materialize(docs.join(wanted, (F.col("key") == F.col("fk")) & (F.col("row") == F.col("fr")))
                        .select("own", "n", "text"), "texts", "parquet")
    links, comps, anchors = _by_leaders(texts, k)
    more = _derived(_candidates(texts, comps, anchors, common, k), texts, anchors, k)
    final = connected_components(links.unionByName(more))
    known = F.nullif(F.col("key"), F.lit(NO_KEY))
    classes = sets.filter("n > 0").groupBy("own").agg(F.min(known).alias("least"))
    named = materialize(classes.join(final, F.col("own") == F.col("node")).select("own", "component", "least"), "named", "parquet")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = named.select(F.col("own").alias("no"), F.col("component").alias("nc")).join(
        least, F.col("nc") == F.col("component")).select("no", F.col("component_id").alias("cid"), "nc")
    by_set = classes.join(linked, F.col("own") == F.col("no"), "left").select(
        F.col("own").alias("so"), F.coalesce("cid", "least").alias("component_id"), F.coalesce("nc", "own").alias("component"))
    full = sets.filter("n > 0").join(by_set, F.col("own") == F.col("so")).select("key", "n", "component_id", "row", "component")
    empty = sets.filter("n = 0").select("key", "n", known.alias("component_id"), "row", F.lit(None).cast("long").alias("component"))
    return full.unionByName(empty).select(known.alias(key), F.col("n").alias("n_shingles"), "component_id",
                                          *(["row", "component"] if rows else []))


def keep_one(df: DataFrame, classes: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``df`` for each component: that of least key, then least
    hash of the text; of rows alike in key and text, one. Empty sets are
    components of their own; those without a key all stay, since nothing tells
    which of them are one document. ``classes`` are ``near_duplicates`` of ``df``
    with ``rows``; a key alone does not tell its rows apart, so classes
    without them are found anew."""
    if not {"row", "component"} <= set(classes.columns):
        classes = near_duplicates(df, key, text, rows=True)
    alike = classes.groupBy("component", F.coalesce(F.col(key), F.lit(NO_KEY)).alias("k"), F.col("row").alias("r")).agg(F.count("*").alias("copies"))
    heads = alike.filter("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("k", "r", "copies")).alias("head")).select("head.*")
    empty = alike.filter("component IS NULL").select(
        "k", "r", F.when(F.col("k") == NO_KEY, F.lit(1)).otherwise(F.col("copies")).alias("copies"))
    k, r, copies, one = names.free(df, "k", "r", "copies", "one")
    kept = materialize(heads.unionByName(empty).select(
        F.col("k").alias(k), F.col("r").alias(r), F.col("copies").alias(copies)), "kept", "parquet")

    def rows_of(some: DataFrame) -> DataFrame:
        return df.join(some, (F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)) == F.col(k))
                       & (F.xxhash64(F.col(text)) == F.col(r)))

    out = rows_of(kept.filter(F.col(copies) == 1)).select(*df.columns)
    several = kept.filter(F.col(copies) > 1)
    if several.isEmpty():
        return out
    whole = F.struct(*df.columns)
    chosen = rows_of(several).groupBy(k, r).agg(F.min_by(whole, F.xxhash64(F.to_json(whole))).alias(one))
    return out.unionByName(chosen.select(f"{one}.*"))
