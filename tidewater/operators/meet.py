"""Which pairs of sets meet in an index, told inside Arrow tasks.

A set is one row: its side, its name, its size, a parity sketch, and the keys
under which it stands in the index. The keys are dealt to buckets; a set sends
one row to a bucket, with all its keys there and one sketch, so a sketch is not
repeated for each key. A task holds one side of a bucket, as arrays; the rows of the
other side pass by batch by batch. There are so many buckets that the side that is
held has no more bytes than a given number, whatever the input (:func:`buckets_for`).
Pairs are told key by key as ranges of compatible sizes, and only pairs that neither
the places of the key in both sets nor the sketches rule out leave the task, each once.

Keys in a bucket are kept to 32 bits, and names are 64-bit hashes: two that
coincide can only add a pair, and pairs are verified on the tokens
(:func:`overlaps`).
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bits of a sketch: the power of two from 2.5 times the set's size, within these.
SKETCH_BITS = (512, 8192)
#: Bytes of sketches compared in one go, pairs and entries looked at in one go, and pairs held before they are made distinct.
COMPARED, LOOKED, HELD = 1 << 20, 1 << 18, 1 << 20
ROWS = 512
#: Bytes that a task holds for a row besides its sketch, and for an entry.
ROW_BYTES, ENTRY_BYTES = 32, 24
#: Index rows: a set, its sketch, and the keys under which it stands.
INDEX = "side int, name long, n int, sketch binary, keys array<long>"
#: Rows of a bucket; 2 is added to the side that is not held, so it comes last.
PACKED = "bucket int, side int, name long, n int, sketch binary, keys binary, places binary"

# Ship this module's code by value, so executors need no copy of the package.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError):  # pragma: no cover
    pass


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64), wrapping arithmetic."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of a column of lists."""
    offs = column.offsets.to_numpy()
    flat = column.values.slice(int(offs[0]), int(offs[-1] - offs[0]))
    return flat.to_numpy(zero_copy_only=False), np.diff(offs).astype(np.int64)


def _starts(size: np.ndarray) -> np.ndarray:
    return np.cumsum(size) - size


def _binary(data: np.ndarray, size: np.ndarray) -> pa.Array:
    """``data`` cut into binaries of ``size`` bytes."""
    offs = np.zeros(len(size) + 1, dtype=np.int32)
    np.cumsum(size, out=offs[1:])
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())])


def _level(n: np.ndarray) -> np.ndarray:
    """log2 of the bits of the sketch of a set of size ``n``."""
    least, most = (b.bit_length() - 1 for b in SKETCH_BITS)
    return np.clip(np.ceil(np.log2(np.maximum(n, 1) * 2.5)), least, most).astype(np.int64)


def sketches(flat: np.ndarray, size: np.ndarray, n: np.ndarray) -> pa.Array:
    """Parity sketch of each set: bit b tells whether an odd number of tokens
    falls on b. The bits in which two sketches differ are at most as many as the
    tokens that only one of the sets has. The width is a power of two, so that a
    wide sketch folds to a narrow one by xor."""
    bits = np.int64(1) << _level(n)
    at = _starts(bits)
    where = (mix(flat) & np.repeat(bits - 1, size).astype(U64)).astype(np.int64) + np.repeat(at, size)
    odd = (np.bincount(where, minlength=int(bits.sum())) & 1).astype(np.uint8)
    return _binary(np.packbits(odd, bitorder="little"), bits // 8)


def ranked_prefix(flat: np.ndarray, size: np.ndarray, n: np.ndarray, common: np.ndarray, rank: np.ndarray,
                  p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """(token, row) of the prefixes for similarity above ``p / q``, each in order: tokens
    that are not ``common`` come first, then the common ones by ``rank``. The order
    is the same for all sets, which is all that the prefix bound needs."""
    row = np.repeat(np.arange(len(size)), size)
    if len(common):
        at = np.minimum(np.searchsorted(common, flat), len(common) - 1)
        place = np.where(common[at] == flat, rank[at] + 1, 0)
    else:
        place = np.zeros(len(flat), dtype=np.int64)
    order = np.lexsort((flat, (row << 32) | place))
    tok, row = flat[order], row[order]
    fresh = np.append(True, (tok[1:] != tok[:-1]) | (row[1:] != row[:-1])) if len(tok) else np.zeros(0, dtype=bool)
    tok, row = tok[fresh], row[fresh]
    many = np.bincount(row, minlength=len(size))
    pos = np.arange(len(tok)) - np.repeat(_starts(many), many) + 1
    keep = pos <= (n - n * p // q)[row]
    return tok[keep], row[keep]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def prefix_keys(common: np.ndarray, rank: np.ndarray, p: int, q: int) -> Callable:
    """``INDEX`` rows whose keys are the prefixes in order, from rows (side, name, n, hashes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            flat, size = _lists(part.column("hashes"))
            flat, n = flat.view(U64), part.column("n").to_numpy().astype(np.int64)
            tok, row = ranked_prefix(flat, size, n, common, rank, p, q)
            offs = np.append(0, np.cumsum(np.bincount(row, minlength=len(size)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("side", "name", "n")), sketches(flat, size, n),
                 pa.ListArray.from_arrays(pa.array(offs), pa.array(tok.view(np.int64)))],
                names=["side", "name", "n", "sketch", "keys"])

    return run


def _split(key: np.ndarray, row: np.ndarray, place: np.ndarray, side: np.ndarray, name: np.ndarray,
           hot: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries under a hot key are dealt to blocks by their names; an entry stands
    once for each block of the other side, so that each pair of blocks is a key of
    its own and every pair of entries meets under exactly one. ``blocks``: the
    numbers of blocks of both sides."""
    if not len(hot):
        return key, row, place
    at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
    is_hot = hot[at] == key
    copies = np.where(is_hot, blocks[at, 1 - side[row]], 1)
    src = np.repeat(np.arange(len(key)), copies)
    other = (np.arange(len(src)) - np.repeat(_starts(copies), copies)).astype(U64)
    k, r = key[src], row[src]
    own = mix(name[r] ^ U64(0x5851F42D4C957F2D)) % blocks[at[src], side[r]].astype(U64)
    left, right = np.where(side[r] == 0, own, other), np.where(side[r] == 0, other, own)
    return np.where(is_hot[src], mix(k ^ mix((left << U64(32)) | right)), k), r, place[src]


def _packed(part: pa.RecordBatch, sketch: pa.Array, key: np.ndarray, row: np.ndarray, place: np.ndarray,
            hot: np.ndarray, blocks: np.ndarray, buckets: int, held: int, part_of: tuple[int, int]) -> pa.RecordBatch:
    """``PACKED`` rows of the entries in buckets ``part_of[0]`` up to ``part_of[1]``, exclusive."""
    side, name = part.column("side").to_numpy().astype(np.int64), part.column("name").to_numpy().view(U64)
    key, row, place = _split(key, row, place, side, name, hot, blocks)
    key = mix(key + U64(1))
    bucket = ((key & U64(0xFFFFFFFF)) % U64(buckets)).astype(np.int64)
    if part_of != (0, buckets):
        mine = (bucket >= part_of[0]) & (bucket < part_of[1])
        key, row, place, bucket = key[mine], row[mine], place[mine], bucket[mine]
    order = np.argsort(bucket * len(side) + row, kind="stable")
    key, row, place, bucket = key[order], row[order], place[order], bucket[order]
    head = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (bucket[1:] != bucket[:-1]))) if len(key) else np.zeros(0, dtype=np.int64)
    many = np.diff(np.append(head, len(key)))
    who = row[head]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[head].astype(np.int32)), pa.array((side + 2 * (side != held))[who].astype(np.int32)), pa.array(name[who].view(np.int64)),
         pa.array(part.column("n").to_numpy()[who].astype(np.int32)), sketch.take(pa.array(who)),
         _binary((key >> U64(32)).astype("<u4"), many * 4), _binary(place.astype("<u4"), many * 4)],
        names=["bucket", "side", "name", "n", "sketch", "keys", "places"])


def pack_keys(hot: np.ndarray, blocks: np.ndarray, buckets: int, held: int, ranked: bool, part_of: tuple[int, int]) -> Callable:
    """``PACKED`` rows in the buckets of ``part_of``, from ``INDEX`` rows; the side ``held`` is
    the one that tasks hold. A key's place is its position in its set where keys are
    ``ranked``, from 1, else 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            flat, size = _lists(part.column("keys"))
            row = np.repeat(np.arange(len(size)), size)
            place = np.arange(len(row)) - np.repeat(_starts(size), size) + 1 if ranked else np.ones(len(row), dtype=np.int64)
            yield _packed(part, part.column("sketch"), flat.view(U64), row, place, hot, blocks, buckets, held, part_of)

    return run


def buckets_for(groups: list[tuple[int, int, int]], copies: float, most: int, least: int) -> int:
    """The number of buckets, ``least`` at least, with which the held side of a bucket takes
    about ``most`` bytes. ``groups`` of that side: (bytes of a sketch, sets, their keys); each
    key stands ``copies`` times. A set is in a bucket if any of its keys is."""
    def bytes_of(buckets: int) -> float:
        return sum(sets * (width + ROW_BYTES) * -np.expm1(copies * keys / sets * np.log1p(-1 / buckets))
                   + copies * keys * ENTRY_BYTES / buckets for width, sets, keys in groups if keys)

    low, high = least, max(2, least)
    while bytes_of(high) > most and high < 1 << 30:
        low, high = high, high * 2
    while low < high:
        mid = (low + high) // 2
        low, high = (mid + 1, high) if mid > 1 and bytes_of(mid) > most else (low, mid)
    return high


def minhash_keys(constants: list[tuple[int, int]], prime: int, rows_per_band: int) -> Callable:
    """Rows (side, name, n, sketch, keys) from (side, name, n, hashes): a key for each
    band, of the least values of its hash functions ``(a x + b) mod prime``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            flat, size = _lists(part.column("hashes"))
            n = part.column("n").to_numpy().astype(np.int64)
            keys = np.zeros((len(size), len(constants) // rows_per_band), dtype=U64)
            for j, (a, b) in enumerate(constants):
                least = np.minimum.reduceat((flat * a + b) % prime, _starts(size)).astype(U64)
                band = j // rows_per_band
                keys[:, band] = mix(keys[:, band] * U64(0x2545F4914F6CDD1D) + least + U64(1 + band))
            offs = np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("side", "name", "n")), sketches(flat.view(U64), size, n),
                 pa.ListArray.from_arrays(pa.array(offs), pa.array(keys.ravel().view(np.int64)))],
                names=["side", "name", "n", "sketch", "keys"])

    return run


def add_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (side, name, n, sketch, keys) from (side, name, n, hashes, keys)."""
    for part in _slices(batches):
        flat, size = _lists(part.column("hashes"))
        sketch = sketches(flat.view(U64), size, part.column("n").to_numpy().astype(np.int64))
        yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("side", "name", "n")), sketch, part.column("keys")],
                                         names=["side", "name", "n", "sketch", "keys"])


def _bytes(column: pa.Array) -> np.ndarray:
    """The bytes of a column of binaries."""
    offs = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[offs[0]:offs[-1]] if offs[-1] else np.zeros(0, dtype=np.uint8)


def _folded(words: np.ndarray, by: int) -> np.ndarray:
    """Sketches of ``words``, 2 ** ``by`` times narrower."""
    return np.bitwise_xor.reduce(words.reshape(len(words), 1 << by, -1), axis=1) if by else words


class _Sets:
    """Sets of one side of a bucket, and their entries sorted by (key, size). Rows are
    added batch by batch and their bytes held once."""

    def __init__(self) -> None:
        self.parts: dict[str, list[np.ndarray]] = {x: [] for x in ("name", "n", "at", "key", "place", "many")}
        self.words: dict[int, list[np.ndarray] | np.ndarray] = {}
        self.rows: dict[int, int] = {}

    def add(self, batch: pa.RecordBatch) -> None:
        n = batch.column("n").to_numpy().astype(np.int64)
        level, at, sketch = _level(n), np.empty(len(n), dtype=np.int32), batch.column("sketch")
        for lv in np.unique(level).tolist():
            who = np.flatnonzero(level == lv)
            self.words.setdefault(lv, []).append(_bytes(sketch.take(pa.array(who))).view(U64).reshape(len(who), -1))
            at[who] = self.rows.get(lv, 0) + np.arange(len(who))
            self.rows[lv] = self.rows.get(lv, 0) + len(who)
        keys = batch.column("keys")
        many = np.diff(np.frombuffer(keys.buffers()[1], dtype=np.int32)[keys.offset:keys.offset + len(n) + 1]) // 4
        for x, got in (("name", batch.column("name").to_numpy()), ("n", n.astype(np.int32)), ("at", at), ("many", many),
                       ("key", _bytes(keys).view("<u4")), ("place", _bytes(batch.column("places")).view("<u4"))):
            self.parts[x].append(got.copy())

    def close(self) -> _Sets:
        """After the last row."""
        got = {x: np.concatenate(self.parts.pop(x)) for x in list(self.parts)}
        self.name, self.n, self.at = got["name"], got["n"], got["at"]
        for lv in self.words:
            self.words[lv] = np.concatenate(self.words[lv])
        own = np.repeat(np.arange(len(self.n), dtype=np.int32), got["many"])
        code = (got.pop("key").astype(np.int64) << 31) | self.n[own]
        order = np.argsort(code)
        self.code, self.own, self.place = code[order], own[order], got["place"][order]
        return self


def _sizes(level: int) -> tuple[int, int]:
    """The least and the largest size of a set whose sketch has 2 ** ``level`` bits."""
    least, most = (b.bit_length() - 1 for b in SKETCH_BITS)
    return 0 if level == least else (1 << level - 1) * 2 // 5 + 1, (1 << 31) - 1 if level == most else (1 << level) * 2 // 5


def _meet(some: _Sets, held: _Sets, p: int, q: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row of ``some``, row of ``held``) that share a key, sizes in proportion,
    ruled out neither by the places of the key nor by their sketches.

    Two sets overlap in at most ``n - place + 1`` tokens from their first common one
    on, so a pair above the threshold passes by its first common key at least."""
    most = (1 << 31) - 1
    for at in range(0, len(some.code), LOOKED):
        code, own = some.code[at:at + LOOKED], some.own[at:at + LOOKED]
        n, base = some.n[own].astype(np.int64), code & ~np.int64(most)
        top = np.clip(((n - some.place[at:at + LOOKED] + 1) * (p + q) - 1) // p - n, 0, most) if p else np.full(len(n), most)
        low = n * p // q + 1
        first = np.searchsorted(held.code, base | low, side="left")
        end = np.searchsorted(held.code, base | top, side="right")
        found = np.flatnonzero((end > first) & (top >= low))
        base, own, first, end = base[found], own[found], first[found], end[found]
        level = _level(n[found])
        for wide in held.words:
            least, largest = _sizes(wide)
            lo = np.maximum(first, np.searchsorted(held.code, base | least, side="left"))
            hi = np.minimum(end, np.searchsorted(held.code, base | largest, side="right"))
            for lv in np.unique(level[hi > lo]).tolist():
                which = np.flatnonzero((level == lv) & (hi > lo))
                yield from _alike(some, held, own[which], lo[which], (hi - lo)[which], p, q, lv, wide)


def _alike(some: _Sets, held: _Sets, own: np.ndarray, lo: np.ndarray, many: np.ndarray, p: int, q: int,
           lv: int, wide: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of the pairs of each set ``own`` with ``many`` entries of ``held`` from ``lo`` on, those
    not ruled out. Their sketches have 2 ** ``lv`` and 2 ** ``wide`` bits."""
    words = _folded(some.words[lv], max(0, lv - wide))
    ends = np.cumsum(many)
    step, first = (COMPARED >> wide) * 8, 0
    while first < len(own):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + LOOKED, side="right")))
        m = many[first:last]
        entry = np.arange(int(m.sum())) + np.repeat(lo[first:last] - _starts(m), m)
        a, b = np.repeat(own[first:last], m), held.own[entry]
        first = last
        size = held.n[b].astype(np.int64)
        total = some.n[a] + size
        near = held.place[entry] <= size - total * p // (p + q)
        a, b, total = a[near], b[near], total[near]
        for i in range(0, len(a), step):
            x, y = a[i:i + step], b[i:i + step]
            there = _folded(held.words[wide][held.at[y]], max(0, wide - lv))
            unlike = np.bitwise_count(words[some.at[x]] ^ there).sum(axis=1, dtype=np.int64)
            keep = unlike <= (total[i:i + step] * (q - p) - 1) // (q + p)  # differing tokens of a pair above the threshold
            if keep.any():
                yield x[keep], y[keep]


def meeting(p: int, q: int) -> Callable:
    """(ka, kb): names of the pairs that meet in a bucket and may be more alike than
    ``p / q``, from ``PACKED`` rows sorted by bucket and side."""
    def pairs(part: pa.RecordBatch, held: _Sets, side: int) -> Iterator[pa.RecordBatch]:
        some = _Sets()
        some.add(part)
        some.close()
        found, size = [np.zeros(0, dtype=np.int64)], 0
        for a, b in _meet(some, held, p, q):
            found.append(a.astype(np.int64) * len(held.n) + b)
            size += len(a)
            if size > HELD:
                found = [np.unique(np.concatenate(found))]
                size = len(found[0])
                if size > HELD // 2:
                    yield from told(some, held, side, found[0])
                    found, size = [found[0][:0]], 0
        yield from told(some, held, side, np.unique(np.concatenate(found)))

    def told(some: _Sets, held: _Sets, side: int, code: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(code), 1 << 16):
            x, y = np.divmod(code[at:at + (1 << 16)], len(held.n))
            names = [pa.array(some.name[x]), pa.array(held.name[y])]
            yield pa.RecordBatch.from_arrays(names if side == 0 else names[::-1], names=["ka", "kb"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, closed = None, None, False
        for batch in batches:
            to, side = batch.column("bucket").to_numpy(), batch.column("side").to_numpy()
            cuts = [0, *(np.flatnonzero((to[1:] != to[:-1]) | (side[1:] != side[:-1])) + 1).tolist(), len(to)] if len(to) else [0]
            for i, j in zip(cuts, cuts[1:]):
                if bucket != int(to[i]):
                    bucket, held, closed = int(to[i]), None, False
                if side[i] < 2:
                    held = held or _Sets()
                    held.add(batch.slice(i, j - i))
                elif held:
                    if not closed:
                        held.close()
                        closed = True
                    yield from pairs(batch.slice(i, j - i), held, int(side[i]) - 2)

    return run


def overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_ra, _rb, n_left, n_right, inter, uni) of the candidates, counted on the tokens.
    Rows are sorted by cell (fam, bl, br) and side: a cell's left sets are held, and
    each of its right sets brings the names of the left ones it is compared with
    (``mates``)."""
    cell, held = None, {}
    for part in (x for batch in batches for x in _slices([batch])):
        kind = part.schema.field("rep").type
        names = ("fam", "bl", "br", "side", "name", "rep", "cnt", "n", "toks", "mates")
        out: list[list] = [[] for _ in range(6)]
        for fam, bl, br, side, name, rep, cnt, n, toks, mates in zip(*(part.column(c).to_pylist() for c in names)):
            if (fam, bl, br) != cell:
                cell, held = (fam, bl, br), {}
            own = frozenset(map(sys.intern, toks.split(" ")) if isinstance(toks, str) else toks)
            if side == 0:
                held.setdefault(name, []).append((own, rep, cnt, n))
                continue
            for other, left_rep, left_cnt, left_n in (x for k in mates for x in held[k]):
                inter = len(own & other)
                for to, value in zip(out, (left_rep, rep, left_cnt, cnt, inter, left_n + n - inter)):
                    to.append(value)
        yield pa.RecordBatch.from_arrays([*(pa.array(x, kind) for x in out[:2]), *(pa.array(x, pa.int64()) for x in out[2:])],
                                         names=["_ra", "_rb", "n_left", "n_right", "inter", "uni"])
