"""Array helpers shared by the operators that run inside Arrow tasks.

A chunk of documents is one UTF-8 byte buffer plus offsets, as Arrow holds
it; words, hashes and shingles are computed over the whole chunk at once.
Hashes depend on the bytes alone, never on the chunk, the task or the run.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64), wrapping arithmetic."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit constants of a seed."""
    steps = (np.arange(1, n + 1, dtype=U64) + U64(seed << 32)) * U64(0x9E3779B97F4A7C15)
    return mix(steps) | U64(1)


_BASE = 0x2545F4914F6CDD1D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = constants(256, 11)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n, kept up to a few MB for the next chunk."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        have = np.full(n + 1, base, dtype=U64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 1 << 21:
            _POWERS[base] = have
    return have[:n + 1]


def release() -> None:
    """Give memory that a task has freed back to the system: a worker process
    outlives its tasks, and what it keeps is lacking elsewhere on its machine."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def trimmed(run):
    """``run`` over a task's batches; afterwards the worker's memory is released."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return task


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
           max_bytes: int = 1 << 20, max_rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``max_bytes`` of ``column``
    each (a longer text is a slice of its own, whole)."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(size, dtype=np.int64)
        at = 0
        while at < n:
            base = total[at - 1] if at else 0
            to = max(at + 1, min(at + max_rows, int(np.searchsorted(total, base + max_bytes, side="right"))))
            yield batch.slice(at, to - at)
            at = to


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string column; null counts as empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    if pa.types.is_large_string(column.type):
        offs = np.frombuffer(column.buffers()[1], dtype=np.int64)
    else:
        offs = np.frombuffer(column.buffers()[1], dtype=np.int32)
    offs = offs[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and their document."""
    if not len(data):
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    cut = offs[:-1][offs[:-1] < len(data)]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cut[cut > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(offs, starts, side="right") - 1
    return starts, ends, doc


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: a polynomial over the bytes, read off prefix sums."""
    n = len(data)
    prefix = np.empty(n + 1, dtype=U64)
    prefix[0] = 0
    np.cumsum(_BYTE[data] * _powers(_BASE, n)[:n], out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * _powers(_BASE_INVERSE, n)[starts]
    return mix(h + (ends - starts).astype(U64) * U64(0x9E3779B97F4A7C15))


def window_hashes(words: np.ndarray, k: int, seed: int = 23) -> np.ndarray:
    """Hash of the ``k`` values from each position on (positions with ``k`` left)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    acc = np.zeros(n, dtype=U64)
    for j, c in enumerate(constants(k, seed)):
        acc += words[j:j + n] * c
    return mix(acc)


def lengths_to_offsets(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... for each (start, length), concatenated."""
    offs = lengths_to_offsets(lengths)
    return np.repeat(starts - offs[:-1], lengths) + np.arange(offs[-1])
