"""BPE encoding and decoding with a byte-level vocabulary, by a pair occurrence index.

A task takes its documents in chunks, splits them into pieces and encodes
each different piece once. All pieces of a chunk lie in one linked symbol
array; an index maps every adjacent pair that has a merge rule to all its
positions. The active ranks are taken in ascending order: all occurrences of
the pair merge at once, and only the pairs beside them are looked up anew and
entered in the index. A piece's next merge is always its lowest rank, so the
sweep gives what merging piece by piece gives.

Defined cases: null text encodes as the empty text (no ids, decodes to "");
added tokens standing in a text (``<|endoftext|>``) become their own id, as
the tokenizers library does by default; rows are independent, so repeated
rows, ties and extra columns pass through; an empty table gives an empty
table. A text of any length is encoded whole.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewater.llm import vec

# The split pattern of the byte-level vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_NONE = np.int32(2**31 - 1)
#: Ranges whose positions are held at once.
GATHERED = 1 << 15
_TABLES: dict[bytes, "Tables"] = {}


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in vocabulary strings:
    itself if printable in Latin-1, else the next free one from U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    chars, extra = {b: chr(b) for b in shown}, 0x100
    for b in range(256):
        if b not in chars:
            chars[b] = chr(extra)
            extra += 1
    return [chars[b] for b in range(256)]


class Tables:
    """Lookup arrays of one tokenizer file (its JSON text)."""

    def __init__(self, text: bytes):
        spec = json.loads(text)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        alphabet = byte_alphabet()
        of_char = {c: b for b, c in enumerate(alphabet)}
        self.byte_id = np.array([vocab[c] for c in alphabet], dtype=np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.left, self.right = left.astype(np.int32), right.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*vocab.values(), *self.added.values()])
        self.width = size
        keys = left * size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.byte_rank = self.lookup(np.repeat(self.byte_id, 256), np.tile(self.byte_id, 256)).reshape(256, 256)
        raw = [b""] * size
        for s, i in vocab.items():
            raw[i] = bytes(of_char[c] for c in s)
        for s, i in self.added.items():
            raw[i] = s.encode()
        self.token_offs = vec.lengths_to_offsets(np.array([len(b) for b in raw]))
        self.token_bytes = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.split = regex.compile(SPLIT).findall
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, _NONE where no rule merges it."""
        if not len(self.keys):
            return np.full(len(a), _NONE, dtype=np.int32)
        key = a.astype(np.int64) * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.ranks[at], _NONE)


def tables(text: bytes) -> Tables:
    """The tables of a tokenizer file, built once per worker process."""
    if text not in _TABLES:
        _TABLES.clear()
        _TABLES[text] = Tables(text)
    return _TABLES[text]


class _Numbers(dict):
    """Numbers keys in the order they are first asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def encode_pieces(pieces: list[bytes], t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of the pieces, all encoded together."""
    lengths = np.array([len(p) for p in pieces], dtype=np.int64)
    data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    offs, n = vec.lengths_to_offsets(lengths), len(data)
    sym = np.full(n + 1, -1, dtype=np.int32)  # slot n: beyond either end of a piece
    sym[:n] = t.byte_id[data]
    nxt = np.arange(1, n + 2, dtype=np.int32)
    prv = np.arange(-1, n, dtype=np.int32)
    nxt[n] = n
    nxt[offs[1:] - 1] = n
    prv[offs[:-1]] = n
    prv[n] = n
    alive = np.ones(n + 1, dtype=bool)
    rank = np.full(n + 1, _NONE, dtype=np.int32)
    marked = np.zeros(n + 1, dtype=bool)
    marked[n] = True
    if n > 1:
        inner = np.flatnonzero(nxt[:n] < n)
        rank[inner] = t.byte_rank[data[inner], data[inner + 1]]
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def enter(where: np.ndarray) -> None:
        r = rank[where]
        has = r != _NONE
        where, r = where[has], r[has]
        if not len(where):
            return
        order = np.argsort(r, kind="stable")
        where, r = where[order], r[order]
        cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
        heads = r[np.concatenate(([0], cuts))].tolist()
        bounds = [0, *cuts.tolist(), len(r)]
        for i, head in enumerate(heads):
            if head in index:
                index[head].append(where[bounds[i]:bounds[i + 1]])
            else:
                index[head] = [where[bounds[i]:bounds[i + 1]]]
                heapq.heappush(heap, head)

    enter(np.arange(n, dtype=np.int32))
    while heap:
        r = heapq.heappop(heap)
        lists = index.pop(r)
        at = lists[0] if len(lists) == 1 else np.concatenate(lists)
        at = at[rank[at] == r]
        if not len(at):
            continue
        if t.left[r] == t.right[r]:  # a run of one symbol merges from its left end
            at = np.unique(at)
            head = np.ones(len(at), dtype=bool)
            head[1:] = nxt[at[:-1]] != at[1:]
            first = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
        gone = nxt[at]
        after = nxt[gone]
        sym[at] = t.merged[r]
        nxt[at] = after
        prv[after] = at
        prv[n] = n
        alive[gone] = False
        rank[gone] = _NONE
        marked[at] = True
        before = prv[at]
        touched = np.concatenate((at, before[~marked[before]]))  # slot n stays marked
        marked[at] = False
        rank[touched] = t.lookup(sym[touched], sym[nxt[touched]])
        enter(touched)
    keep = alive[:n]
    counts = np.concatenate(([0], np.cumsum(keep)))[offs]
    return sym[:n][keep], counts


def encode_texts(texts: list[str], t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of the texts; null counts as empty."""
    stretches: list[str] = []  # a text, or what lies between two added tokens of it
    of_text: list[list[int]] = []  # numbers of its stretches; -1 - id for an added token
    for text in texts:
        row: list[int] = []
        at = 0
        for m in t.cut.finditer(text or "") if t.cut else ():
            row += (len(stretches), -1 - t.added[m[0]])
            stretches.append(text[at:m.start()])
            at = m.end()
        row.append(len(stretches))
        stretches.append((text or "")[at:])
        of_text.append(row)
    ids, offs = _encode_stretches(stretches, t)
    if all(len(row) == 1 for row in of_text):
        return ids, offs
    whole, ends = [], [0]
    for row in of_text:
        whole += [ids[offs[x]:offs[x + 1]] if x >= 0 else np.array([-1 - x], dtype=np.int32) for x in row]
        ends.append(ends[-1] + sum(len(x) for x in whole[len(whole) - len(row):]))
    return np.concatenate(whole), np.array(ends)


def _gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values`` of the ranges, one after the other. The positions, several times
    the size of the result, are made for ``GATHERED`` ranges at a time."""
    out = np.empty(int(lengths.sum()), dtype=values.dtype)
    to = 0
    for at in range(0, len(starts), GATHERED):
        where = vec.ranges(starts[at:at + GATHERED], lengths[at:at + GATHERED])
        np.take(values, where, out=out[to:to + len(where)], mode="clip")  # never out of range; "raise" copies
        to += len(where)
    return out


def _encode_stretches(texts: list[str], t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of texts without added tokens.

    A piece holds white space only at its front, so wherever a space follows
    anything but white space a piece ends, and what stands on either side
    splits alike whatever is beyond. Texts are therefore cut at single
    spaces, and each different segment is split into pieces once; a text
    where white space meets a cut is split as a whole."""
    first, later = _Numbers(), _Numbers()
    heads, tails = first.__getitem__, later.__getitem__
    each, many = array("i"), []
    for text in texts:
        parts = text.split(" ")
        each.append(heads(parts[0]))
        each.extend(map(tails, islice(parts, 1, None)))
        many.append(len(parts))
    counts, flat = np.array(many, dtype=np.int64), np.array(each, dtype=np.int32)
    del each, many
    heads_at = vec.lengths_to_offsets(counts)
    later_mask = np.ones(len(flat), dtype=bool)
    later_mask[heads_at[:-1][counts > 0]] = False
    flat[later_mask] += len(first)
    segments = list(first) + [" " + s for s in later]
    meets = np.array([bool(s) and s[-1].isspace() for s in first]
                     + [not s or s[0].isspace() or s[-1].isspace() for s in later], dtype=bool)
    del first, later, heads, tails, later_mask
    # a text of one segment has no cut; white space at its ends meets nothing
    odd = np.bitwise_or.reduceat(meets[flat], heads_at[:-1]) & (counts > 1) if len(flat) else np.zeros(0, bool)
    if odd.any():
        base, extra = len(segments), [texts[i] for i in np.flatnonzero(odd)]
        segments += extra
        new_counts = np.where(odd, 1, counts)
        keep = ~np.repeat(odd, counts)
        keep[heads_at[:-1][odd]] = True
        flat[heads_at[:-1][odd]] = base + np.arange(len(extra))
        flat, counts = flat[keep], new_counts
    numbers = _Numbers()
    number = numbers.__getitem__
    each, many = array("i"), []
    for s in segments:
        found = t.split(s)
        each.extend(map(number, found))
        many.append(len(found))
    piece, at = np.array(each, dtype=np.int32), vec.lengths_to_offsets(np.array(many, dtype=np.int64))
    raw = [p.encode("utf-8", "surrogatepass") for p in numbers]
    del each, many, segments, numbers, number
    ids, offs = encode_pieces(raw, t)
    del raw
    # ids of each segment, then of each text, by gathering ranges
    lengths = offs[piece + 1] - offs[piece]
    seg_ids = _gathered(ids, offs[piece], lengths)
    seg_offs = vec.lengths_to_offsets(lengths)[at]
    lengths = seg_offs[flat + 1] - seg_offs[flat]
    stream = _gathered(seg_ids, seg_offs[flat], lengths)
    return stream, vec.lengths_to_offsets(lengths)[vec.lengths_to_offsets(counts)]


def decode_ids(stream: np.ndarray, offs: np.ndarray, t: Tables) -> list[str]:
    """Texts of the id ranges; bytes that are no UTF-8 become U+FFFD."""
    lengths = t.token_offs[stream + 1] - t.token_offs[stream]
    data = t.token_bytes[vec.ranges(t.token_offs[stream], lengths)] if len(stream) else t.token_bytes[:0]
    ends = vec.lengths_to_offsets(lengths)[offs].tolist()
    raw = data.tobytes()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


def _packed(stream: np.ndarray, offs: np.ndarray) -> pa.Array:
    """The id ranges as little-endian unsigned 32-bit integers, a binary each."""
    ends = (offs * 4).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offs) - 1, [None, pa.py_buffer(ends), pa.py_buffer(stream.astype("<u4"))])


def _columns_but(df: DataFrame, *names: str) -> list[T.StructField]:
    return [f for f in df.schema.fields if f.name not in names]


def encode(df: DataFrame, tokenizer: bytes, text_col: str = "text", ids_col: str = "ids",
           decoded_col: str | None = None, chunk_bytes: int = 4 << 20) -> DataFrame:
    """All columns of ``df`` plus ``ids_col``: the token ids of ``text_col``
    as little-endian unsigned 32-bit integers in one binary value, and, if
    ``decoded_col`` is named, the text that those ids decode to. A column of
    ``df`` that bears one of the new names is replaced.

    ``tokenizer`` is the content of a tokenizer file (read once on the
    driver; its size is that of the vocabulary, whatever the corpus).
    """
    new = [ids_col] + ([decoded_col] if decoded_col else [])
    kept = _columns_but(df, *new)
    fields = kept + [T.StructField(ids_col, T.BinaryType())]
    if decoded_col:
        fields.append(T.StructField(decoded_col, T.StringType()))
    shared = df.sparkSession.sparkContext.broadcast(tokenizer)
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables(shared.value)
        for part in vec.chunks(batches, text_col, chunk_bytes):
            stream, offs = encode_texts(part.column(text_col).to_pylist(), t)
            out = [part.column(c) for c in names]
            out.append(_packed(stream, offs))
            if decoded_col:
                out.append(pa.array(decode_ids(stream, offs, t), type=pa.string()))
            yield pa.RecordBatch.from_arrays(out, names=names + new)

    return df.mapInArrow(vec.trimmed(run), T.StructType(fields))


def decode(df: DataFrame, tokenizer: bytes, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """All columns of ``df`` plus ``text_col``: the text of the packed ids
    (null ids: null). Ids outside the vocabulary raise IndexError."""
    kept = _columns_but(df, text_col)
    names = [f.name for f in kept]
    shared = df.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables(shared.value)
        for part in vec.chunks(batches, ids_col, 8 << 20):
            raw = part.column(ids_col).to_pylist()
            stream = np.frombuffer(b"".join(x or b"" for x in raw), dtype="<u4").astype(np.int64)
            offs = vec.lengths_to_offsets(np.array([len(x or b"") // 4 for x in raw]))
            texts = [x if r is not None else None for x, r in zip(decode_ids(stream, offs, t), raw)]
            yield pa.RecordBatch.from_arrays([part.column(c) for c in names] + [pa.array(texts, type=pa.string())],
                                             names=names + [text_col])

    return df.mapInArrow(vec.trimmed(run), T.StructType(kept + [T.StructField(text_col, T.StringType())]))
