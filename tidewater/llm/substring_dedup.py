"""Substring dedup by recompression: long word sequences that repeat are removed.

Words get names (hashes), runs of one word get a name, and then rounds of pair
compression follow: a round's hash marks every name as a left or a right half,
and a left one followed by a right one become one new name, the hash of the
two. Names are the same everywhere in the corpus without a dictionary, and
whether two neighbours merge depends on them alone, so equal stretches of text
are cut into the same names except near their ends. Every symbol keeps the
range of words that its name and borders depend on.

If a window of ``width`` words stands in two places, every symbol whose range
lies inside the window stands in both places too. So

1. the high-level symbols of all documents are counted, and a symbol that
   stands once in the corpus rules out every window around its range;
2. what is left are stretches made of repeated symbols only: their windows are
   named and counted, which verifies the repeat word by word (names of 96 bits);
3. the words covered by repeated windows are taken out.

Counting never gathers the places of a name: a task sends each name once
however often it has seen it (with a mark if more than once, in which case its
own places are known to repeat at once), so a name of a third of all rows costs
one entry per task. Entries travel packed in arrays, dealt by name, and what
repeats comes back dealt by document.

Defined cases: null text has no words; a document shorter than ``width`` loses
nothing; rows that repeat are places of their own, so both lose all their
windows; overlapping places in one document count; ``width`` applies to the
input, not to what is left; very long texts are cut whole, a chunk of rows at a
time; an empty table gives an empty result. Rows are told apart by a 64-bit hash
of id and text; extra columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm import names as own_names
from tidewater.llm import vec

U64 = np.uint64
ROUNDS = 6
FLUSH = 1_000_000  # entries that a task combines before it sends them


class Parse:
    """Symbols of a chunk of texts: name, document, first word, and the words
    [low, high) that the symbol depends on (low < first of the document or
    high > its end where it depends on what would be beyond)."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, rounds: int = ROUNDS):
        self.starts, self.ends, doc = vec.word_spans(data, offs)
        n_docs = len(offs) - 1
        self.words = vec.span_hashes(data, self.starts, self.ends) if len(self.starts) else np.zeros(0, dtype=U64)
        self.word_offs = vec.lengths_to_offsets(np.bincount(doc, minlength=n_docs))
        # one slot between documents: equal to nothing, and beyond every window
        n = len(self.words)
        first = np.arange(n, dtype=np.int64)
        low, high = first.copy(), first + 1
        name, doc = self.words, doc.astype(np.int64)
        # runs
        if n:
            new = np.ones(n, dtype=bool)
            new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
            at = np.flatnonzero(new)
            length = np.diff(np.append(at, n))
            run = vec.mix(name[at] * U64(0xD6E8FEB86659FD93) + length.astype(U64))
            name = np.where(length > 1, run, name[at])
            doc, first = doc[at], first[at]
            low, high = first - 1, first + length + 1  # the words beside a run end it
        for r in range(rounds):
            n = len(name)
            if n < 2:
                break
            right = ((vec.mix(name + U64(0x632BE59BD9B4E019 * (r + 1) % 2**64)) >> U64(17)) & U64(1)).astype(bool)
            same = doc[1:] == doc[:-1]
            merge = np.zeros(n, dtype=bool)  # this one with the next
            merge[:-1] = same & ~right[:-1] & right[1:]
            second = np.zeros(n, dtype=bool)
            second[1:] = merge[:-1]
            next_high, prev_low = high.copy(), low.copy()
            next_high[:-1] = np.where(same, high[1:], high[:-1] + 1)
            next_high[-1] = high[-1] + 1
            prev_low[1:] = np.where(same, low[:-1], low[1:] - 1)
            prev_low[0] = low[0] - 1
            # a left half alone depends on what follows, a right half on what precedes
            high = np.where(~right, np.maximum(high, next_high), high)
            low = np.where(right & ~second, np.minimum(low, prev_low), low)
            pair = name.copy()
            pair[:-1] = np.where(merge[:-1], vec.mix(name[:-1] * U64(0x9E6C63D0876A9A47) + vec.mix(name[1:]) + U64(r + 1)), name[:-1])
            keep = ~second
            name, doc, first, low, high = pair[keep], doc[keep], first[keep], low[keep], high[keep]
        self.name, self.doc, self.first, self.low, self.high = name, doc, first, low, high

    def bounded(self, width: int) -> np.ndarray:
        """Symbols that some window of ``width`` words settles wholly."""
        return (self.high - self.low <= width) & (self.low >= self.word_offs[self.doc]) & (self.high <= self.word_offs[self.doc + 1])

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Names of the window from each word on (as far as it goes) and 32 more bits."""
        return vec.window_hashes(self.words, width, 41), (vec.window_hashes(self.words, width, 43) >> U64(32)).astype(np.uint32)

    def open_starts(self, width: int, single: np.ndarray) -> np.ndarray:
        """Words (of the chunk) at which a window begins that no symbol marked
        in ``single`` rules out."""
        n = len(self.words)
        delta = np.zeros(n + 2, dtype=np.int64)
        np.add.at(delta, np.maximum(self.high[single] - width, 0), 1)
        np.add.at(delta, self.low[single] + 1, -1)
        ok = np.cumsum(delta)[:n] == 0
        doc = np.repeat(np.arange(len(self.word_offs) - 1), np.diff(self.word_offs))
        ok &= np.arange(n) + width <= self.word_offs[doc + 1]
        return np.flatnonzero(ok)


_ENTRY = "to int, home boolean, name binary, bits binary, own binary, n binary, at binary"
_ENTRY_SCHEMA = pa.schema([("to", pa.int32()), ("home", pa.bool_())]
                          + [(c, pa.binary()) for c in ("name", "bits", "own", "n", "at")])
_ENTRY_NAMES = ["to", "home", "name", "bits", "own", "n", "at"]


def _dealt(to: np.ndarray, name: np.ndarray, bits: np.ndarray, own: np.ndarray, at: np.ndarray, home: bool) -> Iterator[pa.RecordBatch]:
    """Entries packed by where they go; the rows of one document are told once
    per packet. ``home`` packets go to documents, others to names."""
    order = np.lexsort((own, to))
    to, name, bits, own, at = to[order], name[order], bits[order], own[order], at[order]
    cuts = [0, *(np.flatnonzero(to[1:] != to[:-1]) + 1).tolist(), len(to)] if len(to) else [0]
    rows: list[list] = [[] for _ in _ENTRY_NAMES]
    for a, b in zip(cuts, cuts[1:]):
        o = own[a:b]
        head = np.flatnonzero(np.append(True, o[1:] != o[:-1]))
        for column, value in zip(rows, (int(to[a]), home, b"" if home else name[a:b].tobytes(), b"" if home else bits[a:b].tobytes(),
                                        o[head].tobytes(), np.diff(np.append(head, b - a)).astype("<u4").tobytes(), at[a:b].tobytes())):
            column.append(value)
    if rows[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(rows, _ENTRY_SCHEMA)], names=_ENTRY_NAMES)


def _unpacked(table: pa.Table, names: bool = True) -> tuple[np.ndarray, ...]:
    """(name, bits, own, at) of the packets of a table, or (own, at)."""
    get = lambda c, d: np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=d)
    places = np.repeat(get("own", "<i8"), get("n", "<u4")), get("at", "<i4")
    return (get("name", "<u8"), get("bits", "<u4"), *places) if names else places


class _Sender:
    """Combines a task's entries and sends each name once."""

    def __init__(self, parts: int):
        self.parts, self.held, self.count = parts, [], 0

    def add(self, name: np.ndarray, bits: np.ndarray, own: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(name):
            self.held.append((name, bits, own, at.astype(np.int32)))
            self.count += len(name)
            if self.count >= FLUSH:
                yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        name, bits, own, at = (np.concatenate(c) for c in zip(*self.held))
        self.held, self.count = [], 0
        first, many = _groups(name, bits)
        yield from _dealt(own[many] % self.parts, name[many], bits[many], own[many], at[many], True)
        at = np.where(many, np.int32(-1), at)  # told as "more than once", places not needed
        own = np.where(many, np.int64(0), own)
        yield from _dealt(_place(name, self.parts)[first], name[first], bits[first], own[first], at[first], False)


def _place(key: np.ndarray, parts: int) -> np.ndarray:
    return ((vec.mix(key) >> U64(33)) % U64(parts)).astype(np.int32)


def _groups(name: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks: the first entry of each (name, bits), and entries that are not alone."""
    order = np.argsort(name, kind="stable") if not bits.any() else np.lexsort((bits, name))
    n, b = name[order], bits[order]
    same = (n[1:] == n[:-1]) & (b[1:] == b[:-1])
    head, alone = np.ones(len(n), dtype=bool), np.ones(len(n), dtype=bool)
    head[1:] = ~same
    alone[1:] &= ~same
    alone[:-1] &= ~same
    first, many = np.empty(len(n), dtype=bool), np.empty(len(n), dtype=bool)
    first[order], many[order] = head, ~alone
    return first, many


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


def _repeated(entries: DataFrame, parts: int) -> DataFrame:
    """Of packed entries: packets of the places whose name stands elsewhere
    too, dealt by document. All packets take one shuffle; those that are for
    documents already just pass."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_place(batches):
            home = table.column("home").to_numpy()
            if home.any():
                yield from table.filter(pa.array(home)).to_batches()
            if not home.all():
                name, bits, own, at = _unpacked(table.filter(pa.array(~home)))
                _, many = _groups(name, bits)
                many &= at >= 0  # a task that saw its name twice has told its own places
                yield from _dealt(own[many] % parts, name[many], bits[many], own[many], at[many], True)

    return entries.repartition("to").sortWithinPartitions("to").mapInArrow(vec.trimmed(count), _ENTRY).select("to", "own", "n", "at")


def _by_document(df: DataFrame, key: str, text: str, row: str, place: str) -> tuple[DataFrame, int]:
    """All rows with ``row`` (names the row: a hash of key and text) and
    ``place``, the part of the documents that the row is dealt to."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = F.xxhash64(F.col(key).cast("string"), F.col(text))
    return df.withColumn(row, own).withColumn(place, F.pmod(F.col(row), F.lit(parts)).cast("int")), parts


def _spans(dealt: DataFrame, parts: int, text: str, width: int, row: str, place: str) -> DataFrame:
    """(to, own, starts, ends): the word ranges of each document that repeated
    windows cover, as two arrays. Documents without any are left out."""
    def symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Sender(parts)
        for part in vec.chunks(batches, text):
            p = Parse(*vec.buffer(part.column(text)))
            ok = p.bounded(width)
            doc = p.doc[ok]
            own = part.column(row).to_numpy()[doc]
            yield from out.add(p.name[ok], np.zeros(len(doc), dtype=np.uint32), own, p.first[ok] - p.word_offs[doc])
        yield from out.flush()

    def windows(docs: pa.Table, packets: pa.Table) -> pa.Table:
        out, got = _Sender(parts), []
        own, at = _unpacked(packets, False)
        several = np.unique(_spot(own, at))
        for part in vec.chunks(iter(docs.to_batches()), text):
            p = Parse(*vec.buffer(part.column(text)))
            mine = part.column(row).to_numpy()
            spot = _spot(mine[p.doc], p.first - p.word_offs[p.doc])
            start = p.open_starts(width, p.bounded(width) & ~np.isin(spot, several))
            doc = np.searchsorted(p.word_offs, start, side="right") - 1
            name, bits = p.windows(width)
            got += out.add(name[start], bits[start], mine[doc], start - p.word_offs[doc])
        got += out.flush()
        vec.release()
        return pa.Table.from_batches(got, schema=_ENTRY_SCHEMA)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_place(batches):
            own, at = _unpacked(table, False)
            order = np.lexsort((at, own))
            own, at = own[order], at[order].astype(np.int64)
            new = np.ones(len(own), dtype=bool)
            new[1:] = (own[1:] != own[:-1]) | (at[1:] > at[:-1] + width)
            head = np.flatnonzero(new)
            start, end, whose = at[head], at[np.append(head[1:], len(at)) - 1] + width, own[head]
            docs_at = np.flatnonzero(np.append(True, whose[1:] != whose[:-1])) if len(whose) else head
            offs = pa.array(np.append(docs_at, len(whose)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(docs_at), table.column("to")[0].as_py(), dtype=np.int32)), pa.array(whose[docs_at]),
                 pa.ListArray.from_arrays(offs, pa.array(start.astype(np.int32))),
                 pa.ListArray.from_arrays(offs, pa.array(end.astype(np.int32)))], names=["to", "own", "starts", "ends"])

    several = _repeated(dealt.select(text, row).mapInArrow(vec.trimmed(symbols), _ENTRY), parts)
    entries = dealt.groupBy(place).cogroup(several.groupBy("to")).applyInArrow(windows, _ENTRY)
    return (_repeated(entries, parts).repartition("to").sortWithinPartitions("to")
            .mapInArrow(vec.trimmed(merge), "to int, own long, starts array<int>, ends array<int>"))


def _spot(own: np.ndarray, at: np.ndarray) -> np.ndarray:
    return vec.mix(own.view(U64) + vec.mix(at.astype(U64) + U64(1)))


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 35,
                   counts: tuple[str, str] = ("n_words", "n_removed")) -> DataFrame:
    """All rows and columns of ``df`` with ``text`` reduced to the words that no
    repeated window covers, joined by one space (null stays null), and two
    more columns: words, words removed. A column that bears one of their
    names is replaced.

    Both passes over the texts deal them out the same way, so that Spark
    shuffles them once and reads that shuffle twice."""
    kept = df.select(*[c for c in df.columns if c not in counts])
    names, at_text = kept.columns, kept.columns.index(text)
    row, place = own_names.free(kept, "own", "to")
    dealt, parts = _by_document(kept, key, text, row, place)
    spans = _spans(dealt, parts, text, width, row, place)
    schema = T.StructType(kept.schema.fields + [T.StructField(c, T.LongType()) for c in counts])

    def cut(docs: pa.Table, spans: pa.Table) -> pa.Table:
        whose = spans.column("own").to_numpy()
        order = np.argsort(whose, kind="stable")
        whose = whose[order]
        lists = [spans.column(c).combine_chunks().take(pa.array(order)) for c in ("starts", "ends")]
        out = [_without(part, at_text, names, counts, row, whose, lists)
               for part in vec.chunks(iter(docs.to_batches()), text)]
        vec.release()
        return pa.Table.from_batches(out) if out else docs.select(names).append_column(
            counts[0], pa.array([], type=pa.int64())).append_column(counts[1], pa.array([], type=pa.int64()))

    return dealt.groupBy(place).cogroup(spans.groupBy("to")).applyInArrow(cut, schema)


def _without(part: pa.RecordBatch, at_text: int, names: list[str], counts: tuple[str, str],
             row: str, whose: np.ndarray, lists: list[pa.Array]) -> pa.RecordBatch:
    """A chunk of documents without the words in their spans."""
    data, offs = vec.buffer(part.column(names[at_text]))
    start, end, doc = vec.word_spans(data, offs)
    n = part.num_rows
    words = np.bincount(doc, minlength=n)
    base = vec.lengths_to_offsets(words)
    delta = np.zeros(len(start) + 1, dtype=np.int64)
    if len(whose):
        own = part.column(row).to_numpy()
        at_row = np.minimum(np.searchsorted(whose, own), len(whose) - 1)
        has = np.flatnonzero(whose[at_row] == own)
        for column, sign in zip(lists, (1, -1)):
            mine = column.take(pa.array(at_row[has]))
            many = mine.value_lengths().to_numpy()
            at = np.minimum(np.repeat(base[has], many) + mine.flatten().to_numpy(), np.repeat(base[has + 1], many))
            np.add.at(delta, at, sign)
    gone = np.cumsum(delta)[:-1] > 0
    raw, keep = data.tobytes(), np.flatnonzero(~gone)
    pieces = [raw[a:b] for a, b in zip(start[keep].tolist(), end[keep].tolist())]
    to = np.searchsorted(keep, base).tolist()
    valid = part.column(names[at_text]).is_valid().to_pylist()
    texts = [b" ".join(pieces[a:b]).decode("utf-8") if ok else None for a, b, ok in zip(to, to[1:], valid)]
    out = [part.column(c) for c in names]
    out[at_text] = pa.array(texts, type=pa.string())
    return pa.RecordBatch.from_arrays(out + [pa.array(words), pa.array(np.bincount(doc[gone], minlength=n))],
                                      names=names + list(counts))
