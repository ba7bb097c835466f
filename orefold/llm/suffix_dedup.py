"""Suffix-array dedup: bytes covered by repeated windows, by depth-limited radix sort.

Suffixes are ordered only through the threshold's bytes, by most-significant-digit
passes over digits of text, and a bucket that holds one suffix is never looked
at again; suffixes equal to full depth are exactly the repeated windows.

The digits are chosen so that neighbouring suffixes go together.  The first
digit of a suffix is the least hash among the ANCHOR-byte strings of its window: equal windows
have equal digits, and runs of suffixes with one digit, some dozens of bytes
long, travel as one segment.  The second digit is the hash of all the text that a segment's
windows span: segments equal there are repeated throughout.  Only suffixes of segments
that share the first digit but not the second are sorted one by one, by their
windows' full hashes.

Passages of some number of words that repeat are found in the same passes, as
suffixes of word sequences beside those of bytes (a view of their own).

Equality is judged by 96 bits or more: by both digits of a segment, and by two
independent hashes of a single window, one of them modulo a prime.

Every pass first settles what meets inside a task, so a string that stands in a
third of all rows reaches a bucket once a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm._vec import Slice, Words, byte_codes, byte_table, mix64, prefix61, prefix_hash, separators, slices, span61, span_hash, window61
from orefold.llm.shared import map_arrow, partitions, written

WINDOW = 400
#: Bytes of a first digit's strings; windows hold WINDOW - ANCHOR + 1 of them.
ANCHOR = 300
#: Segments of one first digit that a task sends to its bucket; more are sorted one by one at once.
MOST_IN_TASK = 64
IDS_BYTES = 64 << 20
#: Bytes of text that the first pass works on at once, so that most stays in a core's cache.
SLICE_BYTES = 1 << 16
#: Segments, or single suffixes, that a task gathers before it settles what meets among them.
HELD = 300_000

#: Words of the windows of the second view, and of their first digit's strings.
PASSAGE_WORDS = 50

_CODES, _TABLE = byte_codes(2, False), byte_table(2, False)
_SEPARATORS = separators("space")
#: States of spans: repeated throughout, to be sorted one by one, or known as repeated and sorted with the open ones.
_WHOLE, _OPEN, _GIVEN = 1, 2, 3


def _sliding(x: np.ndarray, width: int, better) -> np.ndarray:
    """better over all spans of width values."""
    have = 1
    while have * 2 <= width:
        x = better(x[:-have], x[have:])
        have *= 2
    return better(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


@dataclass(frozen=True)
class View:
    """Windows over bytes (number 0) or words (number 1), and the length of their first digit's strings."""

    number: int
    window: int
    anchor: int

    def read(self, s: Slice, base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the hashes of spans are read of, each row's first item, and values for a second hash; base is that of the bytes."""
        if not self.number:
            return base, s.offsets, _TABLE[s.data]
        words = Words(s, _SEPARATORS, _CODES, base)
        return words.sequence(), words.first, words.hashes

    @property
    def salt(self) -> np.uint64:
        """Keeps the views' hashes apart."""
        return np.uint64(self.number * 0xA24BAED4963EE407)


#: The head of packed windows that a task has settled; a number of rows never looks like it.
_SETTLED = b"settled."

#: The view's place in a span's state and in a segment's mark.
_VIEW = 4


@dataclass
class Segments:
    """Runs of window starts with one first digit; start counts inside the row."""

    row: np.ndarray
    start: np.ndarray
    length: np.ndarray
    first: np.ndarray
    second: np.ndarray
    again: np.ndarray  # the digit's string stands twice inside the segment
    view: np.ndarray


def segments(s: Slice, view: View, base: np.ndarray) -> Segments:
    prefix, offsets, _ = view.read(s, base)
    window, anchor = view.window, view.anchor
    begin, end = offsets[:-1], offsets[1:]
    long = end - begin >= window
    none = np.zeros(0, np.int64)
    if not long.any():
        return Segments(none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool), none.astype(np.uint8))
    strings = window61(prefix, anchor)
    width = window - anchor + 1
    least = _sliding(strings, width, np.minimum)
    cuts = np.union1d(np.flatnonzero(least[1:] != least[:-1]) + 1, begin[long])
    row = np.searchsorted(offsets, cuts, "right") - 1
    until = end[row] - window  # a row's last window
    inside = cuts <= until
    start, row = cuts[inside], row[inside]
    last = np.minimum(np.append(cuts[1:], len(least))[inside] - 1, until[inside])
    # anchors: strings that are the least of some window; a segment repeats itself where two equal ones follow one another
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    anchors = np.flatnonzero(strings == _sliding(padded, width, np.maximum)[: len(strings)])
    twice = anchors[:-1][(strings[anchors[1:]] == strings[anchors[:-1]]) & (np.diff(anchors) <= width)]
    if len(twice):
        i = np.minimum(np.searchsorted(twice, start), len(twice) - 1)
        again = (twice[i] >= start) & (twice[i] <= last + width - 1)
    else:
        again = np.zeros(len(start), bool)
    return Segments(row, start - offsets[row], last - start + 1, least[start] ^ view.salt, span61(prefix, start, last + window) ^ view.salt, again, np.full(len(start), view.number, np.uint8))


def _part(keys: np.ndarray, n: int) -> np.ndarray:
    """Parts of even size; keys are scrambled anew, as least hashes are small ones."""
    return ((mix64(keys) >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def _deal(keys: np.ndarray, columns: list[np.ndarray], n: int) -> tuple[np.ndarray, list[bytes]]:
    """Rows of columns by part of their key: part numbers and, for each, the columns' bytes behind their number.

    32-bit columns go byte by byte, as their high bytes are much alike and then take little room.
    """
    parts = _part(keys, n)
    order = np.argsort(parts, kind="stable")
    edges = np.searchsorted(parts[order], np.arange(n + 1).astype(np.uint64))
    some = np.flatnonzero(np.diff(edges))
    columns = [c[order] for c in columns]
    flat = lambda c: c.view(np.uint8).reshape(-1, 4).T.tobytes() if c.itemsize == 4 else c.tobytes()
    return some, [b"".join([np.int64(edges[i + 1] - edges[i]).tobytes(), *(flat(c[edges[i] : edges[i + 1]]) for c in columns)]) for i in some]


def _gather(blobs: list[bytes], kinds: list) -> list[np.ndarray]:
    parts = []
    for blob in blobs:
        n, o, own = int(np.frombuffer(blob, np.int64, 1)[0]), 8, []
        for kind in kinds:
            size = np.dtype(kind).itemsize
            column = np.frombuffer(blob, np.uint8, n * size, o)
            own.append(np.ascontiguousarray(column.reshape(4, n).T).view(kind).reshape(n) if size == 4 else column.view(kind))
            o += n * size
        parts.append(own)
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, k) for k in kinds]


_ROWS = "part int, told boolean, packed binary"
_KIND = [np.int64, np.uint64, np.uint64, np.uint32, np.uint32, np.uint8]
_SPAN = [np.int64, np.uint32, np.uint32, np.uint8]


def _batch(told: bool, dealt: tuple[np.ndarray, list[bytes]]) -> pa.RecordBatch:
    part, packed = dealt
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(np.full(len(packed), told)), pa.array(packed, pa.binary())], names=["part", "told", "packed"])


def _told(spans: tuple[np.ndarray, ...], n: int) -> pa.RecordBatch:
    """Spans (uid, start, length, state) on their way to the part of their row."""
    return _batch(True, _deal(spans[0].astype(np.uint64), [c.astype(k) for c, k in zip(spans, _SPAN)], n))


def _sorted_buckets(rows: DataFrame, deal, sort, n: int) -> DataFrame:
    """uid and packed spans, a row for each uid: what deal tells at once, and what sort finds in the buckets that deal fills."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: list[bytes] = []
        for batch in batches:
            told = batch.column("told")
            if batch.filter(told).num_rows:
                yield batch.filter(told)
            blobs += batch.filter(pc.invert(told)).column("packed").to_pylist()
        yield from sort(blobs)

    def by_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid, start, length, state = _gather([x.as_py() for batch in batches for x in batch.column("packed")], _SPAN)
        order = np.lexsort((start, uid))
        triples = np.stack([start[order], length[order], state[order].astype(np.uint32)], 1)
        names, first = np.unique(uid[order], return_index=True)
        edges = np.append(first, len(uid))
        for i in range(0, len(names), 1000):
            packed = [triples[a:b].tobytes() for a, b in zip(edges[i : i + 1000], edges[i + 1 : i + 1001])]
            yield pa.RecordBatch.from_arrays([pa.array(names[i : i + 1000]), pa.array(packed, pa.binary())], names=["uid", "packed"])

    for run in (deal, search):
        rows = map_arrow(rows, run, _ROWS).repartitionById(n, F.col("part"))
    return map_arrow(rows, by_row, "uid long, packed binary")


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value, its number and whether it is the first of its kind."""
    _, first, inverse, counts = np.unique(x, return_index=True, return_inverse=True, return_counts=True)
    lead = np.zeros(len(x), bool)
    lead[first] = True
    return counts[inverse], lead


def _kinds(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A number for each pair of values, the same for equal pairs only."""
    order = np.lexsort((y, x))
    fresh = np.append(True, (x[order[1:]] != x[order[:-1]]) | (y[order[1:]] != y[order[:-1]]))
    out = np.empty(len(x), np.int64)
    out[order] = np.cumsum(fresh) - 1
    return out


def _first_passes(rows: DataFrame, views: list[View], n_parts: int) -> DataFrame:
    """uid and packed spans: whole ones (state 1) and those to be sorted one by one (state 2)."""

    def settle(held: list[tuple[Segments, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        first, second, start, length, again, view = (np.concatenate([getattr(g, c) for g, _ in held]) for c in ("first", "second", "start", "length", "again", "view"))
        uid = np.concatenate([u for _, u in held])
        n_first, _ = _runs(first)
        n_same, lead = _runs(_kinds(first, second))
        # settled here: equal segments are repeated; of many with one digit all are sorted one by one
        here = np.where(n_same > 1, _WHOLE, np.where((n_first > MOST_IN_TASK) | again, _OPEN, 0)).astype(np.uint8)
        done = here > 0
        if done.any():
            yield _told((uid[done], start[done], length[done], (here | view << _VIEW)[done]), n_parts)
        send = (here == 0) | lead & (n_same > 1) | again
        crowd = np.flatnonzero(n_first > MOST_IN_TASK)
        send[crowd[np.unique(first[crowd], return_index=True)[1]]] = True
        # marks say that the task knows the digit to be shared, the segment to be repeated, its state to be told, or others of its digit to be open
        _, inverse = np.unique(first, return_inverse=True)
        some_open = np.bincount(inverse, here != _WHOLE)[inverse] > 0
        mark = (n_first > 1) | again | 2 * (n_same > 1) | 4 * done | 8 * some_open | view << _VIEW
        columns = [uid, first, second, start.astype(np.uint32), length.astype(np.uint32), mark.astype(np.uint8)]
        yield _batch(False, _deal(first[send], [c[send] for c in columns], n_parts))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[Segments, np.ndarray]] = []
        for batch in batches:
            uids = batch.column("uid").to_numpy()
            for s in slices(batch.column("text"), SLICE_BYTES):
                base = prefix61(_CODES[s.data])
                for view in views:
                    g = segments(s, view, base)
                    if len(g.row):
                        held.append((g, uids[s.first + g.row]))
                if sum(len(u) for _, u in held) > HELD:
                    yield from settle(held)
                    held = []
        if held:
            yield from settle(held)

    def sort(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        uid, first, second, start, length, mark = _gather(blobs, _KIND)
        if not len(first):
            return
        view = mark >> _VIEW << _VIEW
        n_first, _ = _runs(first)
        _, inverse = np.unique(first, return_inverse=True)
        shared = (n_first > 1) | (np.bincount(inverse, (mark & 1) > 0)[inverse] > 0)
        same = _kinds(first, second)
        n_same, _ = _runs(same)
        _, inverse = np.unique(same, return_inverse=True)
        whole = (n_same > 1) | (np.bincount(inverse, (mark & 2) > 0)[inverse] > 0)
        state = np.where(whole, _WHOLE, np.where(shared, _OPEN, 0)).astype(np.uint8) | view
        tell = np.where(whole, (mark & 2) == 0, shared & ((mark & 4) == 0))
        if tell.any():
            yield _told((uid[tell], start[tell], length[tell], state[tell]), n_parts)
        # where a digit has open segments too, one of each kind of repeated ones is sorted with them
        _, inverse = np.unique(first, return_inverse=True)
        mixed = np.bincount(inverse, ~whole | ((mark & 8) > 0))[inverse] > 0
        given = np.flatnonzero(mixed & whole)
        if len(given):
            given = given[np.unique(same[given], return_index=True)[1]]
            yield _told((uid[given], start[given], length[given], _GIVEN | view[given]), n_parts)

    return _sorted_buckets(rows, deal, sort, n_parts)


def _triples(packed: bytes | None) -> np.ndarray:
    """Starts, lengths and states of a row's spans."""
    return np.frombuffer(packed or b"", np.uint32).reshape(-1, 3).astype(np.int64)


def _last_pass(rows: DataFrame, spans: DataFrame, views: list[View], n_parts: int) -> DataFrame:
    """uid and packed spans of the open spans' suffixes whose windows are equal to full depth."""
    asked, in_words = [np.int64, np.uint64, np.uint32, np.uint32], 1 << 31

    def settle(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        keys, more, uid, at, known = (np.concatenate(x) for x in zip(*held))
        same = _kinds(keys, more)
        n, lead = _runs(same)
        many = (n > 1) | (np.bincount(same, known)[same] > 0)
        tell = many & ~known
        if tell.any():
            yield _told(_positions(uid[tell], at[tell]), n_parts)
        # what is settled goes once for all, without a place, as it wants no answer
        ask, settled = ~many, many & lead
        yield _batch(False, _deal(keys[ask], [c[ask].astype(k) for c, k in zip((uid, keys, more, at), asked)], n_parts))
        part, packed = _deal(keys[settled], [keys[settled], more[settled]], n_parts)
        yield _batch(False, (part, [_SETTLED + x for x in packed]))

    def open_starts(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts in open and given spans, and whether they are given."""
        n = spans[:, 1]
        at = np.repeat(spans[:, 0] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        at = np.unique(2 * at + ~np.repeat(spans[:, 2] % (1 << _VIEW) == _GIVEN, n))
        at = at[np.append(True, at[1:] // 2 != at[:-1] // 2)]
        return at // 2, at % 2 == 0

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            uids, packed = batch.column("uid").to_numpy(), batch.column("packed")
            for s in slices(batch.column("text")):
                own, base = [_triples(packed[s.first + i].as_py()) for i in range(s.n)], prefix61(_CODES[s.data])
                for view in views:
                    wanted = [x[(x[:, 2] >> _VIEW == view.number) & (x[:, 2] % (1 << _VIEW) != _WHOLE)] for x in own]
                    if not any(map(len, wanted)):
                        continue
                    prefix, offsets, values = view.read(s, base)
                    second = prefix_hash(values)
                    for i, x in enumerate(wanted):
                        if len(x):
                            at, known = open_starts(x)
                            begin = at + offsets[i]
                            end = begin + view.window
                            held.append((span61(prefix, begin, end) ^ view.salt, (span_hash(second, begin, end) >> np.uint64(32)).astype(np.uint32), np.full(len(at), uids[s.first + i]), at + view.number * in_words, known))
                if sum(len(x[0]) for x in held) > HELD:
                    yield from settle(held)
                    held = []
        if held:
            yield from settle(held)

    def sort(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        uid, keys, more, at = _gather([x for x in blobs if not x.startswith(_SETTLED)], asked)
        if not len(keys):
            return
        keys2, more2 = _gather([x[len(_SETTLED) :] for x in blobs if x.startswith(_SETTLED)], [np.uint64, np.uint32])
        same = _kinds(np.concatenate([keys, keys2]), np.concatenate([more, more2]))
        one = same[: len(keys)]
        again = np.bincount(one, minlength=same.max() + 1) > 1
        again[same[len(keys) :]] = True
        tell = again[one]
        if tell.any():
            yield _told(_positions(uid[tell], at[tell].astype(np.int64)), n_parts)

    return _sorted_buckets(rows.join(spans, "uid").select("uid", "text", "packed"), deal, sort, n_parts)


def _positions(uid: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Single window starts by row, runs of them as one span; the starts' highest bit is the view."""
    order = np.lexsort((at, uid))
    uid, at = uid[order], at[order]
    fresh = np.append(True, (uid[1:] != uid[:-1]) | (at[1:] != at[:-1] + 1))
    k = np.flatnonzero(fresh)
    length = np.diff(np.append(k, len(at)))
    return uid[k], at[k] % (1 << 31), length, _WHOLE | at[k] >> 31 << _VIEW


def removed_spans(starts: np.ndarray, lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal byte runs covered by windows that start in the given spans."""
    if not len(starts):
        return starts, starts
    order = np.argsort(starts, kind="stable")
    a, b = starts[order], (starts + lengths - 1 + window)[order]
    reach = np.maximum.accumulate(b)
    fresh = np.append(True, a[1:] > reach[:-1])
    k = np.flatnonzero(fresh)
    return a[k], reach[np.append(k[1:], len(a)) - 1]


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept, the bytes outside repeated windows, and n_passage_words.

    n_passage_words counts the words in passages of passage_words words, however
    many bytes they have, that start anywhere else too; nothing is removed for
    them.  Words are runs of anything but ASCII white space.

    A window is repeated if it starts anywhere else in any row, its own included;
    windows never cross rows.  Null or empty texts keep nothing of nothing.  Rows
    that repeat, keys included, count as several texts.  kept may cut
    characters, so it is binary.
    """
    if not 0 < anchor <= window or passage_words < 1:
        raise ValueError("anchor must lie in the window, and passages have words")
    views = [View(0, window, anchor), View(1, passage_words, -(-passage_words // 2))]
    n_parts = partitions(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(F.col(key), F.col(text)).alias("uid"))
    long = F.octet_length("text") >= min(window, 2 * passage_words - 1)
    spans = written(_first_passes(rows.filter(long).select("uid", "text"), views, n_parts))
    marked = spans.select("uid")
    small = marked.count() * 16 <= IDS_BYTES
    ids = F.broadcast(marked) if small else marked
    some, rest = rows.join(ids, "uid", "left_semi"), rows.join(ids, "uid", "left_anti")
    last = written(_last_pass(some.select("uid", "text"), spans, views, n_parts)).withColumnRenamed("packed", "more")
    found = spans.join(last, "uid", "left").select("uid", F.concat("packed", F.coalesce("more", F.lit(b""))).alias("packed"))
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType()), T.StructField("n_passage_words", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column("packed")
            for s in slices(batch.column("text")):
                removed, count, kept, words = [], [], [], []
                for i in range(s.n):
                    spans = _triples(packed[s.first + i].as_py())
                    x = spans[spans[:, 2] == _WHOLE | 1 << _VIEW]
                    a, b = removed_spans(x[:, 0], x[:, 1], passage_words)
                    words.append(int((b - a).sum()))
                    spans = spans[spans[:, 2] == _WHOLE]
                    a, b = removed_spans(spans[:, 0], spans[:, 1], window)
                    body = s.text(i)
                    edges = [0, *np.stack([a, b], 1).reshape(-1).tolist(), len(body)]
                    kept.append(b"".join(body[x:y] for x, y in zip(edges[::2], edges[1::2])))
                    removed.append(len(body) - len(kept[-1]))
                    count.append(len(a))
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(s.first, s.n), pa.array(np.diff(s.offsets), pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(kept, pa.binary()), pa.array(words, pa.int64())], names=schema.names)

    changed = map_arrow(some.join(found, "uid").select("key", "text", "packed"), cut, schema)
    size = F.octet_length("text").cast("long")
    same = rest.select(F.col("key").alias(key), size.alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("text").cast("binary").alias("kept"), F.lit(0).cast("long").alias("n_passage_words"))
    return changed.unionByName(same)
