"""Benchmark decontamination by suffix arrays of the training text.

Training texts are indexed shard by shard (a slice of rows of bounded bytes, whole
documents only, so nothing is shuffled).  A shard's suffix array holds its word
suffixes in the order of their words; a word that the benchmark lacks ends a
suffix, as no match passes it, and suffixes with fewer words than the shortest
window are left out.  Every suffix of the benchmark is binary-searched in the
array: the suffixes that begin with its window form one range, and each gives a
place.  Places on one diagonal are joined to the longest verbatim matches.

The benchmark's suffixes are built once on the driver, in blocks of a bounded
size, and broadcast; a larger benchmark takes more passes, whose results are merged
by row.  Words are numbered by hashes modulo a prime, and the bytes of every
matched word are compared before a match is told.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm._vec import Slice, Words, byte_codes, separators, slices
from orefold.llm.shared import map_arrow, written

DEPTH = 10
#: Bytes of benchmark text that are broadcast at once.
BLOCK_BYTES = 8 << 20

_CODES = byte_codes(8, True)
_SEPARATORS = separators("alnum")

MATCH = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("doc_word", T.IntegerType()), T.StructField("item_word", T.IntegerType()), T.StructField("length", T.IntegerType())])

SPAN = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])


def _word(s: Slice, w: Words, i: int) -> bytes:
    return s.data[w.starts[i] : w.ends[i]].tobytes().lower()


def _packed(numbers: np.ndarray, at: np.ndarray, width: int, bits: int) -> np.ndarray:
    """Keys in the order of the first width words at each place, a column for each 63 // bits words; numbers are padded with zeros."""
    each = 63 // bits
    out = np.zeros((-(-width // each), len(at)), np.int64)
    for j in range(width):
        out[j // each] |= numbers[at + j] << (bits * (each - 1 - j % each))
    return out


@dataclass
class Suffixes:
    """The suffixes of a block of benchmark items that hold a window.

    Windows of one width are searched together; those that stand several times
    are searched once, and spots lists where each stands.
    """

    items: list[str]
    first: np.ndarray  # of each item, in words
    words: list[bytes]  # by number, from 1
    hashes: np.ndarray  # of the words, sorted, and their numbers
    numbers: np.ndarray
    bits: int
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # width -> columns of keys, first spot of each, spots

    @classmethod
    def build(cls, rows: list[tuple[object, str | None]], depth: int = DEPTH) -> "Suffixes":
        s = next(slices(pa.array([r[1] for r in rows], pa.string()), 1 << 62), Slice(0, np.zeros(0, np.uint8), np.zeros(1, np.int64)))
        w = Words(s, _SEPARATORS, _CODES)
        known: dict[bytes, int] = {}
        own = np.array([known.setdefault(_word(s, w, i), len(known) + 1) for i in range(len(w.hashes))], np.int64)
        hashes, where = np.unique(w.hashes, return_index=True)
        if len(hashes) != len(known):
            raise ValueError("two words of the benchmark have equal hashes")
        bits = max(1, len(known).bit_length())
        counts, windows = np.diff(w.first), {}
        padded = np.append(own, np.zeros(depth, np.int64))
        for width in sorted({min(depth, int(n)) for n in counts if n}):
            at = np.concatenate([np.arange(a, b - width + 1) for a, b, n in zip(w.first, w.first[1:], counts) if min(depth, n) == width])
            keys = _packed(padded, at, width, bits)
            order = np.lexsort(keys[::-1])
            keys, at = keys[:, order], at[order]
            fresh = np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0))
            windows[width] = keys[:, fresh], np.append(np.flatnonzero(fresh), len(at)), at
        return cls([str(r[0]) for r in rows], w.first, [b"", *known], hashes, own[where], bits, windows)


def _bisect(column: np.ndarray, lo: np.ndarray, hi: np.ndarray, x: np.ndarray, right: bool) -> np.ndarray:
    """Where each x belongs between lo and hi, parts of column that are in order."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        middle = (lo + hi) >> 1
        value = column[np.minimum(middle, len(column) - 1)]
        up = open_ & ((value <= x) if right else (value < x))
        lo = np.where(up, middle + 1, lo)
        hi = np.where(open_ & ~up, middle, hi)
    return lo


class Shard:
    """The suffix array of a slice of documents."""

    def __init__(self, s: Slice, tests: Suffixes, depth: int = DEPTH) -> None:
        self.words = w = Words(s, _SEPARATORS, _CODES)
        n = len(w.hashes)
        self.row = np.repeat(np.arange(s.n), np.diff(w.first))
        self.numbers = np.zeros(n + depth, np.int64)
        if len(tests.hashes) and n:
            at = np.minimum(np.searchsorted(tests.hashes, w.hashes), len(tests.hashes) - 1)
            self.numbers[:n] = np.where(tests.hashes[at] == w.hashes, tests.numbers[at], 0)
        self._sort(tests, depth)

    def _sort(self, tests: Suffixes, depth: int) -> None:
        n, w = len(self.row), self.words
        # words up to the document's end or to the next word that the benchmark lacks
        ends = np.flatnonzero(self.numbers[:n] == 0)
        stop = np.append(ends, n)[np.searchsorted(ends, np.arange(n))]
        run = np.minimum(stop, np.repeat(w.first[1:], np.diff(w.first))) - np.arange(n)
        at = np.flatnonzero(run >= min(tests.windows, default=1)) if tests.windows else np.zeros(0, np.int64)
        run = np.minimum(run[at], depth)
        width = max(tests.windows, default=1)
        keys = _packed(self.numbers, at, width, tests.bits)
        # what follows a suffix's end is no part of it
        each = 63 // tests.bits
        for j in range(len(keys)):
            have = np.clip(run - j * each, 0, each)
            keys[j] &= ~((1 << (tests.bits * (each - have))) - 1)
        order = np.lexsort(keys[::-1])
        self.at, self.keys = at[order], keys[:, order]

    def hits(self, tests: Suffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of a training and a benchmark place with equal windows, and the windows' widths."""
        out: tuple[list, list, list] = [], [], []
        each = 63 // tests.bits
        for width, (keys, first, spots) in tests.windows.items():
            if not len(self.at):
                break
            lo, hi, which = np.zeros(keys.shape[1], np.int64), np.full(keys.shape[1], len(self.at)), np.arange(keys.shape[1])
            for j, x in enumerate(keys):
                rest = max(0, each - (width - j * each))  # words of the key beyond the window
                low, column = x[which], self.keys[j]
                high = low | ((1 << (tests.bits * rest)) - 1)
                if j == 0:
                    lo, hi = np.searchsorted(column, low, "left"), np.searchsorted(column, high, "right")
                else:
                    lo, hi = _bisect(column, lo, hi, low, False), _bisect(column, lo, hi, high, True)
                some = lo < hi
                lo, hi, which = lo[some], hi[some], which[some]
            if not len(which):
                continue
            n, m = hi - lo, np.diff(first)[which]
            # every training place with every spot of the window
            pairs = n * m
            k = np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            out[0].append(self.at[np.repeat(lo, pairs) + k // np.repeat(m, pairs)])
            out[1].append(spots[np.repeat(first[which], pairs) + k % np.repeat(m, pairs)])
            out[2].append(np.full(len(k), width))
        if not out[0]:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in out)

    def checked_hits(self, s: Slice, tests: Suffixes, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The hits, and which words they cover; the bytes of every covered word are compared."""
        while True:
            at, test, width = self.hits(tests)
            edge = np.zeros(len(self.row) + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + width, -1)
            hit = np.cumsum(edge[:-1]) > 0
            wrong = [i for i in np.flatnonzero(hit).tolist() if _word(s, self.words, i) != tests.words[self.numbers[i]]]
            if not wrong:
                return at, test, width, hit
            self.numbers[wrong] = 0  # a word that only has the hash of one of the benchmark's
            self._sort(tests, depth)


def _judge(s: Slice, tests: Suffixes, depth: int) -> tuple[np.ndarray, np.ndarray, dict[int, list[int]], dict[int, list[dict]], dict[int, list[dict]]]:
    """For each row: its words, hit words; for rows with hits: item numbers, longest matches and runs of hit words."""
    shard = Shard(s, tests, depth)
    w = shard.words
    at, test, width, hit = shard.checked_hits(s, tests, depth)
    covered = np.concatenate([[0], np.cumsum(hit)])
    n_hit = covered[w.first[1:]] - covered[w.first[:-1]]
    spans: dict[int, list[dict]] = {}
    items: dict[int, list[int]] = {}
    matches: dict[int, list[dict]] = {}
    if len(at):
        opens, shuts = hit.copy(), hit.copy()
        inner = w.first[(w.first > 0) & (w.first < len(hit))]
        same = np.ones(len(hit), bool)
        same[inner] = False  # a document's first word continues no run
        opens[1:] &= ~(hit[:-1] & same[1:])
        shuts[:-1] &= ~(hit[1:] & same[1:])
        for a, b in zip(np.flatnonzero(opens).tolist(), np.flatnonzero(shuts).tolist()):
            r = int(shard.row[a])
            spans.setdefault(r, []).append({"a": a - int(w.first[r]), "b": b + 1 - int(w.first[r])})
        item = np.searchsorted(tests.first, test, "right") - 1
        for r, i in np.unique(np.stack([shard.row[at], item], 1), axis=0).tolist():
            items.setdefault(r, []).append(i)
        # windows that follow one another on the same diagonal are one longer match
        order = np.lexsort((at, at - test, item))
        a, t, n, i = at[order], test[order], width[order], item[order]
        fresh = np.ones(len(a), bool)
        fresh[1:] = (a[1:] != a[:-1] + 1) | (t[1:] != t[:-1] + 1) | (i[1:] != i[:-1]) | (shard.row[a[1:]] != shard.row[a[:-1]])
        begin = np.flatnonzero(fresh)
        end = np.append(begin[1:], len(a)) - 1
        for b, e in zip(begin.tolist(), end.tolist()):
            r = int(shard.row[a[b]])
            matches.setdefault(r, []).append({"item_id": tests.items[i[b]], "doc_word": int(a[b] - w.first[r]), "item_word": int(t[b] - tests.first[i[b]]), "length": int(a[e] + n[e] - a[b])})
    for found in matches.values():
        found.sort(key=lambda m: tuple(m.values()))
    return np.diff(w.first), n_hit, items, matches, spans


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int, depth: int) -> Iterator[Suffixes]:
    """The benchmark's suffixes in blocks of most block_bytes of text (or one item), read one at a time; one block at least."""
    block, held, built = [], 0, False
    for row in benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).filter("t IS NOT NULL").toLocalIterator():
        n = len(row["t"].encode())
        if block and held + n > block_bytes:
            yield Suffixes.build(block, depth)
            block, held, built = [], 0, True
        block.append((row["i"], row["t"]))
        held += n
    if block or not built:
        yield Suffixes.build(block, depth)


def _union(spans: Column) -> Column:
    """How many words the spans cover together."""
    start = F.struct(F.lit(0).alias("reach"), F.lit(0).alias("total"))
    step = lambda acc, x: F.struct(F.greatest(acc["reach"], x["b"]).alias("reach"), (acc["total"] + F.greatest(F.lit(0), x["b"] - F.greatest(acc["reach"], x["a"]))).alias("total"))
    return F.aggregate(F.array_sort(spans), start, step)["total"]


def _find(docs: DataFrame, tests: Suffixes, depth: int) -> DataFrame:
    """docs (key, text and more) with text replaced by what was found in it."""
    shared = docs.sparkSession.sparkContext.broadcast(tests)
    rest = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*rest, T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("item_ids", T.ArrayType(T.StringType())), T.StructField("matches", T.ArrayType(MATCH)), T.StructField("spans", T.ArrayType(SPAN))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = shared.value
        kind = pa.list_(pa.struct([("item_id", pa.string()), ("doc_word", pa.int32()), ("item_word", pa.int32()), ("length", pa.int32())]))
        runs = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        for batch in batches:
            for s in slices(batch.column("text")):
                n_words, n_hit, items, matches, spans = _judge(s, tests, depth)
                names = [sorted({tests.items[i] for i in items.get(r, ())}) for r in range(s.n)]
                own = [batch.column(f.name).slice(s.first, s.n) for f in rest]
                yield pa.RecordBatch.from_arrays([*own, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array([matches.get(r, []) for r in range(s.n)], kind), pa.array([spans.get(r, []) for r in range(s.n)], runs)], names=schema.names)

    return map_arrow(docs, run, schema)


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """key, n_words, n_hit, item_ids and matches of every row of docs.

    A word is hit if a window of depth consecutive item words that covers it
    occurs in the document; an item of fewer words is one window.  matches holds
    the longest verbatim matches with their places, counted in words.  Null or
    empty texts have no words; null or empty items match nothing.  Items with
    equal ids count once.  Rows are judged one by one, so null, repeated or
    equal keys are no matter, however many blocks the benchmark takes.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    names = [F.col("key").alias(key), "n_words", "n_hit", "item_ids", "matches"]
    blocks = _blocks(benchmark, item, item_text, block_bytes, depth)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return _find(source, first, depth).select(*names)
    numbered = written(source.withColumn("row", F.monotonically_increasing_id()))
    parts = [written(_find(numbered, tests, depth)) for tests in itertools.chain((first, second), blocks)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return (
        out.groupBy("row")
        .agg(
            F.first("key").alias("key"),
            F.max("n_words").alias("n_words"),
            _union(F.flatten(F.collect_list("spans"))).cast("long").alias("n_hit"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
            F.array_sort(F.flatten(F.collect_list("matches"))).alias("matches"),
        )
        .select(*names)
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs, with their columns, in which no benchmark window occurs; rows are judged one by one."""

    def clean(rows: DataFrame, tests: Suffixes) -> DataFrame:
        shared = rows.sparkSession.sparkContext.broadcast(tests)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for s in slices(batch.column(text)):
                    shard = Shard(s, shared.value, depth)
                    hit = np.zeros(s.n, bool)
                    hit[shard.row[shard.checked_hits(s, shared.value, depth)[0]]] = True
                    yield batch.slice(s.first, s.n).filter(pa.array(~hit))

        return map_arrow(rows, run, rows.schema)

    blocks = _blocks(benchmark, item, item_text, block_bytes, depth)
    docs = clean(docs, next(blocks))
    for tests in blocks:
        docs = clean(written(docs), tests)
    return docs
