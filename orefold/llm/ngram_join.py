"""N-gram Jaccard join: exact set-similarity self-join with set-relation skipping.

A document's set holds its distinct word shingles.  Equal sets are one node.
Nodes are joined by a prefix index: in a global order of shingles, rare ones
first, two sets at the threshold share a shingle among their first ones.

Skipping works at two levels.  Index level: lists are kept in the order of set
sizes with each entry's position, and an entry leaves its list, with all that
follow, as soon as sizes or its position rule out the overlap; bitmaps rule out
most other pairs before any set is read.  Answer level: each set first meets, of
the candidates named before it, the one most similar by their bitmaps; the answers
of a set it is linked to are its own for the purpose of groups, so pairs inside
one group are never compared, only those between groups are.

Shingles in more sets than HOT are put last in the order; lists of such
shingles are not paired out but answered through a leading set.  Where that leaves
several groups in a list, its sets are dealt by size, as linked sets lie in one
size class or in neighbouring ones, and compared across groups where sizes, bitmaps
and the rare shingles that each has before its hot ones allow a link.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.llm._vec import Slice, Words, byte_codes, gram_hashes, mix64, separators, slices, span61
from orefold.llm.components import components
from orefold.llm.shared import dropped, free, map_arrow, partitions, written

WIDTH = 5
PERCENT = 75
#: Sets that hold a shingle before it counts as hot, and bytes of hot shingles that are broadcast at most.
HOT = 8
HOT_BYTES = 32 << 20
#: Candidate documents are found by broadcast ids up to this many bytes, by a shuffled join beyond.
IDS_BYTES = 64 << 20
LANES = 16
#: Entries that a task packs at once.
PACK = 400_000

_CODES = byte_codes(1, True)
_SEPARATORS = separators("space")


@dataclass(frozen=True)
class Threshold:
    """Links need 100 * intersection >= percent * union."""

    percent: int = PERCENT
    width: int = WIDTH

    def prefix(self, n: int) -> int:
        """Entries of a set of n shingles of which a linked set shares one."""
        return n - -(-self.percent * n // 100) + 1

    def fits(self, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        return 100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)

    def overlap(self, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """The least intersection of linked sets of n and m."""
        return -(-self.percent * (n + m) // (100 + self.percent))


def sets_of(s: Slice, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row; short texts have one, of all their words; empty ones none."""
    w = Words(s, _SEPARATORS, _CODES)
    grams, _ = gram_hashes(w, width)
    prefix = w.sequence()
    out = []
    for a, b in zip(w.first.tolist(), w.first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(grams[a : b - width + 1]))
        elif b > a:
            out.append(span61(prefix, np.array([a]), np.array([b])) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(u: np.ndarray) -> int:
    """A node's 64-bit name, as a signed number; 0 for the empty set."""
    return int((mix64(u).sum(dtype=np.uint64) ^ mix64(u ^ np.uint64(len(u))).sum(dtype=np.uint64)).astype(np.int64)) if len(u) else 0


def lanes(u: np.ndarray) -> np.ndarray:
    """A bitmap of LANES words: bit i is the parity of the shingles that fall on i, so two bitmaps differ in no more bits than their sets in members."""
    bits = (np.bincount((u >> np.uint64(40)).astype(np.int64) % (64 * LANES), minlength=64 * LANES) & 1).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def _nodes(docs: DataFrame, t: Threshold) -> DataFrame:
    """key, uid, node, n and the bitmap of every row."""
    names = ["key", "uid", "node", "n", *(f"b{i}" for i in range(LANES))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column("text")):
                found = sets_of(s, t.width)
                bits = np.array([lanes(u) for u in found]).reshape(s.n, LANES)
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(s.first, s.n), batch.column("uid").slice(s.first, s.n), pa.array([digest(u) for u in found], pa.int64()), pa.array([len(u) for u in found], pa.int64()), *(pa.array(bits[:, i]) for i in range(LANES))], names=names)

    kind = docs.schema["key"].dataType.simpleString()
    return map_arrow(docs, run, f"key {kind}, uid long, node long, n long, " + ", ".join(f"b{i} long" for i in range(LANES)))


def _fresh(found: list[np.ndarray], seen: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Nodes and sets that the task has not met."""
    for u in found:
        if len(u):
            h = digest(u)
            if h not in seen:
                seen.add(h)
                yield h, u


def _dealt(rows: DataFrame, n: int) -> DataFrame:
    return rows.repartitionById(n, F.col("part"))


def _part(tokens: np.ndarray, n: int) -> np.ndarray:
    """Parts of even size, in the order of scrambled hashes, as prefixes hold small ones."""
    return ((mix64(tokens) >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def _short(tokens: np.ndarray, n: int) -> np.ndarray:
    """A shingle's part and the low half of its hash: enough to tell how frequent it is."""
    return (_part(tokens, n) << np.uint64(32)) | (tokens & np.uint64(0xFFFFFFFF))


def _hot(docs: DataFrame, t: Threshold, n_parts: int) -> np.ndarray:
    """Short names of the shingles in more than HOT sets, rarest first; the most frequent ones if they exceed HOT_BYTES.

    All shingles of all sets are counted.  Any choice keeps the join exact;
    this one keeps its lists short.
    """

    def pack(tokens: list[np.ndarray]) -> pa.RecordBatch:
        flat = np.sort(_short(np.concatenate(tokens), n_parts))
        edges = np.searchsorted(flat, np.arange(n_parts + 1).astype(np.uint64) << np.uint64(32))
        some, low = np.flatnonzero(np.diff(edges)), flat.astype(np.uint32)
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([low[edges[i] : edges[i + 1]].tobytes() for i in some], pa.binary())], names=["part", "tokens"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        tokens: list[np.ndarray] = []
        for batch in batches:
            for s in slices(batch.column("text")):
                tokens += [u for _, u in _fresh(sets_of(s, t.width), seen)]
                if sum(map(len, tokens)) > PACK:
                    yield pack(tokens)
                    tokens = []
        if tokens:
            yield pack(tokens)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, parts = 0, []
        for batch in batches:
            for p, x in zip(batch.column("part"), batch.column("tokens")):
                part = p.as_py()  # all rows of a partition have one
                parts.append(np.frombuffer(x.as_py(), np.uint32))
        if parts:
            tokens, n = np.unique(np.concatenate(parts), return_counts=True)
            much = n > HOT
            yield pa.RecordBatch.from_arrays([pa.array(tokens[much].astype(np.int64) | (part << 32)), pa.array(n[much], pa.int64())], names=["token", "n"])

    dealt = _dealt(map_arrow(docs, deal, "part int, tokens binary"), n_parts)
    found = map_arrow(dealt, count, "token long, n long").orderBy(F.desc("n"), "token").limit(HOT_BYTES // 8).toArrow()
    return found["token"].to_numpy().astype(np.uint64)[::-1]


def _entries(docs: DataFrame, t: Threshold, hot: np.ndarray, n_parts: int) -> DataFrame:
    """Prefix entries, packed by part: cold lists in part 0 to n_parts - 1; hot entries as rows of part -1."""
    order = np.argsort(hot)
    ranked = hot[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held = _Held()
        for batch in batches:
            for s in slices(batch.column("text")):
                warm: list[tuple] = []
                for h, u in _fresh(sets_of(s, t.width), seen):
                    most = t.prefix(len(u))
                    if len(ranked):
                        names = _short(u, n_parts)
                        at = np.minimum(np.searchsorted(ranked, names), len(ranked) - 1)
                        is_hot = ranked[at] == names
                    else:
                        is_hot = np.zeros(len(u), bool)
                    first = u[~is_hot][:most]
                    held.add(h, len(u), first)
                    if len(first) < most:
                        rest, rank = u[is_hot], order[at[is_hot]]
                        pick = np.argsort(rank)[: most - len(first)]
                        warm += [(int(x), h, len(u), len(first)) for x in rest[pick].astype(np.int64)]
                    if held.entries > PACK or len(held.nodes) == 65535:
                        yield held.pack(n_parts)
                        held = _Held()
                if warm:
                    c = list(zip(*warm))
                    yield pa.RecordBatch.from_arrays([pa.nulls(len(warm), pa.int32()).fill_null(-1), pa.nulls(len(warm), pa.binary()), *(pa.array(x, pa.int64()) for x in c)], names=["part", "packed", "token", "node", "n", "cold"])
        if held.nodes:
            yield held.pack(n_parts)

    return map_arrow(docs, run, "part int, packed binary, token long, node long, n long, cold long")


class _Held:
    """Cold entries of some nodes, until they are packed by part."""

    def __init__(self) -> None:
        self.cold: list[np.ndarray] = []
        self.nodes: list[int] = []
        self.sizes: list[int] = []
        self.entries = 0

    def add(self, node: int, size: int, first: np.ndarray) -> None:
        self.cold.append(first)
        self.nodes.append(node)
        self.sizes.append(size)
        self.entries += len(first)

    def pack(self, n_parts: int) -> pa.RecordBatch:
        counts = [len(x) for x in self.cold]
        tokens = np.concatenate(self.cold)
        owner = np.repeat(np.arange(len(counts)), counts).astype(np.uint16)
        place = np.minimum(np.concatenate([np.arange(n) for n in counts]), 65535).astype(np.uint16)
        parts = _part(tokens, n_parts)
        order = np.argsort(parts, kind="stable")
        parts, tokens, owner, place = parts[order], tokens[order], owner[order], place[order]
        names, n = np.array(self.nodes, np.int64), np.array(self.sizes, np.int32)
        edges = np.searchsorted(parts, np.arange(n_parts + 1).astype(np.uint64))
        some, packed = np.flatnonzero(np.diff(edges)), []
        for i in some:
            a, b = edges[i], edges[i + 1]
            used, at = np.unique(owner[a:b], return_inverse=True)
            head = np.array([b - a, len(used)], np.int64)
            packed.append(b"".join(x.tobytes() for x in (head, tokens[a:b], names[used], n[used], at.astype(np.uint16), place[a:b])))
        empty = pa.nulls(len(some), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(packed, pa.binary()), empty, empty, empty, empty], names=["part", "packed", "token", "node", "n", "cold"])


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    m, k = np.frombuffer(blob, np.int64, 2)
    o = 16
    tokens = np.frombuffer(blob, np.uint64, m, o)
    o += 8 * m
    names = np.frombuffer(blob, np.int64, k, o)
    o += 8 * k
    sizes = np.frombuffer(blob, np.int32, k, o)
    o += 4 * k
    at = np.frombuffer(blob, np.uint16, m, o)
    place = np.frombuffer(blob, np.uint16, m, o + 2 * m)
    return tokens, names[at], sizes[at], place


def _list_pairs(t: Threshold, tokens: np.ndarray, node: np.ndarray, size: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Pairs of nodes that share a list and whose sizes and positions allow a link."""
    order = np.lexsort((node, size, tokens))
    tokens, node, size, place = tokens[order], node[order], size[order].astype(np.int64), place[order].astype(np.int64)
    same = np.zeros(len(tokens), bool)
    same[1:] = (tokens[1:] == tokens[:-1]) & (node[1:] == node[:-1])  # the node from another task
    tokens, node, size, place = tokens[~same], node[~same], size[~same], place[~same]
    begin = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
    length = np.diff(np.append(begin, len(tokens)))
    end = np.repeat(begin + length, length)
    alive = np.flatnonzero(np.repeat(length, length) > 1)
    out, step = [], 1
    # entry i meets entry i + step while sizes and its own position allow it: both only get worse, so the rest of the list is skipped
    while len(alive):
        alive = alive[alive + step < end[alive]]
        other = alive + step
        n, m = size[alive], size[other]
        near = (100 * n >= t.percent * m) & (n - place[alive] >= t.overlap(n, m))
        alive, other = alive[near], other[near]
        n, m = size[alive], size[other]
        left = np.minimum(n - place[alive], m - place[other])
        ok = left >= t.overlap(n, m)
        a, b = node[alive[ok]], node[other[ok]]
        out.append(np.stack([np.minimum(a, b), np.maximum(a, b)], 1))
        step += 1
    pairs = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
    return np.unique(pairs, axis=0) if len(pairs) else pairs


def _cold_pairs(entries: DataFrame, t: Threshold, n_parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_unpack(x.as_py()) for batch in batches for x in batch.column("packed")]
        if not parts:
            return
        pairs = _list_pairs(t, *(np.concatenate(x) for x in zip(*parts)))
        for first in range(0, len(pairs), 100_000):
            some = pairs[first : first + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some[:, 0]), pa.array(some[:, 1])], names=["a", "b"])

    return map_arrow(_dealt(entries.filter("part >= 0").select("part", "packed"), n_parts), run, "a long, b long")


def _differing(left: str, right: str) -> Column:
    total = F.lit(0)
    for i in range(LANES):
        total = total + F.bit_count(F.col(f"{left}.b{i}").bitwiseXOR(F.col(f"{right}.b{i}")))
    return total


def _may_link(left: str, right: str, t: Threshold) -> Column:
    """What sizes and bitmaps allow: linked sets differ in n + m - 2 * overlap members at most."""
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    overlap = F.ceil(F.lit(t.percent) * (n + m) / F.lit(100 + t.percent))
    return (100 * F.least(n, m) >= t.percent * F.greatest(n, m)) & (_differing(left, right) <= n + m - 2 * overlap)


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, t: Threshold) -> DataFrame:
    """The pairs (a, b) whose sets are linked, written; sets are read from one document of each node."""
    needed = written(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())
    keys = written(nodes.join(needed, "node").groupBy("node").agg(F.min("key").alias("key")).select("key"))
    small = keys.count() * 16 <= IDS_BYTES
    chosen = docs.join(F.broadcast(keys) if small else keys, "key", "left_semi")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column("text")):
                found = [u for u in sets_of(s, t.width) if len(u)]
                yield pa.RecordBatch.from_arrays([pa.array([digest(u) for u in found], pa.int64()), pa.array([u.tobytes() for u in found], pa.binary())], names=["node", "members"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                u, v = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = np.concatenate([u, v])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= t.percent * (len(u) + len(v) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    members = map_arrow(chosen, read, "node long, members binary")
    joined = pairs.join(members.select(F.col("node").alias("a"), F.col("members").alias("x")), "a").join(members.select(F.col("node").alias("b"), F.col("members").alias("y")), "b")
    out = written(map_arrow(joined.select("a", "b", "x", "y"), compare, "a long, b long").distinct())
    dropped(needed, keys)
    return out


def _labelled(rows: DataFrame, labels: DataFrame, node: str, label: str) -> DataFrame:
    own = labels.select(F.col("node").alias(node), F.col("label").alias("__label"))
    return rows.join(own, node, "left").withColumn(label, F.coalesce("__label", F.col(node))).drop("__label")


def _between(graded: DataFrame, t: Threshold) -> DataFrame:
    """Pairs of nodes of one open list and of different groups that may be linked.

    If their first shared shingle is hot, neither has the other's rare ones, so
    those count for no overlap.
    """
    l, r = graded.withColumn("grade", F.col("own")).alias("l"), graded.withColumn("grade", F.explode(F.array("own", F.col("own") + 1))).alias("r")
    n, m = F.col("l.n"), F.col("r.n")
    rest = (100 + t.percent) * F.least(n - F.col("l.cold"), m - F.col("r.cold")) >= t.percent * (n + m)
    once = (F.col("l.own") > F.col("r.own")) | ((F.col("l.own") == F.col("r.own")) & (F.col("l.node") < F.col("r.node")))
    # a pair that shares several open lists is met in the first of them only
    first_met = ~F.arrays_overlap("l.before", "r.before")
    met = l.join(r, (F.col("l.token") == F.col("r.token")) & (F.col("l.grade") == F.col("r.grade")) & once & (F.col("l.label") != F.col("r.label")) & rest & _may_link("l", "r", t) & first_met)
    return met.select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b"))


def _grouped(docs: DataFrame, key: str, text: str, t: Threshold) -> DataFrame:
    """key, uid, n and component_id of every row."""
    spark = docs.sparkSession
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.col(key), F.col(text)).alias("uid"))
    n_parts = partitions(spark)
    nodes = written(_nodes(source, t))
    full = nodes.filter("n > 0")
    # one row for each node; equal sets agree in all but the key
    least = written(full.groupBy("node").agg(F.min("key").alias("key"), *(F.first(c).alias(c) for c in ("n", *(f"b{i}" for i in range(LANES))))))
    shape = least.drop("key")
    entries = written(_entries(source, t, _hot(source, t, n_parts), n_parts))
    # hot entries carry their sets' bitmaps, so pairs with a leading set need no join by its name
    hot = written(entries.filter("part = -1").select("token", "node", "cold").distinct().join(shape, "node"))
    # hot lists: the sets with the fewest rare shingles and with the least name lead
    leads = hot.groupBy("token").agg(F.min(F.struct("cold", "node")).alias("x"), F.min("node").alias("y"))
    # written, so that both sides of the joins on hot shingles can be split
    leads = written(leads.select("token", F.explode(F.array_distinct(F.array("x.node", "y"))).alias("node")).join(shape, "node"))
    gap = _differing("l", "r").alias("gap")
    ends = (F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b"), gap)
    led = hot.alias("l").join(leads.alias("r"), F.col("l.token") == F.col("r.token")).filter(F.col("l.node") != F.col("r.node")).filter(_may_link("l", "r", t)).select(*ends)
    cold = _cold_pairs(entries, t, n_parts).distinct()
    cold = cold.join(shape.alias("l"), F.col("a") == F.col("l.node")).join(shape.alias("r"), F.col("b") == F.col("r.node")).filter(_may_link("l", "r", t)).select(*ends)
    pairs = written(cold.unionByName(led).distinct())
    dropped(entries, leads)
    # first each set with the most similar partner of those named before it, then whatever lies between the groups found
    first = written(pairs.groupBy("b").agg(F.min(F.struct("gap", "a")).alias("best")).select("best.a", "b"))
    links = _verified(source, full, first, t)
    labels = written(components(links))
    rest = _labelled(_labelled(pairs.select("a", "b"), labels, "a", "la"), labels, "b", "lb").filter("la <> lb").select("a", "b")
    split = _labelled(hot, labels, "node", "label")
    open_lists = written(split.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("token"))
    still = written(split.join(open_lists, "token"))
    held = still.groupBy("node").agg(F.collect_set("token").alias("tokens"))
    before = F.filter("tokens", lambda x: x < F.col("token"))
    grade = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / t.percent)) + F.lit(1e-9)).cast("int")
    wide = written(still.join(held, "node").withColumn("before", before).withColumn("own", grade).drop("tokens"))
    rest = written(rest.unionByName(_between(wide, t)).distinct().join(first, ["a", "b"], "left_anti"))
    dropped(hot, open_lists, still, wide, pairs, first)
    if not rest.isEmpty():
        labels = written(components(links.unionByName(_verified(source, full, rest, t))))
    named = _labelled(least.select("node", "key"), labels, "node", "label")
    best = named.groupBy("label").agg(F.min("key").alias("component_id"))
    of_node = written(named.join(best, "label").select("node", "component_id"))
    out = nodes.select("key", "uid", "node", "n").join(of_node, "node", "left")
    return out.select("key", "uid", "n", F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("component_id")).alias("component_id"))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: Threshold = Threshold()) -> DataFrame:
    """key, n_shingles and component_id, the least key that links reach, for every row of docs.

    Null or empty texts have no shingles and are linked with nothing.  Rows with
    equal texts are linked; so are rows with equal keys only if their sets are.
    Rows with a null key link nothing and have a null component_id unless a row of
    an equal set has a key.
    """
    return _grouped(docs, key, text, threshold).select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: Threshold = Threshold()) -> DataFrame:
    """The rows of docs, with their columns, that have the least key of their group; rows of null keys stay.

    Rows are told apart by key and text: of rows with one key, those go whose
    own set is linked to a smaller key.  Rows that agree in both stay or go together.
    """
    uid = free(docs, "__uid")
    gone = _grouped(docs, key, text, threshold).filter(F.col("component_id") != F.col("key")).select(F.col("uid").alias(uid)).distinct()
    return docs.join(gone, F.xxhash64(F.col(key), F.col(text)) == F.col(uid), "left_anti")
