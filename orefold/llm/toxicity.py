"""Toxicity: votes of the nearest labelled examples by exact TF-IDF cosine.

Examples are a bounded sample of the labelled rows (MAX_EXAMPLES of each class).
Terms are all whole words and word beginnings of the examples' whole texts.  A
term's weight is its frequency in the text times its inverse document frequency
over all documents times its standing: FLOOR for every term, and more by how far the
term tells the classes apart in the sample, as a few words make a long text toxic.
No term is left out.

The examples are held in an inverted index.  The lists of common terms are cut into
blocks of examples with the largest weight of each: rare terms' lists, which are
short, are read in full; the common ones' blocks are read where the bound from
their maxima can still reach the k nearest, so the neighbours are exact.  Votes weighted by
closeness and by what an example stands for are calibrated on leave-one-out votes;
neighbours are given as evidence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm._vec import Slice, Words, byte_codes, prefix61, separators, slices, span61
from orefold.llm.shared import map_arrow

#: Bound of what is learned from: examples of each class.
MAX_EXAMPLES = 1500
NEIGHBOURS = 15
#: The standing of a term that does not tell the classes apart, where that of the best term is 1 more.
FLOOR = 0.02
#: Terms whose lists are kept in blocks, the most common ones; examples of a block.
COMMON = 1024
BLOCK = 64
#: Blocks that are scored before the others are held against the nearest so far.
LEAD = 4
#: Texts that are scored at once.
CHUNK = 16
#: Bytes of the word beginnings that are terms beside the words.
BEGINNINGS = (4, 5, 6)
#: Weight of the vote of documents without evidence.
PRIOR_WEIGHT = 0.05

_CODES = byte_codes(3, True)
_SEPARATORS = separators("alnum")


def fold(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 5


def terms_of(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Term hashes of a slice's words and their rows."""
    prefix = prefix61(_CODES[s.data])
    w = Words(s, _SEPARATORS, _CODES, prefix)
    row = np.repeat(np.arange(s.n), np.diff(w.first))
    hashes, rows = [w.hashes], [row]
    for n in BEGINNINGS:
        longer = w.ends - w.starts > n
        hashes.append(span61(prefix, w.starts[longer], w.starts[longer] + n) ^ np.uint64(n))
        rows.append(row[longer])
    return np.concatenate(hashes), np.concatenate(rows)


class Vocabulary:
    """Sorted term hashes, found through a table of their high bits."""

    BITS = 21

    def __init__(self, terms: np.ndarray) -> None:
        self.terms = terms
        high = (terms >> np.uint64(64 - self.BITS)).astype(np.int64)
        self.first = np.searchsorted(high, np.arange((1 << self.BITS) + 1)).astype(np.int32)
        self.depth = int(np.diff(self.first).max(initial=0))

    def __len__(self) -> int:
        return len(self.terms)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 if it is no term."""
        out = np.full(len(hashes), -1, np.int32)
        if not len(self.terms):
            return out
        at = self.first[(hashes >> np.uint64(64 - self.BITS)).astype(np.int64)]
        for j in range(self.depth):
            spot = np.minimum(at + j, len(self.terms) - 1)
            out = np.where(self.terms[spot] == hashes, spot, out)
        return out

    def known(self, s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, term number and count of each known term of each row, in row order."""
        hashes, rows = terms_of(s)
        at = self.find(hashes)
        hit = at >= 0
        pairs, counts = np.unique(rows[hit] * len(self.terms) + at[hit], return_counts=True)
        return pairs // max(1, len(self.terms)), pairs % max(1, len(self.terms)), counts


@dataclass
class Index:
    """Inverted lists over examples; those of common terms in blocks of BLOCK examples, dense, with the largest weight of each."""

    size: int
    first: np.ndarray  # of each term's list
    posting: np.ndarray
    weight: np.ndarray
    common: np.ndarray  # a term's place among the common ones, or -1
    dense: np.ndarray  # (common term, example, filled up to whole blocks)
    block_max: np.ndarray  # (common term, block)

    @classmethod
    def build(cls, size: int, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_terms: int, most_common: int = COMMON) -> "Index":
        n_blocks = max(1, -(-size // BLOCK))
        held = np.bincount(terms, minlength=n_terms)
        top = np.argsort(-held, kind="stable")[:most_common]
        common = np.full(n_terms, -1, np.int32)
        common[top] = np.arange(len(top))
        dense = np.zeros((len(top), n_blocks * BLOCK), np.float32)
        often = common[terms] >= 0
        dense[common[terms[often]], rows[often]] = weights[often]
        rows, terms, weights = rows[~often], terms[~often], weights[~often]
        order = np.lexsort((rows, terms))
        first = np.searchsorted(terms[order], np.arange(n_terms + 1)).astype(np.int32)
        return cls(size, first, rows[order].astype(np.int32), weights[order].astype(np.float32), common, dense, dense.reshape(len(top), n_blocks, BLOCK).max(2))

    def nearest(self, row: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, k: int, without: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each of n texts the k examples with the largest positive cosines, ties by position; without leaves one out."""
        width = self.dense.shape[1]
        n_blocks = width // BLOCK
        often = self.common[terms] >= 0
        query = np.zeros((n, len(self.dense)), np.float32)
        query[row[often], self.common[terms[often]]] = weights[often]
        row, terms, weights = row[~often], terms[~often], weights[~often]
        begin = self.first[terms]
        m = (self.first[terms + 1] - begin).astype(np.int64)
        at = np.repeat(begin - np.cumsum(m) + m, m) + np.arange(m.sum())
        cells = np.repeat(row * width, m) + self.posting[at]
        rare = np.bincount(cells, np.repeat(weights, m) * self.weight[at], n * width).astype(np.float32).reshape(n, n_blocks, BLOCK)
        bound = rare.max(2) + query @ self.block_max
        scores = np.full((n, n_blocks, BLOCK), -1, np.float32)
        lead = min(LEAD, n_blocks)
        todo = np.zeros((n, n_blocks), bool)
        np.put_along_axis(todo, np.argpartition(-bound, lead - 1, axis=1)[:, :lead], True, axis=1)
        done = np.zeros_like(todo)
        flat = scores.reshape(n, width)
        for _ in range(2):
            for b in np.flatnonzero(todo.any(0)):
                some = np.flatnonzero(todo[:, b])
                scores[some, b] = rare[some, b] + query[some] @ self.dense[:, b * BLOCK : (b + 1) * BLOCK]
            if without is not None:
                flat[np.arange(n), without] = -1
            done |= todo
            least = np.partition(flat, width - k, axis=1)[:, width - k] if k < width else np.full(n, -1, np.float32)
            todo = ~done & (bound > 0) & (bound >= least[:, None] - 1e-5)
        out = []
        for i in range(n):
            where = np.flatnonzero((flat[i, : self.size] > 1e-7) & (flat[i, : self.size] >= least[i]))
            where = where[np.lexsort((where, -flat[i, where]))][:k]
            out.append((where, flat[i, where].astype(np.float64)))
        return out


@dataclass
class Model:
    vocabulary: Vocabulary
    weight: np.ndarray  # of each term: inverse document frequency times standing
    index: Index | None
    silent: float  # the share of label 1
    example_ids: list
    labels: np.ndarray
    stands_for: np.ndarray  # labelled rows for each example
    slope: float = 1.0
    shift: float = 0.0

    def vectors(self, row: np.ndarray, terms: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
        """Weights of the texts' terms, each text's of length 1."""
        x = (1 + np.log(counts)) * self.weight[terms]
        return x / np.maximum(1e-12, np.sqrt(np.bincount(row, x * x, n)))[row]

    def vote(self, where: np.ndarray, cosines: np.ndarray) -> float:
        """The log odds of the neighbours' labels, weighted by closeness, with the silent share as a weak vote."""
        closeness = cosines * cosines * self.stands_for[where]
        share = (float((closeness * self.labels[where]).sum()) + PRIOR_WEIGHT * self.silent) / (float(closeness.sum()) + PRIOR_WEIGHT)
        share = min(max(share, 1e-4), 1 - 1e-4)
        return float(np.log(share / (1 - share)))

    def score(self, where: np.ndarray, cosines: np.ndarray) -> float:
        if not len(where):
            return self.silent
        return float(1 / (1 + np.exp(-(self.slope * self.vote(where, cosines) + self.shift))))

    def neighbours(self, row: np.ndarray, terms: np.ndarray, counts: np.ndarray, n: int, without: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Examples and cosines of each of n texts, given by row, term and count in row order."""
        x = self.vectors(row, terms, counts, n) if n else None
        for first in range(0, n, CHUNK):
            m = min(CHUNK, n - first)
            a, b = np.searchsorted(row, [first, first + m])
            if self.index is None:
                yield from [(np.zeros(0, np.int64), np.zeros(0))] * m
            else:
                yield from self.index.nearest(row[a:b] - first, terms[a:b], x[a:b], m, NEIGHBOURS, None if without is None else without[first : first + m])


def _calibrate(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit of labels to votes, by Newton's method with a weak pull to the identity."""
    beta = np.array([1.0, 0.0])
    x = np.stack([votes, np.ones_like(votes)], 1)
    weights = weights / weights.sum() * len(weights)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weights * (p - labels)) + (beta - [1.0, 0.0])
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta - step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 0.05)), float(beta[1])


def _sample(labels: DataFrame, most: int) -> DataFrame:
    """At most most rows of each label, those with the least hashes of the key."""
    parts = [labels.filter(F.col("y") == y).orderBy(F.xxhash64("k", F.lit(17)), "k").limit(most) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", most: int = MAX_EXAMPLES) -> Model:
    """Learns from texts and labels of rows outside fold 0.

    A key with several labels counts as toxic if one of them is.  Null keys and
    labels are left out.  Without examples of both classes every score is the
    share of label 1, or 0 without labels.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & (fold(F.col(key)) != 0)).groupBy(F.col(key).alias("k")).agg(F.max(F.col(label).cast("int")).alias("y"))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(totals.get(y, 0) for y in (0, 1))
    share = totals.get(1, 0) / total if total else 0.0
    empty = Model(Vocabulary(np.zeros(0, np.uint64)), np.zeros(0), None, share, [], np.zeros(0), np.zeros(0))
    if not totals.get(0) or not totals.get(1):
        return empty

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column("t")):
                hashes, rows = terms_of(s)
                order = np.lexsort((hashes, rows))
                edges = np.searchsorted(rows[order], np.arange(s.n + 1))
                packed, counts = [], []
                for a, b in zip(edges, edges[1:]):
                    u, n = np.unique(hashes[order[a:b]], return_counts=True)
                    packed.append(u.tobytes())
                    counts.append(n.astype(np.int32).tobytes())
                part = batch.slice(s.first, s.n)
                yield pa.RecordBatch.from_arrays([part.column("k"), part.column("y"), pa.array(packed, pa.binary()), pa.array(counts, pa.binary())], names=["k", "y", "terms", "counts"])

    kind = known.schema["k"].dataType
    schema = T.StructType([T.StructField("k", kind), T.StructField("y", T.IntegerType()), T.StructField("terms", T.BinaryType()), T.StructField("counts", T.BinaryType())])
    # the sample has at most 2 x most rows, so it may be broadcast
    chosen = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(_sample(known, most)), "k").select("k", "y", "t")
    rows = sorted(map_arrow(chosen, examples, schema).collect(), key=lambda r: (r["y"], r["k"], r["terms"]))
    if not rows:
        return empty
    y = np.array([r["y"] for r in rows])
    own = [np.frombuffer(r["terms"], np.uint64) for r in rows]
    counts = [np.frombuffer(r["counts"], np.int32) for r in rows]
    flat = np.concatenate(own)
    classes = np.repeat(y, [len(x) for x in own])
    names, inverse = np.unique(flat, return_inverse=True)
    pos = np.bincount(inverse, classes, len(names))
    neg = np.bincount(inverse, 1 - classes, len(names))
    n_pos, n_neg = max(1, y.sum()), max(1, (1 - y).sum())
    n = n_pos + n_neg
    a, b, c, d = pos, neg, n_pos - pos, n_neg - neg
    chi2 = n * (a * d - b * c) ** 2 / np.maximum(1e-9, (a + b) * (c + d) * n_pos * n_neg)
    if not len(names):
        return empty
    vocabulary = Vocabulary(names)
    standing = FLOOR + np.sqrt(chi2 / max(1e-9, float(chi2.max())))
    weight_of = np.array([totals[0] / n_neg, totals[1] / n_pos])
    model = Model(vocabulary, _idf(docs, text, vocabulary) * standing, None, share, [], np.zeros(0), np.zeros(0))
    # examples with the same strongest term stand together, so block maxima are sharp; those without terms have no place
    edges = np.concatenate([[0], np.cumsum([len(x) for x in own])])
    spoken = [i for i in range(len(rows)) if len(own[i])]
    strongest = {i: int(inverse[edges[i] + np.argmax((1 + np.log(counts[i])) * model.weight[inverse[edges[i] : edges[i + 1]]])]) for i in spoken}
    spoken.sort(key=lambda i: (strongest[i], i))
    model.example_ids, model.labels = [rows[i]["k"] for i in spoken], y[spoken].astype(np.float64)
    model.stands_for = weight_of[y[spoken]]
    sizes = [len(own[i]) for i in spoken]
    row, terms, m = np.repeat(np.arange(len(spoken)), sizes), np.concatenate([inverse[edges[i] : edges[i + 1]] for i in spoken]), np.concatenate([counts[i] for i in spoken])
    model.index = Index.build(len(spoken), row, terms, model.vectors(row, terms, m, len(spoken)), len(names))
    votes = [model.vote(*found) for found in model.neighbours(row, terms, m, len(spoken), without=np.arange(len(spoken)))]
    model.slope, model.shift = _calibrate(np.array(votes), model.labels, model.stands_for)
    return model


def _idf(docs: DataFrame, text: str, vocabulary: Vocabulary) -> np.ndarray:
    """Inverse document frequencies of the terms over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        found, n = np.zeros(len(words) + 1, np.int64), 0
        for batch in batches:
            for s in slices(batch.column(0)):
                found[:-1] += np.bincount(words.known(s)[1], minlength=len(words))
                n += s.n
        found[-1] = n
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(found[some], pa.int64())], names=["term", "n"])

    # as many rows to the driver as there are terms
    found = map_arrow(docs.select(text), count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(vocabulary) + 1)
    df[found["term"].to_numpy()] = found["n"].to_numpy()
    return np.log((1 + df[-1]) / (1 + df[:-1])) + 1


EVIDENCE = T.ArrayType(T.StructType([T.StructField("example", T.StringType()), T.StructField("cosine", T.DoubleType()), T.StructField("label", T.IntegerType())]))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score, predicted and evidence: the nearest examples, their cosines and labels.

    Texts without known terms, null or empty ones included, get the share of
    label 1 among such examples, and no evidence.
    """
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("evidence", EVIDENCE)])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("example", pa.string()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = pa.array([str(x) for x in model.example_ids], pa.string())
        labels = pa.array(model.labels.astype(np.int32))
        for batch in batches:
            for s in slices(batch.column(text)):
                found = list(model.neighbours(*model.vocabulary.known(s), s.n))
                scores = np.array([min(max(model.score(*x), 0.0), 1.0) for x in found])
                where = np.concatenate([x[0] for x in found]) if found else np.zeros(0, np.int64)
                offsets = np.concatenate([[0], np.cumsum([len(x[0]) for x in found])]).astype(np.int32)
                cosines = np.concatenate([x[1] for x in found]) if found else np.zeros(0)
                each = pa.StructArray.from_arrays([names.take(pa.array(where)), pa.array(cosines, pa.float64()), labels.take(pa.array(where))], fields=list(kind.value_type))
                yield pa.RecordBatch.from_arrays([batch.column(key).slice(s.first, s.n), pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), each)], names=schema.names)

    return map_arrow(docs.select(key, text), run, schema)
