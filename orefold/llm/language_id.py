"""Language ID: sparse multinomial logistic regression on character n-grams.

Features are TF-IDF weights of hashed character 1- to 3-grams, with document
frequencies from all documents.  Weights are
learned by follow-the-regularised-leader with elastic-net penalties on a bounded
sample of labelled texts, and scores are calibrated by a temperature on texts
held out of that sample.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm.shared import free, map_arrow

#: Bound of what is learned from: texts of each language.
MAX_TEXTS = 800
BUCKETS = 1 << 14
ORDERS = 3
UNKNOWN = "und"

ALPHA, BETA, L1, L2, PASSES = 0.5, 1.0, 0.02, 0.5, 3

_LETTER = re.compile(r"[^\W\d_]")


@functools.cache
def _letters() -> np.ndarray:
    return np.array([_LETTER.match(chr(i)) is not None for i in range(1 << 16)])


def fold(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 5


def counts_of(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Feature numbers and counts of a text's n-grams over letters; None without a letter."""
    if not text or not _LETTER.search(text):
        return None
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _letters()[np.minimum(code, 0xFFFF)] | (code > 0xFFFF)
    code = np.where(letters, code, 32).astype(np.uint32)
    space = code == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    code = np.concatenate([[32], code[keep], [32]]).astype(np.uint32)
    total = np.zeros(ORDERS * BUCKETS, np.int64)
    mixed = np.zeros(len(code), np.uint32)
    for n in range(ORDERS):
        if len(code) <= n:
            break
        mixed = (mixed[: len(code) - n] if n == 0 else mixed[:-1]) * np.uint32(0x85EBCA6B) + code[n:] * np.uint32(0x9E3779B1)
        bucket = (mixed ^ (mixed >> np.uint32(15))) & np.uint32(BUCKETS - 1)
        total[n * BUCKETS : (n + 1) * BUCKETS] = np.bincount(bucket, minlength=BUCKETS)
    found = np.flatnonzero(total)
    return found, total[found]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # (feature, language); most rows are zero
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, counts: np.ndarray, found: np.ndarray) -> np.ndarray:
        x = (1 + np.log(counts)) * self.idf[found]
        return x / max(1e-12, float(np.sqrt((x * x).sum())))

    def logits(self, found: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[found] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its calibrated probability; und and 0 for texts without letters."""
        features = counts_of(text) if self.languages else None
        if features is None:
            return UNKNOWN, 0.0
        found, counts = features
        p = _softmax(self.logits(found, self.vector(counts, found)) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def _train(model: Model, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
    """Proximal FTRL with one accumulator for each weight; the last feature is the bias."""
    n_features, n = model.weights.shape
    z = np.zeros((n_features + 1, n))
    g2 = np.zeros((n_features + 1, n))

    def weights(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        return np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(g2[at])) / ALPHA + L2))

    order = np.random.default_rng(5)
    for _ in range(PASSES):
        for i in order.permutation(len(rows)):
            found, x, y = rows[i]
            at, x = np.append(found, n_features), np.append(x, 1.0)
            w = weights(at)
            p = _softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p[None, :]
            z[at] += g - (np.sqrt(g2[at] + g * g) - np.sqrt(g2[at])) / ALPHA * w
            g2[at] += g * g
    final = weights(np.arange(n_features + 1))
    model.weights, model.bias = final[:-1].astype(np.float32), final[-1].astype(np.float32)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", most: int = MAX_TEXTS) -> Model:
    """Learns from the texts with a language outside fold 0, most of each language.

    The sample takes the rows with the least hashes of key and text.  Without
    such rows nothing is learned and every prediction is und.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.coalesce(fold(F.col(key)) != 0, F.lit(True))).select(F.col(lang).cast("string").alias("l"), F.col(text).alias("t"), F.xxhash64(F.col(key).cast("string"), F.lit(23)).alias("h"))
    totals = known.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()
    languages = sorted(r["l"] for r in totals)
    empty = Model([], np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    if not languages:
        return empty
    # a hash threshold for each language keeps about most rows of it, wherever they are
    share = docs.sparkSession.createDataFrame([(r["l"], min(1.0, 1.2 * most / r["n"])) for r in totals], "l string, share double")
    drawn = (F.shiftrightunsigned("h", 11).cast("double") / float(1 << 53)) < F.col("share")
    drawn_rows = known.join(F.broadcast(share), "l").filter(drawn).select("l", "t", "h").orderBy("h", "t").limit(2 * most * len(languages))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [counts_of(x.as_py()) for x in batch.column("t")]
            kept = pa.array([x is not None for x in own])
            own = [x for x in own if x is not None]
            part = batch.select(["l", "h"]).filter(kept)
            packed = [pa.array([np.asarray(x[j], np.int32).tobytes() for x in own], pa.binary()) for j in (0, 1)]
            yield pa.RecordBatch.from_arrays([*part.columns, *packed], names=["l", "h", "found", "counts"])

    # features come to the driver, not texts; equal hashes are ordered by what was found
    rows = map_arrow(drawn_rows, features, "l string, h long, found binary, counts binary").collect()
    number = {x: i for i, x in enumerate(languages)}
    taken: dict[str, int] = {}
    raw = []
    for r in sorted(rows, key=lambda r: (r["h"], bytes(r["found"]), bytes(r["counts"]))):
        if taken.setdefault(r["l"], 0) < most:
            taken[r["l"]] += 1
            raw.append((np.frombuffer(r["found"], np.int32).astype(np.int64), np.frombuffer(r["counts"], np.int32).astype(np.int64), number[r["l"]]))
    if not raw:
        return empty
    model = Model(languages, _idf(docs, text), np.zeros((ORDERS * BUCKETS, len(languages))), np.zeros(len(languages)))
    rows = [(found, model.vector(counts, found), y) for found, counts, y in raw]
    held = rows[::5] if len(rows) >= 50 else []
    _train(model, [x for i, x in enumerate(rows) if not held or i % 5])
    if held:
        logits = np.stack([model.logits(f, x) for f, x, _ in held])
        target = np.array([y for *_, y in held])

        def loss(t: float) -> float:
            scaled = logits / t
            top = scaled.max(1, keepdims=True)
            return float((np.log(np.exp(scaled - top).sum(1)) + top[:, 0] - scaled[np.arange(len(target)), target]).mean())

        model.temperature = float(min(np.geomspace(0.05, 5, 80), key=loss))
    return model


def _idf(docs: DataFrame, text: str) -> np.ndarray:
    """Inverse document frequencies of the features over all documents with a letter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(ORDERS * BUCKETS + 1, np.int64)
        for batch in batches:
            for x in batch.column(0):
                features = counts_of(x.as_py())
                if features is not None:
                    found[features[0]] += 1
                    found[-1] += 1
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(found[some], pa.int64())], names=["term", "n"])

    # as many rows to the driver as there are features
    rows = map_arrow(docs.select(text), count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(ORDERS * BUCKETS + 1)
    for r in rows:
        df[r["term"]] = r["n"]
    return np.log((1 + df[-1]) / (1 + df[:-1])) + 1


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """docs with the predicted language and its probability from the whole text.

    Texts that are null or hold no letter get und and 0.  Columns named as the
    new ones are replaced; others stay.
    """
    rest = [f for f in docs.schema.fields if f.name not in (lang_pred, score)]
    schema = T.StructType([*rest, T.StructField(lang_pred, T.StringType()), T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                found = [model.predict(x.as_py()) for x in part.column(text)]
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in rest), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=schema.names)

    return map_arrow(docs, run, schema)


def keep_known(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", least: float = 0.5) -> DataFrame:
    """The rows of docs, with their columns, whose language is told with a probability of least or more.

    Where no row has a language to learn from, none can be told, and all rows with a letter stay.
    """
    columns, model = docs.columns, fit(docs, key, text, lang)
    if not model.languages:
        return docs.filter(F.col(text).rlike(r"\p{L}"))
    found, score = free(docs, "__lang_pred"), free(docs, "__score")
    judged = predict(docs, model, key, text, found, score)
    return judged.filter((F.col(found) != UNKNOWN) & (F.col(score) >= least)).select(*columns)
