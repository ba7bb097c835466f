"""Exact neighbours, held-out accuracy, and edge cases."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from orefold.llm import queries, toxicity


@pytest.mark.parametrize("common", [0, 8, 60])
def test_block_maxima_find_the_exact_neighbours(common):
    rng = np.random.default_rng(3)
    n, terms = 700, 60
    dense = rng.random((n, terms)) * (rng.random((n, terms)) < 0.08)
    dense[300:305] = dense[299]  # ties
    dense /= np.maximum(1e-12, np.linalg.norm(dense, axis=1, keepdims=True))
    rows, cols = np.nonzero(dense)
    index = toxicity.Index.build(n, rows, cols, dense[rows, cols], terms, common)
    q = rng.random((60, terms)) * (rng.random((60, terms)) < 0.15)
    q[0], q[1] = dense[299], 0
    row, at = np.nonzero(q)
    without = rng.integers(0, n, 60)
    for left in (None, without):
        for i, (where, cosines) in enumerate(index.nearest(row, at, q[row, at], 60, 10, left)):
            want = dense @ q[i]
            if left is not None:
                want[left[i]] = 0
            best = np.lexsort((np.arange(n), -want))[:10]
            best = best[want[best] > 0]
            assert np.allclose(want[where], want[best], atol=1e-6) and np.allclose(cosines, want[best], atol=1e-6)
    assert index.nearest(row, at, q[row, at], 60, 6)[0][0].tolist()[:6] == [299, 300, 301, 302, 303, 304]


def test_the_whole_query_against_brute_force(spark):
    """Terms, weights, cosines, votes and scores, re-computed text by text with dictionaries."""
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.toxic is not None}

    def terms(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        out = Counter(("w", w.encode()) for w in words)
        out.update((n, w.encode()[:n]) for w in words for n in (4, 5, 6) if len(w.encode()) > n)
        return out

    bags = {d: terms(t) for d, t in docs}
    known = {d: y for d, y in labels.items() if zlib.crc32(str(d).encode()) % 5}
    examples = sorted(d for d in known if d in bags and bags[d])
    df = Counter(t for b in bags.values() for t in b)
    held = {y: Counter(t for d in known if d in bags and known[d] == y for t in bags[d]) for y in (0, 1)}
    n_pos, n_neg = (sum(known[d] == y for d in known if d in bags) for y in (1, 0))
    chi2 = {}
    for t in set().union(*(bags[d] for d in examples)):
        a, b = held[1][t], held[0][t]
        c, e = n_pos - a, n_neg - b
        chi2[t] = (n_pos + n_neg) * (a * e - b * c) ** 2 / max(1e-9, (a + b) * (c + e) * n_pos * n_neg)
    top = max(chi2.values())
    weight = {t: (math.log((1 + len(docs)) / (1 + df[t])) + 1) * (toxicity.FLOOR + math.sqrt(x / top)) for t, x in chi2.items()}

    def vector(bag):
        v = {t: (1 + math.log(n)) * weight[t] for t, n in bag.items() if t in weight}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}

    vectors = {d: vector(bags[d]) for d in examples}
    out = {r.doc_id: r for r in queries.op3_toxicity(spark, sf).collect()}
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"))
    assert len(out) == len(docs) and any(out[d].evidence for d, _ in docs)
    for d, _ in docs:
        v = vector(bags[d])
        cosines = {e: sum(x * vectors[e].get(t, 0) for t, x in v.items()) for e in examples}
        best = sorted((x for x in cosines.values() if x > 1e-6), reverse=True)[: toxicity.NEIGHBOURS]
        got = [cosines[int(e)] for e in out[d].evidence]
        assert np.allclose(got, best, atol=1e-5) and bool(out[d].evidence) == bool(v)
        near = [(cosines[int(e)], known[int(e)], (n_pos if known[int(e)] else n_neg)) for e in out[d].evidence]
        share = sum(c * c * y for c, y, _ in near) + toxicity.PRIOR_WEIGHT * model.silent  # all labelled rows are examples here, so each stands for one
        share = min(max(share / (sum(c * c for c, *_ in near) + toxicity.PRIOR_WEIGHT), 1e-4), 1 - 1e-4)
        want = 1 / (1 + math.exp(-(model.slope * math.log(share / (1 - share)) + model.shift))) if near else model.silent
        assert abs(out[d].score - want) < 1e-3 and out[d].predicted == (out[d].score >= 0.5)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = queries.op3_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = out.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    hit = sum(r.predicted == r.toxic for r in rows) / len(rows)
    recall = sum(r.predicted for r in rows if r.toxic) / max(1, sum(r.toxic for r in rows))
    assert hit > 0.95 and recall >= 0.9
    assert out.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_empty_labels_and_odd_texts(spark):
    docs = spark.createDataFrame([(i, t, "e") for i, t in enumerate([None, "", "!!!", "word " * 5000, "plain"])], "doc_id long, text string, evidence string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.fit(docs, none)).collect()
    assert [(r.score, r.predicted, r.evidence) for r in out] == [(0.0, 0, [])] * 5
    half = spark.createDataFrame([(i, 1) for i in range(5)] + [(1, None), (None, 1)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.score(docs, toxicity.fit(docs, half)).collect()} == {1}
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, none)).count() == 0


def test_rare_toxic_words_count_and_every_example_is_indexed(spark):
    rng = np.random.default_rng(4)
    plain = [f"plain{i}" for i in range(30)]
    text = lambda *more: " ".join([*rng.choice(plain, 6), *more])
    rows = [(i, text(), 0) for i in range(400)] + [(400 + i, text(f"{chr(97 + i % 10) * 3}vile"), 1) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = docs.select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    used = labels.where(toxicity.fold(toxicity.F.col("doc_id")) != 0).count()
    assert model.index is not None and len(model.example_ids) == used
    new = spark.createDataFrame([(i, text(f"{chr(97 + i) * 3}vile")) for i in range(10)], "doc_id long, text string")
    out = toxicity.score(new, model).collect()
    assert all(r.predicted == 1 and r.evidence for r in out)


def test_every_document_that_shares_a_term_has_evidence(spark):
    docs = spark.createDataFrame([(i, f"word{i} other{i}", i % 2) for i in range(50)], "doc_id long, text string, toxic int")
    labels = docs.select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    assert len(model.example_ids) == labels.where(toxicity.fold(toxicity.F.col("doc_id")) != 0).count()
    new = spark.createDataFrame([(1, f"alpha {docs.first().text}"), (2, "nothing known"), (3, None)], "doc_id long, text string")
    assert {r.doc_id: bool(r.evidence) for r in toxicity.score(new, model).collect()}[3] is False


def test_ties_repeated_rows_and_long_texts(spark):
    rows = [(i, "same words here" if i < 40 else f"bad{i % 3} words", int(i >= 40)) for i in range(80)]
    docs = spark.createDataFrame([*rows, rows[0], (90, "same " * 200_000, 0)], "doc_id long, text string, toxic int")
    model = toxicity.fit(docs, docs.select("doc_id", "toxic"))
    out = toxicity.score(docs, model).collect()
    assert len(out) == 82 and {r.predicted for r in out if r.doc_id < 40} == {0} and {r.predicted for r in out if 40 <= r.doc_id < 80} == {1}
    assert len({r.score for r in out if r.doc_id == 0}) == 1
