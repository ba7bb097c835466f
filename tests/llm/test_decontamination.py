"""Against a brute-force search."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from orefold.llm import decontamination
from orefold.llm._vec import slices

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, depth=10):
    windows = {}
    for i, t in items:
        w = lowered(t)
        if w:
            n = min(depth, len(w))
            for k in range(len(w) - n + 1):
                windows.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    widths = {len(w) for w in windows}
    out = {}
    for d, t in docs:
        w, hit, found = lowered(t), set(), set()
        for n in widths:
            for k in range(len(w) - n + 1):
                if names := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= names
        out[d] = len(w), len(hit), sorted(found)
    return out


def test_matches_brute_force_and_edge_cases(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve"
    items = [(1, passage), (2, "Short ITEM"), (3, None), (4, ""), (5, "!!"), (6, "solo"), (7, "a " * 15), (10, passage.upper())]
    docs = [(1, f"zz {passage}. yy short-item"), (2, None), (3, ""), (4, "a " * 30), (5, "SOLO"), (6, passage[:40]), (7, "é " + passage.replace(" ", "\n")), (7, "clean"), (8, "eleven twelve one two")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = sorted((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in decontamination.find(d, b).collect())
    want = sorted((k[0], *brute([k], items)[k[0]]) for k in docs)
    assert found == want
    longest = {(r.doc_id, m.item_id): m for r in decontamination.find(d, b).collect() for m in r.matches}
    assert (longest[1, "1"].doc_word, longest[1, "1"].item_word, longest[1, "1"].length) == (1, 0, 12)
    assert (longest[1, "2"].doc_word, longest[1, "2"].length) == (14, 2)
    # a row for each row, whatever the blocks: key 7 stands twice, and null keys do too
    more = spark.createDataFrame([*docs, (None, passage), (None, "clean"), (7, "clean")], "doc_id long, text string")
    whole, blocks = (sorted(map(str, decontamination.find(more, b, block_bytes=n).collect())) for n in (1 << 20, 10))
    assert whole == blocks and len(whole) == len(docs) + 3
    for n in (1 << 20, 10):
        kept = decontamination.decontaminate(more, b, block_bytes=n)
        assert kept.columns == d.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "6", "7", "7", "8", "None"]


def test_structured_words_and_equal_hashes_do_not_hit(spark, monkeypatch):
    a = "a"
    for _ in range(11):
        a += a.translate(str.maketrans("ab", "ba"))
    other = a.translate(str.maketrans("ab", "ba"))
    items = spark.createDataFrame([(1, f"p q r s {a}")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"p q r s {a}"), (2, f"p q r s {other}")], "doc_id long, text string")
    assert {r.doc_id: r.n_hit for r in decontamination.find(docs, items).collect()} == {1: 5, 2: 0}
    # words whose hashes are equal are told apart by their bytes
    s = next(slices(pa.array(["one two abc", "one two xyz three", "one two abc"])))
    tests = decontamination.Suffixes.build([(1, "one two abc")])
    same = np.sort(tests.hashes).copy()
    real = decontamination.Words

    class Equal(real):
        def __init__(self, *args):
            super().__init__(*args)
            self.hashes[5] = self.hashes[2]  # xyz gets the hash of abc

    monkeypatch.setattr(decontamination, "Words", Equal)
    assert (np.sort(tests.hashes) == same).all()
    n_words, n_hit, items, *_ = decontamination._judge(s, tests, 10)
    assert n_words.tolist() == [3, 4, 3] and n_hit.tolist() == [3, 0, 3] and sorted(items) == [0, 2]


def longest(doc, item, depth=10):
    """All maximal runs of equal words of one window at least, as (doc word, item word, length)."""
    w, v, out = lowered(doc), lowered(item), set()
    n = min(depth, len(v))
    for i in range(len(w)):
        for j in range(len(v)):
            if w[i] == v[j] and not (i and j and w[i - 1] == v[j - 1]):
                k = 0
                while i + k < len(w) and j + k < len(v) and w[i + k] == v[j + k]:
                    k += 1
                if k >= n:
                    out.add((i, j, k))
    return out


def test_longest_matches_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    items = {str(r.item_id): r.text for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()}
    found = decontamination.find(spark.createDataFrame(docs), spark.createDataFrame([(k, v) for k, v in items.items()], "item_id string, text string")).collect()
    texts, told = {r.doc_id: r.text for r in docs}, 0
    for r in found:
        own = {(m.item_id, m.doc_word, m.item_word, m.length) for m in r.matches}
        assert own == {(i, *m) for i in r.item_ids for m in longest(texts[r.doc_id], items[i])}
        told += len(own)
    assert told


def test_long_texts_ties_and_clashing_columns(spark):
    items = spark.createDataFrame([(i, "tie tie tie") for i in range(3)] + [(9, " ".join(f"w{i}" for i in range(40)))], "item_id long, text string")
    long = " ".join(f"v{i % 977}" for i in range(300_000)) + " " + " ".join(f"w{i}" for i in range(5, 30))
    rows = [(1, long, 1, "a"), (2, "tie tie tie tie", 2, "b"), (3, None, 3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_hit int, row string")
    found = {r.doc_id: r for r in decontamination.find(docs, items).collect()}
    assert (found[1].n_words, found[1].n_hit, found[1].item_ids) == (300_025, 25, ["9"]) and found[1].matches[0].length == 25
    assert (found[2].n_hit, found[2].item_ids) == (4, ["0", "1", "2"]) and found[3].n_words == 0
    kept = decontamination.decontaminate(docs, items)
    assert kept.columns == docs.columns and [r.n_hit for r in kept.collect()] == [3]


def test_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.find(d, b).count() == 0
    one = spark.createDataFrame([(1, "x y")], "doc_id long, text string")
    assert decontamination.find(one, b).collect()[0].n_hit == 0


@pytest.mark.parametrize("depth", [3, 10])
def test_generated_documents(spark, depth):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([tuple(r) for r in docs.collect()], [tuple(r) for r in items.select("item_id", "text").collect()], depth)
    got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in decontamination.find(docs, items, depth=depth).collect()}
    assert got == want and any(x[1] for x in want.values())
