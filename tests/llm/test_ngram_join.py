"""Against brute force over all pairs."""

from __future__ import annotations

import random
import re

import pytest
from orefold.llm import ngram_join


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs):
    sets = [(d, shingles(t)) for d, t in docs]
    parent = {d: d for d, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for d, s in sets:
        for g in s:
            holders.setdefault(g, []).append(d)
    own = dict(sets)
    pairs = {(a, b) for ds in holders.values() for i, a in enumerate(ds) for b in ds[i + 1 :]}
    for a, b in pairs:
        x, y = own[a], own[b]
        if 100 * len(x & y) >= 75 * len(x | y):
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {d: (len(s), find(d)) for d, s in sets}


def check(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.groups(df).collect()}
    want = brute(docs)
    assert {k: (got.get(k), v) for k, v in want.items() if got.get(k) != v} == {}
    return want


def test_generated_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    want = check(spark, docs)
    assert any(c != d for d, (_, c) in want.items())


@pytest.mark.parametrize("seed", [1, 2])
def test_hot_groups_and_chains(spark, seed):
    random.seed(seed)
    word = lambda: random.choice("abcdefghij") + str(random.randrange(500))
    base, passage = [word() for _ in range(80)], [word() for _ in range(30)]
    docs = []
    for i in range(90):  # near copies at all distances, more than HOT of them
        w = list(base)
        for _ in range(random.choice([0, 1, 2, 3, 5, 8])):
            w[random.randrange(len(w))] = word()
        docs.append((i, " ".join(w)))
    for i in range(90, 150):  # unrelated texts with one passage
        docs.append((i, " ".join([word() for _ in range(random.randrange(3, 40))] + passage)))
    chain = [word() for _ in range(60)]
    for i in range(150, 175):  # each linked to the next only
        chain = chain[3:] + [word() for _ in range(3)]
        docs.append((i, " ".join(chain)))
    docs += [(200, None), (201, ""), (202, " \n "), (203, "One two"), (204, "one TWO"), (205, "one two three"), (206, docs[0][1]), (207, "é " * 9)]
    random.shuffle(docs)
    check(spark, docs)


def test_empty_null_keys_and_keep_one(spark):
    schema = "doc_id long, text string, n long, node string"
    assert ngram_join.groups(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "a b c d e f", 1, "x"), (2, "A b c d e f", 2, "y"), (3, None, 3, "z"), (None, "q w e r t y", 4, "v"), (5, "", 5, None)]
    kept = ngram_join.keep_one(spark.createDataFrame(rows, schema))
    assert kept.columns == ["doc_id", "text", "n", "node"]
    assert sorted(r.n for r in kept.collect()) == [1, 3, 4, 5]
    # rows of one key are told apart by their texts; whole repeats stay or go together
    twice = [(1, "a b c d e f", 1, ""), (2, "a b c d e F", 2, ""), (2, "other words of the second row here", 3, ""), (2, "a b c d e F", 4, ""), (1, "a b c d e f", 5, "")]
    assert sorted(r.n for r in ngram_join.keep_one(spark.createDataFrame(twice, schema)).collect()) == [1, 3, 5]


def test_structured_words_are_no_link(spark):
    """Words that collide for any base in polynomials modulo 2**64."""
    a = "a"
    for _ in range(11):
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    check(spark, [(1, f"p q r s {a}"), (2, f"p q r s {b}"), (3, f"P q r s {a}")])


def test_long_texts(spark):
    long = [f"w{i % 9973}x{i % 31}" for i in range(200_000)]
    check(spark, [(1, " ".join(long)), (2, " ".join(long[:190_000])), (3, " ".join(long[:100_000])), (4, "x " * 100_000)])


def test_open_lists_of_many_groups(spark):
    """Sets that share one hot passage and are near one another without links, beside groups that are linked."""
    random.seed(6)
    word = lambda: random.choice("klmnopq") + str(random.randrange(900))
    passage, docs = [word() for _ in range(40)], []
    for i in range(200):
        docs.append((i, " ".join(passage + [word() for _ in range(random.choice([3, 6, 9, 12, 20, 40, 90]))])))
    check(spark, docs)
