"""Against a brute-force count of all windows."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from orefold.llm import suffix_dedup


def brute(docs, window):
    texts = [(t or "").encode() for _, t in docs]
    count = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for (d, _), t in zip(docs, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if count[t[i : i + window]] > 1:
                gone[i : i + window] = b"\x01" * window
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), len(t) - len(kept), runs, kept))
    return out


def brute_passages(docs, n):
    """Words in windows of n words that start anywhere else too."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    count = Counter(tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1))
    return sorted((d is None, d or 0, len({j for i in range(len(w) - n + 1) if count[tuple(w[i : i + n])] > 1 for j in range(i, i + n)})) for (d, _), w in zip(docs, words))


def compare(spark, docs, window, anchor, parts=4):
    df = spark.createDataFrame(docs, "doc_id long, text string, kept string").select("doc_id", "text", "kept").repartition(parts) if len(docs[0]) == 3 else spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    rows = suffix_dedup.dedup(df, window=window, anchor=anchor, passage_words=5).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_passage_words) for r in rows) == brute_passages([d[:2] for d in docs], 5)
    order = lambda x: (x[0] is None, x[0] or 0, x)[0:2] + tuple(x[1:])
    want = brute([d[:2] for d in docs], window)
    assert sorted(got, key=order) == sorted(want, key=order)
    return want


@pytest.mark.parametrize("seed,window,anchor", [(1, 40, 20), (2, 40, 30), (3, 10, 4), (4, 25, 1), (5, 12, 12)])
def test_planted_repeats(spark, seed, window, anchor):
    random.seed(seed)
    word = lambda n: "".join(random.choice("abcdeé ") for _ in range(n))
    passages = [word(random.randint(window // 2, window * 4)) for _ in range(8)]
    docs = []
    for i in range(150):
        parts = [word(random.randint(0, window * 2))]
        for _ in range(random.randint(0, 3)):
            p = random.choice(passages)
            cut = random.randint(0, len(p) // 3)
            parts += [p[cut:], word(random.randint(0, window))]
        docs.append((i, "".join(parts)))
    docs += [(200, None), (201, ""), (202, "a" * (window * 3)), (203, "ab" * (window // 2 + 2)), (204, "xyz" * window), (205, docs[0][1]), (205, docs[0][1]), (None, docs[1][1]), (206, "a" * window), (207, "a" * (window - 1))]
    want = compare(spark, docs, window, anchor)
    assert any(0 < r[2] < r[1] for r in want)


def test_hot_passage(spark):
    random.seed(9)
    word = lambda n: "".join(random.choice("abcdefgh") for _ in range(n))
    hot = word(70)
    docs = [(i, word(30) + hot + word(30) + hot[:45], "x") for i in range(300)]
    compare(spark, docs, 40, 20, 2)


def test_generated_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    found, docs = suffix_dedup.dedup(rows).collect(), [tuple(r) for r in rows.collect()]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found]
    assert sorted(got) == sorted(brute(docs, 400))
    assert sorted((False, r.doc_id, r.n_passage_words) for r in found) == brute_passages(docs, 50)


def test_passages_shorter_than_the_window(spark):
    """A passage of over 50 words that two documents share is told even where it has less than 400 bytes."""
    random.seed(4)
    words = lambda n: " ".join(random.choice("abcdefgh") + random.choice("abcdefgh") + str(random.randrange(9)) for _ in range(n))
    passage = words(55)
    df = spark.createDataFrame([(1, f"{words(80)} {passage} {words(60)}"), (2, f"{passage} {words(90)}"), (3, words(200))], "doc_id long, text string")
    found = {r.doc_id: (r.n_removed, r.n_passage_words) for r in suffix_dedup.dedup(df).collect()}
    assert len(passage) < 400 and found == {1: (0, 55), 2: (0, 55), 3: (0, 0)}


def test_structured_strings_do_not_collide(spark):
    """Strings that collide for any base in polynomials modulo 2**64."""
    a = "a"
    for _ in range(11):
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    df = spark.createDataFrame([(1, "x" + a + "y"), (2, "z" + b + "w")], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, bytes(r.kept)) for r in suffix_dedup.dedup(df, window=2048, anchor=1024).collect()}
    want = {d: (removed, kept) for d, _, removed, _, kept in brute([(1, "x" + a + "y"), (2, "z" + b + "w")], 2048)}
    assert got == want and not any(r for r, _ in got.values())


def test_empty_table(spark):
    assert suffix_dedup.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
