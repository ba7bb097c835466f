"""Held-out accuracy and edge cases."""

from __future__ import annotations

import numpy as np
from orefold.llm import language_id, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = queries.op4_language_id(spark, sf).join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_texts_and_clashing_columns(spark):
    docs = spark.createDataFrame([(i, t, lang, "s") for i, (t, lang) in enumerate([("der die das und", "de"), ("the of and to", "en")] * 40 + [(None, "en"), ("", "de"), ("12 !?", "en"), ("the the", None)])], "doc_id long, text string, lang string, score string")
    model = language_id.fit(docs)
    out = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs, model).collect()}
    assert out[0][0] == "de" and out[1][0] == "en" and out[83][0] == "en"
    assert [out[i] for i in (80, 81, 82)] == [("und", 0.0)] * 3
    kept = language_id.keep_known(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(out) - {80, 81, 82}


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert language_id.predict(docs, language_id.fit(docs)).first().lang_pred == "und"
    assert language_id.predict(docs.limit(0), language_id.fit(docs.limit(0))).count() == 0


def test_every_language_is_learned(spark):
    rng = np.random.default_rng(6)
    words = [" ".join("".join(chr(c) for c in rng.integers(97, 123, 8)) for _ in range(4)) for _ in range(205)]
    texts = [(w, f"l{i:03d}") for i, w in enumerate(words) for _ in range(9 if i < 200 else 6)]
    docs = spark.createDataFrame([(k, *x) for k, x in enumerate(texts)], "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert len(model.languages) == 205
    assert [model.predict(words[i])[0] for i in range(200, 205)] == [f"l{i:03d}" for i in range(200, 205)]


def test_document_frequencies_come_from_all_documents(spark):
    rows = [(i, "der die das" if i % 2 else "the of and", "de" if i % 2 else "en") for i in range(40)] + [(100 + i, f"qu zz {chr(97 + i % 26)}", None) for i in range(60)] + [(200, None, "en"), (201, "12", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = [language_id.counts_of(t)[0] for _, t, _ in rows[:100]]
    df = np.bincount(np.concatenate(found), minlength=language_id.ORDERS * language_id.BUCKETS)
    assert np.allclose(language_id.fit(docs).idf, np.log(101 / (1 + df)) + 1)


def test_without_languages_texts_with_a_letter_stay(spark):
    docs = spark.createDataFrame([(1, "words", None, 1), (2, "12", None, 2), (3, None, None, 3), (4, "слово", None, 4)], "doc_id long, text string, lang string, score int")
    kept = language_id.keep_known(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4]


def test_long_texts_ties_and_repeated_rows(spark):
    rows = [(i, "der die das und" if i % 2 else "the of and to", "de" if i % 2 else "en") for i in range(60)]
    docs = spark.createDataFrame([*rows, rows[0], rows[0], (100, "der die das und " * 100_000, None), (101, "the of and to der die das und", "en"), (101, "the of and to der die das und", "de")], "doc_id long, text string, lang string")
    out = language_id.predict(docs, language_id.fit(docs)).collect()
    assert len(out) == docs.count() and {r.lang_pred for r in out if r.doc_id == 100} == {"de"}
    assert len({(r.lang_pred, r.score) for r in out if r.doc_id == 0}) == 1 and len({(r.lang_pred, r.score) for r in out if r.doc_id == 101}) == 1
