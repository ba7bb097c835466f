"""Each stage, and the whole pipeline, against plain re-computations of what they should keep."""

from __future__ import annotations

import hashlib

import corpus_pipeline
from orefold.llm import language_id, queries
from tests.llm.test_decontamination import brute as leaks
from tests.llm.test_line_dedup import brute as lines
from tests.llm.test_ngram_join import brute as near
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert first.columns == docs.columns
    kept = {r.doc_id: r for r in first.collect()}
    model = language_id.fit(docs)
    assert set(kept) == {r.doc_id for r in docs.collect() if (p := model.predict(r.text))[0] != "und" and p[1] >= 0.5}
    texts = lines([(r.doc_id, r.text, r.source) for r in kept.values()])
    groups = near(list(texts.items()))
    single = [d for d in texts if groups[d][1] == d]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = leaks([(d, texts[d]) for d in single], items)
    want = {d for d in single if hits[d][1] == 0}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == want and 0 < len(want) < len(texts)
    library = Tokenizer.from_file(queries.vocabulary().path)
    for d in sorted(want)[:50]:
        ids = library.encode(texts[d], add_special_tokens=False).ids
        assert got[d].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_odd_tables_through_all_stages(spark, tmp_path):
    """Null and empty texts, whole repeats, and columns of names that stages use; an empty table gives no rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").limit(60)
    odd = spark.createDataFrame([(9001, None, "en", None, None), (9002, "", None, "s", 0), (9003, "!! 12", "en", "s", 5), (None, "A text of some words without any key to it at all", "en", "s", 49)], docs.schema)
    clash = ("n_words long, n_removed long, row long, uid long, key string, packed string, __key string, __lang_pred string").split(", ")
    both = docs.unionByName(odd).unionByName(docs.limit(3))
    for c in clash:
        both = both.selectExpr("*", f"CAST(NULL AS {c.split()[1]}) AS {c.split()[0]}")
    current = both
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, SF)
        assert current.columns == both.columns, name
    last = corpus_pipeline.STAGES[-1][1](spark, current, SF).collect()
    kept = [r.doc_id for r in last]
    assert 0 < len(kept) <= both.count() and not {9001, 9002, 9003} & set(kept) and None in kept
    empty = both.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0
