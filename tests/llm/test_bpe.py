"""Exact agreement with the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import pyarrow as pa
import pytest
from orefold.llm import bpe, queries
from orefold.llm._vec import slices
from tokenizers import Tokenizer

PIECES = [" ", "  ", "\n", "\t", "a", "B", "é", "漢", "字", "<|endoftext|>", "<|endo", "'s", "'", "1", "23", "!", "...", "\xa0", " ", "the ", "x" * 50, "😀"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.vocabulary().path)


@pytest.mark.parametrize("mean", [16, 64, 1024])
def test_chunks_agree_with_whole_texts(library, mean):
    random.seed(mean)
    texts = ["".join(random.choice(PIECES) for _ in range(random.randint(0, 400))) for _ in range(200)]
    texts += ["", "漢字" * 2000, "a" * 5000, " " * 3000, "<|endoftext|>" * 300] + texts[:5]
    encoder = bpe.Encoder(queries.vocabulary(), mean)
    got = [x.tolist() for s in slices(pa.array(texts), 10_000) for x in encoder.slice(s)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert encoder.reused > 0


def test_query_digests(spark, library):
    rows = {r.doc_id: r for r in queries.op1_bpe(spark, "/root/testdata/sf0.001").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        got = rows[r.doc_id]
        assert (got.n_tokens, got.ids_sha256, got.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_nulls_repeats_and_clashing_columns(spark, library):
    d = spark.createDataFrame([(1, None, "x"), (1, "", "y"), (1, "hi there", "z"), (None, "hi there", None)], "doc_id long, text string, token_ids string")
    out = bpe.decode(bpe.encode(d, queries.vocabulary()), queries.vocabulary()).collect()
    assert sorted((len(r.token_ids), r.decoded) for r in out) == [(0, ""), (0, ""), (2, "hi there"), (2, "hi there")]
    both = bpe.encode(d, queries.vocabulary(), decoded="decoded").collect()
    assert sorted((len(r.token_ids), r.decoded) for r in both) == sorted((len(r.token_ids), r.decoded) for r in out)
    assert bpe.encode(d.limit(0), queries.vocabulary()).count() == 0
