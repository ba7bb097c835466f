from __future__ import annotations

import zlib
from collections import Counter

from orefold.llm import queries, sharding
from pyspark.sql import functions as F


def test_contract(spark):
    out = queries.op9_sharding(spark, "/root/testdata/sf0.01").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for r in out:
        b = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(b) + 1, zlib.crc32(b), "key")
        assert r.grown_shard in (r.shard, 8)
    for s in range(8):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    moved = sum(r.shard != r.grown_shard for r in out)
    assert 0 < moved < len(out) * 0.2


def test_weights_nulls_and_repeats(spark):
    df = spark.createDataFrame([(i, "t", "x") for i in range(3000)] + [(None, None, None), (None, None, None), (7, "t", "y")], "doc_id long, text string, slot string")
    out = sharding.shard(df, weights=(1.0, 3.0)).collect()
    count = Counter(r.shard for r in out)
    assert len(out) == 3003 and 2.5 < count[1] / count[0] < 3.6
    assert {r.size for r in out} == {1, 2}
    for s in count:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(count[s]))
    assert len({r.shard for r in out if r.doc_id == 7}) == 1
    assert sharding.shard(df.limit(0)).count() == 0


def test_shard_depends_on_the_key_alone(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"))
    a = {r.doc_id: r.shard for r in sharding.shard(df).collect()}
    b = {r.doc_id: r.shard for r in sharding.shard(df.where("doc_id % 3 = 0").repartition(7)).collect()}
    assert all(a[k] == v for k, v in b.items())
