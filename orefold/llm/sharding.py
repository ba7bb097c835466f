"""Sharding: rendezvous hashing of stable record keys over weighted shards.

Every shard draws a number u in (0, 1) from the hash of (key, shard) and the
record goes to the shard with the smallest -ln(u) / weight.  A record's shard
depends on its key and the shard set alone, so one more shard only takes records
for itself: 1 / (n + 1) of them with equal weights.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS = 8
#: Slots are numbered bucket by bucket; a bucket is numbered in one task.
SLOT_BUCKETS = 1024


def _draw(key: Column, shard: int) -> Column:
    """A number in (0, 1) of 52 random bits that any SQL engine with md5 can draw."""
    digits = F.substring(F.md5(F.concat_ws("#", key.cast("string"), F.lit(str(shard))).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key; weights must be positive. A null key has a place of its own."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    key = F.coalesce(key.cast("string"), F.lit("\x00null"))
    ranked = [F.struct((-F.ln(_draw(key, i)) / F.lit(float(w))).alias("cost"), F.lit(i).alias("shard")) for i, w in enumerate(weights)]
    return F.array_min(F.array(*ranked))["shard"]


def _bucket() -> Column:
    """A record's slot bucket, by its key, size and checksum, so no hot key fills one."""
    digits = F.substring(F.md5(F.concat_ws("#", F.lit("slot"), F.col("key").cast("string"), "size", "text_crc32").cast("binary")), 1, 6)
    return (F.conv(digits, 16, 10).cast("int") % SLOT_BUCKETS).cast("int")


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", weights: Sequence[float] = (1.0,) * SHARDS) -> DataFrame:
    """docs' key with size, text_crc32, shard, slot and grown_shard.

    size counts the text's UTF-8 bytes plus one; a null text counts as empty.
    slot numbers the records of a shard without gaps from 0: hash buckets in
    order, then keys in order inside a bucket, so no task sees a whole shard.
    Rows with equal or null keys share a shard and get different slots in
    the order of their sizes and checksums.  Other columns are left out, so
    their names cannot clash.
    """
    grown = [*weights, float(weights[0])]
    size = (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long")
    rows = docs.select(
        F.col(key).alias("key"),
        size.alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    ).withColumns({"shard": rendezvous(F.col("key"), weights), "grown_shard": rendezvous(F.col("key"), grown), "bucket": _bucket()})
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "bucket").orderBy("key", "size", "text_crc32")
    # starts has at most shards x SLOT_BUCKETS rows, whatever the input
    return (
        rows.withColumn("rank", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts), ["shard", "bucket"])
        .select(F.col("key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("start") + F.col("rank")).cast("long").alias("slot"), F.col("grown_shard").cast("int").alias("grown_shard"))
    )
