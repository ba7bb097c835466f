"""Sampling and splits: weights by domain, balancing, and splits that do not depend on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orefold.functions import ids
from orefold.operators.records import quality_order


def _ranked(df: DataFrame, group: str, order: list[Column], rank: str = "__rank", size: str = "__size") -> DataFrame:
    """df with each row's rank in its group and the group's size; sizes come from a small aggregate."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias(size))
    return df.join(sizes, group).withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order)))


def domain_weights(records: DataFrame, weights: dict[str, float], seed: int = 42) -> DataFrame:
    """Records with copy numbers: under weight 1 the best max(1, int(n w)) of a domain, from 1 on int(w) copies and int(n frac) drawn once more.

    Rows come in a seeded order that any engine can reproduce.
    """
    known = F.lit(1.0)
    for d, w in weights.items():
        known = F.when(F.col("domain") == d, F.lit(float(w))).otherwise(known)
    n, w = F.col("__size"), F.col("__w")
    ranked = _ranked(records, "domain", quality_order()).withColumn("__w", known)
    draw = Window.partitionBy("domain").orderBy(ids.order_key(F.col("id"), seed), "id")
    ranked = ranked.withColumn("__draw", F.row_number().over(draw))
    whole = F.floor(w).cast("int")
    copies = F.when(w < 1, (F.col("__rank") <= F.greatest(F.lit(1), F.floor(n * w))).cast("int")).otherwise(whole + (F.col("__draw") <= F.floor(n * (w - whole))).cast("int"))
    out = ranked.withColumn("__copies", copies).where("__copies > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return out.withColumn("shuffle_key", ids.order_key(F.concat_ws(":", "id", "copy_no"), seed)).drop("__size", "__rank", "__w", "__draw", "__copies")


def ratio_split(df: DataFrame, key: str, ratios: dict[str, float], seed: int = 42) -> DataFrame:
    """df with split: each key falls in the bucket of its hash, so splits are disjoint, complete and stable."""
    b, out, reach = ids.bucket(F.col(key), 10_000, seed), None, 0.0
    names = list(ratios)
    for name in names[:-1]:
        reach += ratios[name]
        cut = b < round(reach * 10_000)
        out = F.when(cut, name) if out is None else out.when(cut, name)
    return df.withColumn("split", out.otherwise(names[-1]))


def positional_split(df: DataFrame, key: str, test_share: float, seed: int = 42) -> DataFrame:
    """df with split: the first int(n share) rows in a seeded order are the test set.

    Ranks come from hash buckets and a small table of their sizes, so no task sees all rows.
    """
    numbered = seeded_rank(df, key, seed)
    total = df.agg(F.count(F.lit(1)).alias("__n"))
    return numbered.crossJoin(F.broadcast(total)).withColumn("split", F.when(F.col("__rank") <= F.floor(F.col("__n") * test_share), "test").otherwise("train")).drop("__rank", "__n")


def seeded_rank(df: DataFrame, key: str, seed: int = 42, buckets: int = 256) -> DataFrame:
    """df with __rank, 1 to n in the order of the seeded hash of key, then key."""
    h = ids.order_key(F.col(key), seed)
    rows = df.withColumn("__h", h).withColumn("__b", F.conv(F.substring("__h", 1, 2), 16, 10).cast("int") % buckets)
    sizes = rows.groupBy("__b").agg(F.count(F.lit(1)).alias("__c"))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__b", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__s"))
    inside = Window.partitionBy("__b").orderBy("__h", key)
    return rows.join(F.broadcast(starts), "__b").withColumn("__rank", F.col("__s") + F.row_number().over(inside)).drop("__h", "__b", "__s")


def review_sample(records: DataFrame, n: int, seed: int = 42) -> DataFrame:
    return records.orderBy(ids.order_key(F.col("id"), seed), "id").limit(n)


def decision_points(frames: DataFrame, action: str = "action_label") -> DataFrame:
    """frames with is_decision: the action differs from the one before it in the episode."""
    before = F.lag(action).over(Window.partitionBy("episode_id").orderBy("frame_index"))
    return frames.withColumn("is_decision", F.coalesce(before != F.col(action), F.lit(True)))


def sampled_frames(frames: DataFrame, every: int, action: str = "action_label") -> DataFrame:
    """The first frame, those of a new action or a reward, and every nth."""
    before = F.lag(action).over(Window.partitionBy("episode_id").orderBy("frame_index"))
    changed = F.coalesce(before != F.col(action), F.lit(True))
    return frames.withColumn("__changed", changed).where(F.col("__changed") | (F.col("reward") > 0) | (F.col("frame_index") % every == 0)).drop("__changed")


def balanced_actions(frames: DataFrame, none_share: float = 0.25, repeats: int = 3) -> DataFrame:
    """Frames with copy_no: idle frames capped at a share of all, decisions first; decisive actions repeated.

    The cap is exceeded where idle decisions alone exceed it, as all of them stay.
    """
    tagged = decision_points(frames)
    total = tagged.agg(F.count(F.lit(1)).alias("__n"), F.count_if((F.col("action_label") == "NONE") & F.col("is_decision")).alias("__d"))
    idle = tagged.where("action_label = 'NONE' AND NOT is_decision")
    order = F.concat_ws(":", "episode_id", "frame_index")
    ranked = seeded_rank(idle.withColumn("__k", order), "__k").crossJoin(F.broadcast(total))
    extra = ranked.where(F.col("__rank") <= F.greatest(F.lit(0), F.floor(F.col("__n") * none_share) - F.col("__d"))).select(*tagged.columns, F.lit(1).alias("copy_no"))
    decided = tagged.where("action_label = 'NONE' AND is_decision").withColumn("copy_no", F.lit(1))
    acting = tagged.where("action_label <> 'NONE'").withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.when(F.col("is_decision"), repeats).otherwise(1))))
    return acting.unionByName(decided).unionByName(extra)


def episode_split(frames: DataFrame, test_share: float = 0.1, seed: int = 42) -> DataFrame:
    """frames with split: whole episodes, in a seeded order, go to test until it holds the share of all frames."""
    sizes = frames.groupBy("episode_id").agg(F.count(F.lit(1)).alias("n"))
    total = frames.agg(F.count(F.lit(1)).alias("total"))
    # running sums inside hash buckets, which lie in order, plus the sums of the 256 buckets before: no task orders all episodes
    keyed = sizes.withColumn("h", ids.order_key(F.col("episode_id"), seed)).withColumn("bucket", F.substring("h", 1, 2))
    buckets = keyed.groupBy("bucket").agg(F.sum("n").alias("m")).withColumn("base", F.coalesce(F.sum("m").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    w = Window.partitionBy("bucket").orderBy("h", "episode_id").rowsBetween(Window.unboundedPreceding, -1)
    inside = keyed.withColumn("inside", F.coalesce(F.sum("n").over(w), F.lit(0)))
    taken = inside.join(F.broadcast(buckets.select("bucket", "base")), "bucket").withColumn("before", F.col("base") + F.col("inside"))
    names = taken.crossJoin(F.broadcast(total)).select("episode_id", F.when(F.col("before") < F.col("total") * test_share, "test").otherwise("train").alias("split"))
    return frames.join(names, "episode_id")
