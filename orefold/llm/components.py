"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join; no component, and no node's edges, meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.llm.shared import dropped, written


#: Most nodes of high degree that a step broadcasts.
HUBS = 100_000
#: Edges that make a node one of high degree, at least.
DEGREE = 64


def _with_least(e: DataFrame, n: int) -> DataFrame:
    """a, b and m, the least b of its a, for n edges.

    Edges of a node of high degree stay where they are: the nodes with more than n /
    HUBS edges are at most HUBS, so what they need is broadcast.  The others' edges are joined.
    """
    most = max(DEGREE, -(-n // HUBS))
    per = e.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    met = e.join(F.broadcast(per.filter(F.col("n") > most).select("a", "m")), "a", "left")
    rest = met.filter("m IS NULL").select("a", "b").join(per.filter(F.col("n") <= most).select("a", "m"), "a")
    return met.filter("m IS NOT NULL").unionByName(rest)


def _large(e: DataFrame, n: int) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _with_least(both, 2 * n).select("a", "b", F.least("a", "m").alias("m"))
    return least.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small(e: DataFrame, n: int) -> DataFrame:
    down = _with_least(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), n)
    moved = down.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(down.select("a", F.col("m").alias("b"))).distinct()


def _is_star(e: DataFrame) -> bool:
    """Whether every node has one parent, and no parent has one."""
    if not e.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        return False
    return e.select("b").distinct().join(e.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node and label, the least node of its component, for all nodes of links (a, b); both long."""
    e = written(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _is_star(e):
        large = written(_large(e, e.count()))
        dropped(e)
        e = written(_small(large, large.count()))
        dropped(large)
    labels = e.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())
