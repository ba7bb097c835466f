"""Line dedup: cross-site boilerplate lines found by distinct-site spread.

HyperLogLog sketches of the sites, one per line hash, merge by aggregation.
Lines whose estimate lies near the threshold get an exact distinct count, so
the outcome is that of exact counting.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.llm.shared import free, written

MIN_SITES = 5
#: log2 of a sketch's registers; the relative standard error is about 1.04 / 2**(k / 2).
SKETCH_K = 10
#: Estimates within this factor of the threshold are counted exactly: over six standard errors.
NEAR = 0.25


def line_key(line: Column) -> Column:
    """A 128-bit key of a line without its outer white space; null if nothing is left."""
    text = F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(text != "", F.unhex(F.md5(text.cast("binary"))))


def lines_of(docs: DataFrame, key: str, text: str, site: str) -> DataFrame:
    """A row for each line with text: key, site, line_no, line_key.  A null site is a site of its own."""
    numbered = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(site).cast("string"), F.lit("\x00null")).alias("site"),
        F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"),
    )
    return numbered.select("key", "site", "line_no", line_key(F.col("line")).alias("line_key")).filter(F.col("line_key").isNotNull())


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """line_key and n_sites of the lines on min_sites distinct sites or more.

    n_sites is exact near the threshold and the sketch's estimate above.
    """
    estimated = lines.groupBy("line_key").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_K))).alias("estimate"))
    sure = estimated.filter(F.col("estimate") > min_sites * (1 + NEAR))
    near = estimated.filter(F.col("estimate").between(min_sites * (1 - NEAR), min_sites * (1 + NEAR)))
    # a frequent line shrinks to its sites before the join, so no key brings many rows
    pairs = lines.groupBy("line_key", "site").agg(F.count(F.lit(1)).alias("n"))
    exact = pairs.join(near, "line_key", "left_semi").groupBy("line_key").agg(F.count(F.lit(1)).alias("n_sites")).filter(F.col("n_sites") >= min_sites)
    return sure.select("line_key", F.col("estimate").alias("n_sites")).unionByName(exact)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """docs with boilerplate lines removed from text, and n_lines, n_removed added.

    A line (outer white space aside) on min_sites sites or more is boilerplate:
    its first occurrence, in the order of key and line, stays, so copied texts
    do not vanish altogether; all others go.  Lines of white space stay.  A null
    text stays null.  Rows with equal keys are judged by their lines' content, so
    they may repeat.  Columns of docs other than text stay as they are; n_lines
    and n_removed replace columns of these names.
    """
    lines = written(lines_of(docs, key, text, site))  # read four times
    spread = written(spread_lines(lines, min_sites).select("line_key"))
    hits = lines.join(spread, "line_key").select("line_key", "key", "line_no")
    firsts = hits.groupBy("line_key").agg(F.min(F.struct("key", "line_no")).alias("first"))
    own, listed, kept = (free(docs, x) for x in ("__key", "__drops", "__kept"))
    drops = (
        hits.select("line_key", "key")
        .distinct()
        .join(firsts, "line_key")
        .withColumn("stays", F.when(F.col("first.key") == F.col("key"), F.col("first.line_no")).otherwise(-1))
        .groupBy("key")
        .agg(F.collect_list(F.struct("line_key", "stays")).alias(listed))
        .select(F.col("key").alias(own), listed)
    )
    numbered = F.transform(F.split(F.col(text), "\n"), lambda x, i: F.struct(x.alias("line"), i.alias("no"), line_key(x).alias("k")))
    gone = lambda x: F.exists(F.col(listed), lambda d: (d["line_key"] == x["k"]) & (d["stays"] != x["no"]))
    rest = F.filter(numbered, lambda x: x["k"].isNull() | ~gone(x))
    n_lines = F.coalesce(F.size(F.split(F.col(text), "\n")), F.lit(0))
    joined = docs.join(drops, F.col(key).eqNullSafe(F.col(own)), "left")
    judged = joined.withColumn(kept, F.when(F.col(listed).isNotNull(), rest))
    return judged.withColumns(
        {
            "n_lines": n_lines,
            "n_removed": F.when(F.col(kept).isNull(), 0).otherwise(n_lines - F.size(kept)),
            text: F.when(F.col(kept).isNull(), F.col(text)).otherwise(F.array_join(F.transform(kept, lambda x: x["line"]), "\n")),
        }
    ).drop(own, listed, kept)
