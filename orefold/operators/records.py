"""Records: pairs from conversations, their stored fields, filters, statistics and upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orefold.functions import classify
from orefold.functions import text as tx

MESSAGES = "array<struct<role:string,content:string>>"


def last_content(messages: Column, role: str) -> Column:
    """The content of the last message of a role, '' without one."""
    return F.coalesce(F.try_element_at(F.filter(messages, lambda m: m["role"] == role), F.lit(-1))["content"], F.lit(""))


def pairs_of_messages(df: DataFrame, messages: str = "messages") -> DataFrame:
    m = F.col(messages)
    return df.withColumns({"user_message": last_content(m, "user"), "assistant_message": last_content(m, "assistant")})


def pairs_of_turns(turns: DataFrame) -> DataFrame:
    """One row per conversation: the texts of its last user and assistant turns."""
    last = lambda role: F.max_by("text", F.when(F.col("role") == role, F.col("turn")))
    return turns.groupBy("conv_id").agg(last("user").alias("user_message"), last("assistant").alias("assistant_message"))


def with_metadata(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns(classify.metadata(F.col("user_message"), F.col("assistant_message")))


def dedup_new(new: DataFrame, stored: DataFrame | None = None, key: str = "content_hash", order: str = "id") -> DataFrame:
    """New rows whose key is neither stored nor held by an earlier new row."""
    first = new.groupBy(key).agg(F.min_by(F.struct(*new.columns), F.col(order)).alias("r")).select("r.*")
    return first if stored is None else first.join(stored.select(key).distinct(), key, "left_anti")


def upsert(stored: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Stored rows with new ones in place of those of equal key; of several new ones the last in order."""
    latest = new.groupBy(key).agg(F.max_by(F.struct(*new.columns), F.col(order)).alias("r")).select("r.*")
    return stored.join(latest.select(key), key, "left_anti").unionByName(latest.select(*stored.columns))


def write_back(stored: DataFrame, values: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Stored rows with the given columns replaced where values has a row and a value for the key."""
    named = values.select(key, *(F.col(c).alias(f"__{c}") for c in columns))
    return stored.join(named, key, "left").withColumns({c: F.coalesce(f"__{c}", c) for c in columns}).select(*stored.columns)


def exportable(records: DataFrame, least: float | None = 3.5, require_validation: bool = False, new_only: bool = False, since: str | None = None, domain: str | None = None) -> DataFrame:
    """Records that pass the filters; never-reviewed and, unless required, never-validated ones pass. least None or 0 turns the quality filter off."""
    out = records
    if least:
        out = out.where((F.col("quality_score") >= least) | F.col("quality_score").isNull())
    status = F.col("validation_status")
    out = out.where(status == "pass") if require_validation else out.where((status != "fail") | status.isNull())
    if new_only:
        out = out.where(F.col("exported_at").isNull())
    if since:
        out = out.where(F.col("ingested_at") >= F.lit(since).cast("timestamp"))
    if domain:
        out = out.where(F.col("domain") == domain)
    return out


def reviewable(records: DataFrame, domain: str | None = None, source: str | None = None, ids: list[int] | DataFrame | None = None, unreviewed: bool = True) -> DataFrame:
    out = records
    if unreviewed:
        out = out.where(F.col("quality_score").isNull())
    if domain:
        out = out.where(F.col("domain") == domain)
    if source:
        out = out.where(F.col("source") == source)
    if isinstance(ids, DataFrame):
        out = out.join(ids.select("id"), "id", "left_semi")
    elif ids:
        out = out.where(F.col("id").isin(ids))
    return out.where((F.col("validation_status") == "pass") | F.col("validation_status").isNull())


def quality_order() -> list[Column]:
    """Best first; never-reviewed records count 3.0."""
    return [F.coalesce("quality_score", F.lit(3.0)).desc(), F.col("id").asc()]


def domain_stats(records: DataFrame) -> DataFrame:
    """Thirteen measures of every domain, zeros for those without records, in one pass."""
    holds = lambda c: F.count_if(F.col(c).isNotNull())
    measures = {
        "record_count": F.count(F.lit(1)),
        "avg_length": F.avg("char_length"),
        "total_cves": holds("cve_ids"),
        "total_techniques": holds("mitre_techniques"),
        **{f"severity_{s.lower()}": F.count_if(F.col("severity") == s) for s in tx.SEVERITIES},
        "validated_count": holds("validation_status"),
        "validation_pass_count": F.count_if(F.col("validation_status") == "pass"),
        "validation_fail_count": F.count_if(F.col("validation_status") == "fail"),
    }
    grouped = records.groupBy("domain").agg(F.avg("quality_score").alias("avg_quality_score"), *(v.alias(k) for k, v in measures.items()))
    every = records.sparkSession.createDataFrame([(d,) for d in classify.DOMAINS], "domain string")
    zero = {k: F.coalesce(F.col(k), F.lit(0.0 if k == "avg_length" else 0)) for k in measures}
    return F.broadcast(every).join(grouped, "domain", "left").withColumns(zero).select("domain", *measures, "avg_quality_score")


def mean_review_score(scores: Column) -> Column:
    """The mean of five dimensions, 3 where one is missing."""
    names = ("accuracy", "completeness", "clarity", "relevance", "usefulness")
    total = F.lit(0)
    for n in names:
        total = total + F.coalesce(scores[n], F.lit(3))
    return total / F.lit(5)


def first_by_normal_text(df: DataFrame, text: Column, order: str) -> DataFrame:
    """Rows whose squeezed lower-case text no earlier row has; rows without text stay."""
    norm = F.lower(tx.squeeze(text))
    w = Window.partitionBy("__norm").orderBy(order)
    return df.withColumn("__norm", norm).withColumn("__rn", F.when(F.col("__norm").isNull(), 1).otherwise(F.row_number().over(w))).where("__rn = 1").drop("__norm", "__rn")
