"""All queries of the engine, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orefold.operators import records
from orefold.plans import graph_queries, metric_queries, report_queries, search_queries, source_queries, store_queries, text_queries

Query = Callable[[SparkSession, str], DataFrame]
_MODULES = (text_queries, graph_queries, metric_queries, report_queries, search_queries, source_queries, store_queries)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations to stored records to domain statistics."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    pairs = records.pairs_of_turns(turns).dropna(subset=["user_message", "assistant_message"]).withColumnRenamed("conv_id", "id")
    stored = records.dedup_new(records.with_metadata(pairs))
    scored = stored.selectExpr("*", "CAST(NULL AS DOUBLE) AS quality_score", "CAST(NULL AS STRING) AS validation_status")
    return records.domain_stats(scored)


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for m in _MODULES:
        out |= m.Q
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _MODULES:
        out |= m.SQL
    return out
