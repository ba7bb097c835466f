"""The training-data pipeline: language, lines, near duplicates, benchmarks, tokens.

Each stage takes the documents that its predecessor kept and returns documents
with the same columns; the last returns their token counts and digests.
"""

from __future__ import annotations

from collections.abc import Callable

from orefold.llm import bpe, decontamination, language_id, line_dedup, ngram_join
from orefold.llm.queries import vocabulary
from orefold.llm.shared import table, written
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language is not told with a probability of one half, go."""
    return language_id.keep_known(docs)


def remove_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of many sites go but for their first occurrence; every document stays."""
    cleaned = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cleaned.select(*docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least doc_id stays."""
    return ngram_join.keep_one(docs)


def remove_benchmark_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document, encoded and decoded again."""
    return bpe.digests(bpe.encode(docs.select("doc_id", "text"), vocabulary(), decoded="decoded"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_languages),
    ("line_dedup", remove_boilerplate_lines),
    ("ngram_join", keep_one_of_near_duplicates),
    ("decontamination", remove_benchmark_documents),
    ("bpe", encode),
]

#: The first stage learns a classifier, the last runs a tokenizer: SQL expresses neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs)
    return docs
