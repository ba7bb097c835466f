"""Sinks: exports, histories and manifests. Stored tables are replaced in new folders, never under a reader."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def with_messages(records: DataFrame) -> DataFrame:
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    return records.select(F.array(turn("user", "user_message"), turn("assistant", "assistant_message")).alias("messages"))


def export_jsonl(records: DataFrame, path: str) -> None:
    """One JSON object with messages per line; other alphabets stay readable."""
    with_messages(records).select(F.to_json(F.struct("messages")).alias("value")).write.mode("overwrite").text(path)


def export_parquet(records: DataFrame, path: str, split: str = "train") -> None:
    """Messages as Parquet in the split's folder."""
    with_messages(records).write.mode("overwrite").parquet(f"{path}/{split}")


def export_splits(df: DataFrame, path: str) -> dict[str, int]:
    """df in a folder for each split, and the rows of each."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)
    spark = df.sparkSession
    return {r["split"]: r["n"] for r in spark.read.parquet(path).groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}


def stamp_exported(records: DataFrame, exported: DataFrame, at: str) -> DataFrame:
    """records with exported_at set where exported has the id."""
    ids = exported.select("id").distinct().withColumn("__x", F.lit(1))
    return records.join(ids, "id", "left").withColumn("exported_at", F.when(F.col("__x") == 1, F.lit(at).cast("timestamp")).otherwise(F.col("exported_at"))).drop("__x")


def history_row(spark: SparkSession, at: str, counts: dict[str, int], weights: dict[str, float], path: str) -> DataFrame:
    row = [(at, sum(counts.values()), json.dumps(counts, sort_keys=True), json.dumps(weights, sort_keys=True), path)]
    return spark.createDataFrame(row, "exported_at string, record_count long, domain_counts string, domain_weights string, output_path string")


def delete_where(table: DataFrame, predicate: str) -> DataFrame:
    """table without the rows for which the predicate is true; null counts as false."""
    return table.where(f"NOT coalesce({predicate}, false)")


def delete_linked(links: DataFrame, removed: DataFrame, key: str = "record_id") -> DataFrame:
    """links without those of removed records."""
    return links.join(removed.select(F.col("id").alias(key)), key, "left_anti")


def manifest(df: DataFrame, *groups: str) -> str:
    """Row counts by the given columns, as JSON."""
    rows = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).orderBy(*groups).toJSON().collect()
    return "[" + ",".join(rows) + "]"


def newest(names: list[str], keep: int) -> tuple[list[str], list[str]]:
    """Backup names to keep and to remove, newest first by name."""
    ordered = sorted(names, reverse=True)
    return ordered[:keep], ordered[keep:]


def write_json(df: DataFrame, path: str) -> str:
    """A small result as one JSON file, an object per row."""
    from orefold.sources.landing import land_file

    return land_file(df.select(F.to_json(F.struct(*df.columns)).alias("value")), path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A manifest's rows; FileNotFoundError where there is none."""
    from orefold.sources.landing import exists

    if not exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.json(path)


def rotate(spark: SparkSession, folder: str, stamp: str, keep: int, splits: tuple[str, ...] = ("train", "validation", "test")) -> list[str]:
    """Moves the splits of a folder to backup_<stamp> and keeps the newest backups; the names of those kept."""
    jvm = spark.sparkContext._jvm
    path = lambda x: jvm.org.apache.hadoop.fs.Path(x)
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = [s for s in splits if fs.exists(path(f"{folder}/{s}"))]
    if there:
        fs.mkdirs(path(f"{folder}/backup_{stamp}"))
    for s in there:
        fs.rename(path(f"{folder}/{s}"), path(f"{folder}/backup_{stamp}/{s}"))
    found = [f.getPath().getName() for f in fs.listStatus(path(folder)) if f.getPath().getName().startswith("backup_")]
    kept, gone = newest(found, keep)
    for name in gone:
        fs.delete(path(f"{folder}/{name}"), True)
    return kept


def newest_file(files: DataFrame, time: str = "modified", name: str = "file") -> DataFrame:
    """The file that was changed last, ties by name."""
    return files.agg(F.max_by(name, F.struct(time, name)).alias(name))
