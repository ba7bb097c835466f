"""Small files landed in the shared folder, as feeds and fixtures are before they are read."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of its own where that is unset, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = f"file://{tempfile.mkdtemp(prefix='orefold-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, so that their workers import what they run."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    target = os.path.join(tempfile.mkdtemp(prefix="orefold-"), "orefold.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/landed-{uuid.uuid4().hex}"


def land_file(lines: DataFrame, path: str) -> str:
    """The one column of lines, a line each, as one file of the given name; for small feeds."""
    spark = lines.sparkSession
    lines.coalesce(1).write.text(f"{path}.parts")
    jvm = spark.sparkContext._jvm
    parts = jvm.org.apache.hadoop.fs.Path(f"{path}.parts")
    fs = parts.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(parts):
        if status.getPath().getName().startswith("part-"):
            fs.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(path))
    fs.delete(parts, True)
    return path


def land_each(files: DataFrame, folder: str, suffix: str) -> str:
    """A file for each row: its name from the first column, its text from the second."""
    name, text = files.columns
    files.select(name, text).write.partitionBy(name).option("lineSep", "\n").text(f"{folder}/{suffix}")
    return f"{folder}/{suffix}"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def put(spark: SparkSession, path: str, text: str) -> str:
    """One small file of the given text."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return path
