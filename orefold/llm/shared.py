"""Tables, written stages and settings that the training-data operators share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from orefold.sources.landing import shared_dir, ship

#: Rows of a batch that goes to a Python worker, where the session does not set it; bounds the worker's memory.
BATCH_ROWS = 500


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """df.mapInArrow in batches that a worker can hold.

    The batch size is a setting of the session, read when the plan runs; where
    the session still has the default, it is set for good, as there is none for one query.
    """
    ship(df.sparkSession)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if df.sparkSession.conf.get(name) == "10000":
        df.sparkSession.conf.set(name, str(BATCH_ROWS))

    def bounded(batches: Iterator) -> Iterator:
        yield from run(batches)
        _give_back()

    return df.mapInArrow(bounded, schema)


def _give_back() -> None:
    """Returns a finished task's free memory to the system; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """df written as Parquet to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/orefold-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes written tables; all that was made of them must be written itself, as it could not be made again."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free(df: DataFrame, name: str) -> str:
    """name, or one like it that df has no column of."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
