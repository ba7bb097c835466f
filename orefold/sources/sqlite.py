"""Tables of a relational file, read by a Python data source with the standard library's driver.

The file must lie where executors can open it; each partition reads a range of row
numbers through a connection of its own.
"""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterator
from urllib.parse import quote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


def _local(path: str) -> str:
    """The path of a file URL."""
    return urlparse(path).path if path.startswith("file:") else path


def _name(x: str) -> str:
    return '"' + x.replace('"', '""') + '"'


class _Rows(InputPartition):
    def __init__(self, low: int, high: int) -> None:
        self.low, self.high = low, high


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.columns = [f.name for f in schema.fields]
        self.path, self.table, self.parts = _local(options["path"]), options["dbtable"], int(options.get("numPartitions", 4))

    def _connect(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{quote(self.path)}?mode=ro", uri=True)

    def partitions(self) -> list[InputPartition]:
        with self._connect() as c:
            low, high = c.execute(f"SELECT min(rowid), max(rowid) FROM {_name(self.table)}").fetchone()
        if low is None:
            return [_Rows(0, 0)]
        step = max(1, -(-(high - low + 1) // self.parts))
        return [_Rows(x, min(x + step, high + 1)) for x in range(low, high + 1, step)]

    def read(self, partition: _Rows) -> Iterator[tuple]:
        with self._connect() as c:
            yield from c.execute(f"SELECT {', '.join(map(_name, self.columns))} FROM {_name(self.table)} WHERE rowid >= ? AND rowid < ?", (partition.low, partition.high))


class SqliteSource(DataSource):
    """Options: path, dbtable, numPartitions; the schema is given by the reader."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, dict(self.options))


def read(spark: SparkSession, path: str, table: str, schema: str, partitions: int = 4) -> DataFrame:
    from orefold.sources.landing import ship

    ship(spark)
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite").schema(schema).options(path=path, dbtable=table, numPartitions=partitions).load()


def land(spark: SparkSession, path: str, table: str, columns: tuple[str, ...], rows: list[tuple]) -> str:
    """A new relational file of a few rows."""
    local = _local(path)
    os.makedirs(os.path.dirname(local), exist_ok=True)
    with sqlite3.connect(local) as c:
        c.execute(f"CREATE TABLE {_name(table)} ({', '.join(map(_name, columns))})")
        c.executemany(f"INSERT INTO {_name(table)} VALUES ({', '.join('?' * len(columns))})", rows)
    return path
