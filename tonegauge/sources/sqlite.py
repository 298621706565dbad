"""Read a SQLite table as a Spark data source.

The file must lie where every executor can open it.  Each task reads one range of
row ids, so the table never passes through the driver.

    register(spark)
    spark.read.format("sqlite").option("path", p).option("table", t).load()
"""

import sqlite3
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import (
    BinaryType, DoubleType, LongType, StringType, StructField, StructType,
)


def _connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _spark_type(declared: str):
    """SQLite's affinity rules, as its documentation states them."""
    kind = declared.upper()
    if "INT" in kind:
        return LongType()
    if any(word in kind for word in ("CHAR", "CLOB", "TEXT")):
        return StringType()
    if "BLOB" in kind or not kind:
        return BinaryType() if "BLOB" in kind else StringType()
    return DoubleType()


class RowidRange(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class SqliteReader(DataSourceReader):
    def __init__(self, path: str, name: str, schema: StructType, slices: int):
        self.path, self.name, self.columns = path, name, schema
        self.slices = slices

    def partitions(self) -> list[RowidRange]:
        with _connect(self.path) as db:
            low, high = db.execute(
                f"SELECT min(rowid), max(rowid) FROM {_quoted(self.name)}").fetchone()
        if low is None:
            return []
        step = -(-(high - low + 1) // self.slices)
        return [RowidRange(at, min(at + step - 1, high)) for at in range(low, high + 1, step)]

    def read(self, partition: RowidRange) -> Iterator[tuple]:
        kinds = [f.dataType for f in self.columns]
        names = ", ".join(_quoted(f.name) for f in self.columns)

        def fit(value, kind):
            if value is None or isinstance(kind, BinaryType):
                return value
            if isinstance(kind, StringType):
                return str(value)
            return float(value) if isinstance(kind, DoubleType) else int(value)

        with _connect(self.path) as db:
            rows = db.execute(
                f"SELECT {names} FROM {_quoted(self.name)} WHERE rowid BETWEEN ? AND ?",
                (partition.low, partition.high))
            for row in rows:
                yield tuple(fit(v, kind) for v, kind in zip(row, kinds))


class SqliteDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> StructType:
        with _connect(self.options["path"]) as db:
            info = db.execute(f"PRAGMA table_info({_quoted(self.options['table'])})").fetchall()
        if not info:
            raise ValueError(f"no table {self.options['table']} in {self.options['path']}")
        return StructType([StructField(row[1], _spark_type(row[2] or "")) for row in info])

    def reader(self, schema: StructType) -> SqliteReader:
        return SqliteReader(
            self.options["path"], self.options["table"], schema,
            int(self.options.get("slices", "8")))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SqliteDataSource)


def read_sqlite(spark: SparkSession, path: str, table: str = "campaign_metadata") -> DataFrame:
    register(spark)
    return spark.read.format("sqlite").option("path", path).option("table", table).load()
