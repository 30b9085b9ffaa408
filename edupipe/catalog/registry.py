"""The registry of queries and the loader of the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[["Tables"], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder, read on demand."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}
        spark.conf.set("spark.sql.session.timeZone", "UTC")  # the tables hold times without a zone

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def stream(self, name: str) -> DataFrame:
        """The table as a file stream; as a pattern, so that one file serves as well as a folder."""
        pattern = f"{self.folder}/{name}[.]parquet"
        return self.spark.readStream.schema(getattr(self, name).schema).parquet(pattern)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(self.path(name))
        return self._read[name]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL that gives the same rows."""
    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add
