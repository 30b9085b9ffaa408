"""Scans.  Schemas are declared wherever the data set has one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Files that each hold a JSON array of records.

    Such a file is read by one task, so large data belongs in many files.
    """
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, separator: str = ","
) -> DataFrame:
    """CSV with a header, ``"`` as quote and escape.  Without a schema every column is text;
    with one, a cell that does not fit becomes null."""
    reader = spark.read.options(header=True, sep=separator, quote='"', escape='"', mode="PERMISSIVE")
    return (reader.schema(schema) if schema else reader).csv(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    properties: Mapping[str, str],
    partition: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Scan a database subquery.

    partition: (column, lowest, highest, number of parts) reads in parallel;
    without it the whole result comes through one connection.
    """
    table = f"({query}) q"
    if partition is None:
        return spark.read.jdbc(url, table, properties=dict(properties))
    column, low, high, parts = partition
    return spark.read.jdbc(url, table, column, low, high, parts, properties=dict(properties))


def with_path_fields(df: DataFrame, path: Column | None = None) -> DataFrame:
    """Add ``date_folder`` and ``file_name`` from a path ``…/yyyy-mm-dd/name.csv``; skip other paths."""
    where = F.col("_metadata.file_path") if path is None else path
    pattern = r"(\d{4}-\d{2}-\d{2})/([^/]+\.csv)\z"
    return (
        df.withColumn("date_folder", F.regexp_extract(where, pattern, 1))
        .withColumn("file_name", F.regexp_extract(where, pattern, 2))
        .where(F.col("date_folder") != "")
    )


def pending_partitions(source: DataFrame, done: DataFrame, partition: str) -> DataFrame:
    """Partition values of the source that the destination does not have yet."""
    return source.select(partition).distinct().join(done.select(partition).distinct(), partition, "left_anti")


# --- names and times of files; no data is read --------------------------------


def _glob(spark: SparkSession, pattern: str) -> list[tuple[int, str]]:
    """(modification time, path) of what matches a pattern."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [(s.getModificationTime(), s.getPath().toString()) for s in fs.globStatus(path) or []]


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def folder_names(spark: SparkSession, folder: str) -> set[str]:
    """Names directly under a folder; hidden ones are left out."""
    names = {path.rsplit("/", 1)[1] for _, path in _glob(spark, f"{folder}/*")}
    return {n for n in names if not n.startswith((".", "_"))}


def latest_file(spark: SparkSession, folder: str, suffixes: Sequence[str] = ("",)) -> str:
    """Path of the newest file of a folder by modification time (ties: greatest name)."""
    files = [
        found
        for found in _glob(spark, f"{folder}/*")
        if found[1].endswith(tuple(suffixes)) and not found[1].rsplit("/", 1)[1].startswith((".", "_"))
    ]
    if not files:
        raise FileNotFoundError(f"no files in {folder}")
    return max(files)[1]


def latest_dataset(spark: SparkSession, folder: str, stem: str = "") -> str:
    """The newest completely written data set of a folder, by the time of its ``_SUCCESS`` mark."""
    marks = [(time, path.rsplit("/", 1)[0]) for time, path in _glob(spark, f"{folder}/*/_SUCCESS")]
    named = [mark for mark in marks if stem in mark[1].rsplit("/", 1)[1]]
    if not named:
        raise FileNotFoundError(f"no complete data set in {folder}")
    return max(named)[1]
