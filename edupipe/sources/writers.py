"""Sinks.  Every task writes its own file; one single file only on request."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, single_file: bool = False) -> None:
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_csv(df: DataFrame, path: str, separator: str = ",") -> None:
    df.write.mode("overwrite").options(header=True, sep=separator, quote='"', escape='"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON record per line, nulls left out."""
    df.write.mode("overwrite").json(path)


def _array_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Put ``[``, commas and ``]`` around the records of one task."""
    opening = "["
    for batch in batches:
        for_file = []
        for record in batch.column(0).to_pylist():
            for_file.append(f"{opening}{record}")
            opening = ","
        yield pa.RecordBatch.from_arrays([pa.array(for_file, pa.string())], ["value"])
    if opening == ",":
        yield pa.RecordBatch.from_arrays([pa.array(["]"], pa.string())], ["value"])


def write_json_array(df: DataFrame, path: str) -> None:
    """Files that each hold one JSON array of records, streamed record by record."""
    records = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    records.mapInArrow(_array_lines, "value string").write.mode("overwrite").text(path)


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], batch_size: int = 1000, connections: int = 8
) -> None:
    """Append in batches over ``connections`` connections; the work before keeps its own parallelism."""
    df.repartition(connections).write.mode("append").option("batchsize", batch_size).jdbc(
        url, table, properties=dict(properties)
    )


def write_history(df: DataFrame, path: str, kind: str, ts: str) -> None:
    """Append to a history laid out by kind and event day.

    ``rebalance`` gathers each (kind, day) so that light days make few files,
    and lets AQE split a heavy one over several tasks.
    """
    dated = df.withColumn("dt", F.to_date(F.col(ts)))
    dated.hint("rebalance", F.col(kind), F.col("dt")).write.mode("append").partitionBy(kind, "dt").parquet(path)


def publish(messages: DataFrame, servers: str) -> None:
    """Send (topic, key, value) messages, each to its own topic (needs Spark's Kafka package)."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def keyed_messages(df: DataFrame, topic: str, key: str, columns: Sequence[str]) -> DataFrame:
    """(topic, key, value) messages: the key and the whole record as JSON, both UTF-8 bytes."""
    return df.select(
        F.col(topic).alias("topic"),
        F.encode(F.col(key).cast("string"), "UTF-8").alias("key"),
        F.encode(F.to_json(F.struct(*columns)), "UTF-8").alias("value"),
    )
