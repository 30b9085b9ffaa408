"""Click events: decode, route, find saves, recommend.

Every function works the same on a batch and on a streaming DataFrame.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.functions.text import after_label, filled
from edupipe.schemas import CLICK_EVENT


def subscribe(spark: SparkSession, servers: str, topics: Sequence[str] = tuple(fv.TOPICS)) -> DataFrame:
    """Messages of all topics from the beginning (needs Spark's Kafka package)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .load()
    )


def decode(messages: DataFrame) -> DataFrame:
    """(topic, key, value) bytes to typed click events."""
    event = F.from_json(F.decode("value", "UTF-8"), CLICK_EVENT)
    return messages.select("topic", F.decode("key", "UTF-8").alias("key"), event.alias("e")).select(
        "topic",
        "key",
        F.col("e.User_ID").alias("user_id"),
        F.col("e.Session_ID").alias("session_id"),
        F.try_to_timestamp(F.trim("e.Timestamp")).alias("timestamp"),
        F.col("e.Page").alias("page"),
        F.col("e.Clicked_Element").alias("clicked_element"),
        F.col("e.Clicked_Parameter").alias("clicked_parameter"),
        F.col("e.Duration").alias("duration"),
        F.col("e.Location").alias("location"),
    )


def route(events: DataFrame) -> DataFrame:
    """Add the table an event belongs to (``details_events`` -> ``details_table``)."""
    return events.withColumn("table_name", F.regexp_replace("topic", "_events$", "_table"))


def save_clicks(events: DataFrame) -> DataFrame:
    """Save clicks of the details topic with the saved item; without an item id no row.

    The element is compared in lower case without quotes.
    """
    element = F.regexp_replace(F.lower("clicked_element"), '"', "")
    item = after_label(F.col("clicked_parameter"), fv.ITEM_LABEL)
    return (
        events.where((F.col("topic") == fv.SAVE_TOPIC) & (F.trim(element) == fv.SAVE_ELEMENT))
        .withColumn("item_id", filled(item))
        .where(F.col("item_id").isNotNull())
    )


def recommend(saves: DataFrame, neighbours: DataFrame) -> DataFrame:
    """One row per save and neighbour of the saved item.

    neighbours(item_id, neighbours: array of (recommended_id, score)) holds a row
    per item with its k neighbours, so the join matches at most once per save and
    a popular item needs no more than that one row.
    """
    hits = saves.join(neighbours, "item_id").withColumn("hit", F.explode("neighbours"))
    return hits.select(
        "user_id",
        F.col("item_id").alias("source_id"),
        F.col("hit.recommended_id").alias("recommended_id"),
        F.col("hit.score").alias("score"),
        "timestamp",
        F.lit(False).alias("clicked"),
    )


def write_stream(df: DataFrame, path: str, checkpoint: str, partition: Sequence[str] = ()) -> None:
    """Process all that is available into a parquet table and stop; safe to run again."""
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if partition:
        writer = writer.partitionBy(*partition)
    writer.trigger(availableNow=True).start(path).awaitTermination()


def write_tables(events: DataFrame, checkpoint: str, save: Callable[[DataFrame, str, int], None]) -> None:
    """Process all that is available, handing every micro batch to ``save`` table by table.

    ``save(rows, table_name, batch_id)`` is for sinks without a streaming writer (such as
    a database).  A batch may come again after a failure: ``batch_id`` tells.
    """
    tables = [re.sub("_events$", "_table", topic) for topic in fv.TOPICS]

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for table in tables:
                save(batch.where(F.col("table_name") == table).drop("table_name"), table, batch_id)
        finally:
            batch.unpersist()

    writer = route(events).writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    writer.trigger(availableNow=True).start().awaitTermination()
