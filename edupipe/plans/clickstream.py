"""Click history: clean what is pending, archive, and keep to the retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.operators import filters
from edupipe.schemas import CLICK_HISTORY
from edupipe.sources import readers, writers
from edupipe.streaming import clicks, ttl


def clean_history(rows: DataFrame) -> DataFrame:
    """Lower-cased, trimmed texts; rows with any missing value drop out."""
    return filters.drop_incomplete(filters.normalise_strings(rows))


def clean_pending(spark: SparkSession, source: str, destination: str) -> int:
    """Clean every day folder of ``source`` that ``destination`` lacks; returns how many.

    Days are compared by folder name; the pending ones are read in one job.
    """
    done = {name.removeprefix("date_folder=") for name in readers.folder_names(spark, destination)}
    pending = sorted(readers.folder_names(spark, source) - done)
    if pending:
        scan = readers.read_csv(spark, [f"{source}/{day}" for day in pending], CLICK_HISTORY)
        rows = readers.with_path_fields(scan.select("*", "_metadata")).drop("_metadata")
        clean = clean_history(rows).hint("rebalance", "date_folder")
        clean.write.mode("append").partitionBy("date_folder").parquet(destination)
    return len(pending)


def clean_pending_stream(spark: SparkSession, source: str, destination: str, checkpoint: str) -> int:
    """Clean the files of ``source`` that no earlier run has read; returns how many rows were read.

    The checkpoint of the file stream knows what is done, so a day that gets another file is
    pending again for that file alone, and nothing lists or compares the destination.
    """
    scan = spark.readStream.schema(CLICK_HISTORY).options(header=True, quote='"', escape='"', mode="PERMISSIVE")
    rows = scan.option("recursiveFileLookup", True).csv(source).select("*", "_metadata.file_path")
    clean = clean_history(readers.with_path_fields(rows, F.col("file_path")).drop("file_path"))
    writer = clean.writeStream.format("parquet").partitionBy("date_folder").option("checkpointLocation", checkpoint)
    run = writer.outputMode("append").trigger(availableNow=True).start(destination)
    run.awaitTermination()
    return sum(progress.numInputRows for progress in run.recentProgress)


def archive_recent(rows: DataFrame, path: str, kind: str, ts: str, as_of: Column) -> None:
    """Append the rows of the last hour to the history."""
    writers.write_history(filters.recent(rows, ts, as_of, "1 hour"), path, kind, ts)


def archive_stream(events: DataFrame, path: str, checkpoint: str, ts: str = "timestamp") -> None:
    """Append a stream to the history by event day, so that late rows, however late, reach their day."""
    dated = events.withColumn("dt", F.to_date(ts))
    (
        dated.writeStream.format("parquet").partitionBy("topic", "dt")
        .option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(availableNow=True).start(path).awaitTermination()
    )


def expired_history(spark: SparkSession, path: str, as_of: Column, days: int = 7) -> DataFrame:
    """Day folders past their retention, from the names of the folders; no data is read.

    Histories are laid out by kind and day, or by day alone.
    """
    found = set()
    for name in readers.folder_names(spark, path):
        inner = [name] if name.startswith("dt=") else readers.folder_names(spark, f"{path}/{name}")
        found.update(n.removeprefix("dt=") for n in inner if n.startswith("dt="))
    folders = spark.createDataFrame([(name,) for name in sorted(found)], "dt string")
    return filters.expired_folders(folders, "dt", as_of, days)


def fresh_recommendations(saves: DataFrame, neighbours: DataFrame, tie: str, ttl_seconds: int = fv.CACHE_TTL_SECONDS) -> DataFrame:
    """Recommendations for the saves that no earlier answer still covers.

    saves(user_id, item_id, timestamp, tie); neighbours as for ``clicks.recommend``.
    A save without any neighbour has no answer and so starts no time to live.
    """
    answered = neighbours.where(F.size("neighbours") > 0)
    able = saves.join(answered.select("item_id"), "item_id", "left_semi")
    passed = ttl.first_per_ttl(able, ["user_id", "item_id"], "timestamp", tie, ttl_seconds)
    return clicks.recommend(passed.withColumn("timestamp", F.timestamp_seconds("second")), answered)
