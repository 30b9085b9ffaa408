"""Session settings and the shared folder used for written intermediates."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Results depend on these (time zone, strict casts).  The rest is left to the
# cluster: AQE coalesces small shuffle partitions and splits skewed ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "edupipe", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, or where that is unset one in the warehouse."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named:
        named = context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/edupipe-shared"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/edupipe-{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def bucketed(df: DataFrame, label: str, columns: list[str], buckets: int | None = None) -> Iterator[DataFrame]:
    """Write ``df`` once, bucketed by ``columns``: repeated joins on them do not shuffle it again.

    The catalog entry is gone after the block; the files stay in the shared folder.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = fresh_path(spark, label)
    table = f"edupipe_{label}_{path.rsplit('-', 1)[1]}"
    writer = df.repartition(buckets, *columns).write.bucketBy(buckets, *columns)
    writer.option("path", path).saveAsTable(table)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


@contextlib.contextmanager
def shuffles_let_go(spark: SparkSession) -> Iterator[None]:
    """What is run inside removes its shuffle files when it ends; else they lie there until the driver collects its garbage."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage; what was computed outlives the executors that computed it, and its shuffles go.
    """
    path = fresh_path(df.sparkSession, label)
    with shuffles_let_go(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
