"""Tables that are kept: changes are merged into what is stored.

A stored table lies in hash buckets of its key.  A run rewrites only the buckets that its
changes touch; the files of the others stay as they are.  Of rows with one key the last
written wins: the one of the latest run, and within a run the last by the given order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edupipe.operators.dedupe import best_per_key
from edupipe.session import materialise
from edupipe.sources.readers import path_exists

BUCKET, VERSION = "__bucket", "__version"
BUCKETS = 64


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a stored table."""
    return spark.read.parquet(path).drop(BUCKET, VERSION)


def merge_rows(changes: DataFrame, path: str, keys: Sequence[str], order: Sequence[Column] = (), version: int = 1, buckets: int = BUCKETS) -> int:
    """Merge ``changes`` into the table at ``path``; returns how many buckets were touched.

    ``version`` is the number of the run: rows of a higher one win over stored rows, whichever run is
    merged first, and a run that is merged again changes nothing.  ``order`` sorts the rows of one run, the
    last wins; null keys are keys like any other.  ``buckets`` must stay the same for a table and grow with
    the data it is made for.

    What a bucket will hold is written to the shared folder before any file of the table goes,
    so that a lost executor takes nothing with it; a run that was stopped is merged again.
    """
    spark = changes.sparkSession
    last = [F.desc(VERSION), *[o.desc() for o in order]]
    new = best_per_key(changes.withColumn(VERSION, F.lit(version)), list(keys), last) if order else changes.dropDuplicates(list(keys)).withColumn(VERSION, F.lit(version))
    new = materialise(new.withColumn(BUCKET, _bucket(keys, buckets)), "changes")
    touched = sorted(r[BUCKET] for r in new.select(BUCKET).distinct().collect())  # at most ``buckets`` numbers
    if not touched:
        return 0
    merged = new
    if path_exists(spark, path):
        schema = new.schema
        stored = spark.read.schema(schema).parquet(path).where(F.col(BUCKET).isin(touched))
        both = new.withColumn("__new", F.lit(1)).unionByName(stored.withColumn("__new", F.lit(0)))
        merged = best_per_key(both, list(keys), [F.desc(VERSION), F.desc("__new")]).drop("__new")
        merged = materialise(merged.select(*schema.names), "merged")
    out = merged.hint("rebalance", F.col(BUCKET))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    return len(touched)
