"""Declared constraints as checks that return the violating rows, and run statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def outside_accepted(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Rows where the column is null or not an accepted value."""
    return df.where(F.col(column).isNull() | ~F.col(column).isin(list(accepted)))


def split_accepted(df: DataFrame, accepted: Mapping[str, Sequence[str]]) -> tuple[DataFrame, DataFrame]:
    """(rows fit to load, rows kept back with the names of the failing columns)."""
    failing = F.array_compact(
        F.array(
            *[
                F.when(F.col(c).isNull() | ~F.col(c).isin(list(values)), F.lit(c))
                for c, values in accepted.items()
            ]
        )
    )
    marked = df.withColumn("failing", failing)
    return marked.where(F.size("failing") == 0).drop("failing"), marked.where(F.size("failing") > 0)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(df: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-null key has no parent."""
    return df.where(F.col(key).isNotNull()).join(parents.select(F.col(parent_key).alias(key)), key, "left_anti")


def array_outside(df: DataFrame, array: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose array holds a value that is not allowed; null arrays pass."""
    allowed_array = F.array(*[F.lit(a) for a in allowed])
    return df.where(F.size(F.array_except(array, allowed_array)) > 0)


def vector_stats(df: DataFrame, vector: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("n_vectors"),
        F.min(F.size(vector)).alias("min_dimension"),
        F.max(F.size(vector)).alias("max_dimension"),
    )


def vector_sample(df: DataFrame, key: str, vector: str, metadata: Sequence[str], n: int = 3) -> DataFrame:
    """The first ``n`` vectors by key, with their dimension and metadata."""
    return df.orderBy(key).limit(n).select(key, F.size(vector).alias("dimension"), *metadata)


def run_stats(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """(name, value) rows of aggregates taken in one pass."""
    row = df.agg(*[m.cast("double").alias(n) for n, m in measures.items()])
    return row.unpivot([], list(measures), "name", "value")


def mark_outcome(df: DataFrame, json: str, schema: T.StructType) -> DataFrame:
    """Add ``parsed`` and ``outcome``: ``succeeded`` when the JSON fits the schema, else ``failed``."""
    spot = T.StructType([*schema.fields, T.StructField("__bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}
    broken = F.col("parsed").isNull() | F.col("parsed.__bad").isNotNull()
    parsed = df.withColumn("parsed", F.from_json(json, spot, options))
    return parsed.withColumn("outcome", F.when(broken, "failed").otherwise("succeeded"))


def quarantine(df: DataFrame, json: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows whose JSON fits the schema with its fields, rows whose JSON does not)."""
    marked = mark_outcome(df, json, schema)
    good = marked.where("outcome = 'succeeded'").select(*df.columns, *[F.col(f"parsed.{f.name}") for f in schema.fields])
    return good, marked.where("outcome = 'failed'").select(*df.columns)


def outcome_summary(marked: DataFrame) -> DataFrame:
    """(outcome, n_rows) in one pass."""
    return marked.groupBy("outcome").agg(F.count("*").alias("n_rows"))


def fail_if_none_succeeded(good: DataFrame) -> DataFrame:
    if good.isEmpty():
        raise RuntimeError("no record succeeded")
    return good


def observed_write(df: DataFrame, path: str, measures: Mapping[str, Column], partition: Sequence[str] = ()) -> dict[str, object]:
    """Write ``df`` and return aggregates of the rows written, taken by the write itself: nothing is read again."""
    seen = Observation()
    out = df.observe(seen, *[m.alias(n) for n, m in measures.items()])
    out.write.mode("overwrite").partitionBy(*partition).parquet(path)
    return seen.get


def write_outcomes(marked: DataFrame, path: str) -> dict[str, int]:
    """Write rows with their ``outcome`` (see ``mark_outcome``) to a folder for each; returns input, succeeded and failed rows."""
    count = lambda name: F.count(F.when(F.col("outcome") == name, 1))
    measures = {"input": F.count(F.lit(1)), "succeeded": count("succeeded"), "failed": count("failed")}
    return observed_write(marked, path, measures, ["outcome"])
