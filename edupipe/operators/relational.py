"""Relational split, bridges, enrichment and upserts.

No side is marked for broadcast here: dimensions are broadcast by Spark when
their measured size is below its threshold, and joined by shuffle beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edupipe.functions.text import lower_trim

FILTER_COLUMNS = ["scholarship_id", "funding_category", "program_level", "required_level", "intake", "status"]
INFO_COLUMNS = [
    "scholarship_id", "scholarship_name", "description", "program_country", "origin_country", "documents",
    "website", "last_updated_utc", "deadline", "scholarship_coverage", "language_certificates",
    "fields_of_study_code", "study_duration", "gpa", "list_of_universities", "other_information",
]


def split_columns(df: DataFrame, *column_sets: Sequence[str]) -> list[DataFrame]:
    """Vertical split: one narrow table per column set, each with its key."""
    return [df.select(*columns) for columns in column_sets]


def bridge_to_dimension(
    df: DataFrame, key: str, names: str, dimension: DataFrame, dimension_id: str, dimension_name: str
) -> DataFrame:
    """Distinct (key, dimension id) for every array element that names a dimension row.

    Pairs are made distinct before the join as well, so that a very common name
    meets the dimension once per key.
    """
    dim = dimension.select(dimension_id, lower_trim(F.col(dimension_name)).alias("__name")).distinct()
    pairs = df.select(key, F.explode(F.array_distinct(F.transform(names, lower_trim))).alias("__name"))
    return pairs.join(dim, "__name").select(key, dimension_id).distinct()


def bridge_values(df: DataFrame, key: str, values: str, into: str) -> DataFrame:
    """Distinct (key, value) pairs of an array column."""
    return df.select(key, F.explode(F.array_distinct(values)).alias(into)).distinct()


def enrich(df: DataFrame, other: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join: every row stays, with the other table's columns where the key matches."""
    return df.join(other, F.col(left_key) == F.col(right_key), "left").drop(right_key)


def having_any(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Rows whose key occurs in the other table.

    A plain semi join: without a ``distinct`` on the other side both sides are plain
    shuffles, and Spark splits a hot key itself.
    """
    return df.join(other.select(F.col(other_key).alias(key)), key, "left_semi")


def having_none(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """Rows whose key does not occur in the other table; a null key never does."""
    return df.join(other.select(F.col(other_key).alias(key)), key, "left_anti")


def cascade_delete(children: DataFrame, child_key: str, deleted: DataFrame, deleted_key: str) -> DataFrame:
    """Children left after their deleted parents are gone."""
    return having_none(children, child_key, deleted, deleted_key)


def insert_if_absent(target: DataFrame, incoming: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Target plus the incoming keys it lacks; of a repeated key the first by ``order``."""
    columns = [c for c in incoming.columns if c != key]
    first = F.struct(*order)
    firsts = incoming.groupBy(key).agg(*[F.min_by(c, first).alias(c) for c in columns])
    fresh = firsts.join(target.select(key), key, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def merge_records(
    sources: Sequence[DataFrame], key: str, order: Sequence[Sequence[Column]]
) -> DataFrame:
    """Union by key where a later source overwrites the columns it has, null included.

    Inside a source the last row by its ``order`` wins (columns of the same types
    in every source).  Columns a source does not have are left as they were.
    """
    setters: dict[str, list[int]] = {}
    for n, source in enumerate(sources):
        for c in source.columns:
            if c != key:
                setters.setdefault(c, []).append(n)
    parts = [
        source.withColumn("__at", F.struct(F.lit(n).alias("source"), *[c.alias(f"o{i}") for i, c in enumerate(by)]))
        for n, (source, by) in enumerate(zip(sources, order, strict=True))
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    last = [
        F.max_by(c, F.when(F.col("__at.source").isin(numbers), F.col("__at"))).alias(c) for c, numbers in setters.items()
    ]
    return union.groupBy(key).agg(*last)
