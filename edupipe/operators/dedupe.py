"""One row per key, grouping, and counts.

A key may hold a large share of all rows.  Everything here therefore shrinks on
the map side first: ``row_number() = 1`` lets Spark keep one row per key and
task before the shuffle (WindowGroupLimit), and aggregates are partial.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.functions.values import first_number, map_value
from edupipe.session import materialise


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], limit: int = 1) -> DataFrame:
    """The first ``limit`` rows of every key.  ``order`` must be total to be repeatable."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(window)).where(F.col("__n") <= limit).drop("__n")


def highest_rank(
    df: DataFrame, keys: Sequence[str], level: str, ranks: Mapping[str, int], ties: Sequence[Column]
) -> DataFrame:
    """Row with the highest-ranked level per key; unknown levels rank 0."""
    rank = F.coalesce(map_value(F.col(level), ranks), F.lit(0))
    return best_per_key(df, keys, [rank.desc(), *ties])


def latest(df: DataFrame, keys: Sequence[str], when: str, ties: Sequence[Column]) -> DataFrame:
    return best_per_key(df, keys, [F.col(when).desc_nulls_last(), *ties])


def longest(
    df: DataFrame, keys: Sequence[str], text: str, ties: Sequence[Column], pattern: str = fv.DIGITS_PATTERN
) -> DataFrame:
    """Row with the largest number read from a text; rows without a number come last."""
    return best_per_key(df, keys, [first_number(F.col(text), pattern).desc_nulls_last(), *ties])


def collapse_to_list(
    df: DataFrame, keys: Sequence[str], listed: str, into: str, rest: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key: the sorted distinct values of ``listed``, and the other columns
    of the first row by ``order``.

    The array holds distinct values only (a domain such as country names).
    """
    first_row = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*keys).agg(
        F.array_sort(F.collect_set(listed)).alias(into),
        *[F.min_by(c, first_row).alias(c) for c in rest],
    )


def collect_snippets(df: DataFrame, keys: Sequence[str], position: str, text: str, separator: str = "\n") -> DataFrame:
    """One row per group: its texts in order of position (then text), joined.

    The payload of a group is one text, sent out as one prompt, so a group is as
    large as one text may be; it is gathered by the aggregation itself.
    """
    ordered = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(text).alias("t"))))
    return (
        df.groupBy(*keys)
        .agg(ordered.alias("__s"))
        .withColumn("payload", F.array_join(F.transform("__s", lambda s: s["t"]), separator))
        .drop("__s")
    )


def group_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Input rows, distinct groups and the surplus, from one pre-aggregated pass."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_groups"))
        .withColumn("n_duplicates", F.col("n_rows") - F.col("n_groups"))
    )


def count_back(df: DataFrame, keys: Sequence[str], counted: str, into: str) -> DataFrame:
    """Each row with the number of non-null ``counted`` values of its group.

    The counts are pre-aggregated, written once and joined back.  Read from files
    they are a plain side of the join, so Spark splits the rows of a hot group, and
    unlike a window no task holds a whole group.
    """
    counts = materialise(df.groupBy(*keys).agg(F.count(counted).alias(into)), "counts")
    counts = counts.withColumnsRenamed({k: f"__c_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"__c_{k}")) for k in keys]
    return df.join(counts, match, "left").drop(*[f"__c_{k}" for k in keys])
