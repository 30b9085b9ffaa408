"""Row filters, projections and splits.  All of them stay inside one stage."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edupipe import fixed_values as fv
from edupipe.functions.text import lower_trim


def drop_placeholders(df: DataFrame, columns: Sequence[str], placeholders: Sequence[str] = tuple(fv.PLACEHOLDERS)) -> DataFrame:
    """Keep rows whose required fields are real values; a null drops the row too."""
    return df.where(reduce(lambda a, b: a & b, [~F.col(c).isin(list(placeholders)) for c in columns]))


def keep_allowed(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    return df.where(F.col(column).isin(list(allowed)))


def normalise_strings(df: DataFrame) -> DataFrame:
    """Lower-case and trim every string column, found by type."""
    return df.select(
        *[
            lower_trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def recent(df: DataFrame, ts: str, as_of: Column, interval: str) -> DataFrame:
    """Rows not older than ``interval`` at ``as_of``."""
    return df.where(F.col(ts) >= as_of - F.expr(f"interval {interval}"))


def within_retention(df: DataFrame, ts: str, as_of: Column, interval: str) -> DataFrame:
    """What stays after rows older than ``interval`` are removed; unknown times stay."""
    return df.where(F.coalesce(F.col(ts) >= as_of - F.expr(f"interval {interval}"), F.lit(True)))


def expired_folders(df: DataFrame, folder: str, as_of: Column, days: int) -> DataFrame:
    """Distinct date-named folders more than ``days`` days old; other names are skipped."""
    day = F.try_to_date(F.col(folder), "yyyy-MM-dd")
    return df.select(folder).distinct().where(F.datediff(as_of, day) > days)


def keep_listed(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """Rows whose value is in the list; the list may be of any size."""
    return df.join(listed.select(F.col(listed_column).alias(column)), column, "left_semi")


def drop_containing(df: DataFrame, column: str, fragment: str) -> DataFrame:
    """Drop rows whose text contains the fragment; nulls stay."""
    return df.where(~F.coalesce(F.contains(F.col(column), F.lit(fragment)), F.lit(False)))


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def require_rows(df: DataFrame, what: str = "data set") -> DataFrame:
    """Fail on an empty data set; looks at one row only."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def hash_bucket(key: Column, buckets: int) -> Column:
    """A repeatable bucket number from the key alone, whatever the partitioning."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") % buckets


def split_by_hash(df: DataFrame, key: str, buckets: int, first: int, names: tuple[str, str]) -> DataFrame:
    """Label each row with one of two groups: ``first`` of ``buckets`` go to the first."""
    in_first = hash_bucket(F.col(key), buckets) < first
    return df.withColumn("part", F.when(in_first, F.lit(names[0])).otherwise(F.lit(names[1])))
