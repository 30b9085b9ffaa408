"""Array columns, treated inside their row: no explode, no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.functions.text import strip_all
from edupipe.functions.values import first_number, map_value

ColumnFn = Callable[[Column], Column]


def lower_array(a: Column) -> Column:
    empty = F.array().cast("array<string>")
    return F.coalesce(F.transform(a, lambda x: strip_all(F.lower(x))), empty)


def sorted_names(a: Column) -> Column:
    """Lower-cased, stripped, distinct and sorted; empty names dropped beforehand."""
    filled = F.filter(a, lambda x: x.isNotNull() & (x != ""))
    return F.array_sort(F.array_distinct(F.transform(filled, lambda x: strip_all(F.lower(x)))))


def longest_array(df: DataFrame, array: str) -> DataFrame:
    """One row: the longest array of the column (ties: greatest joined text)."""
    a = F.col(array)
    order = F.struct(F.size(a), F.array_join(a, ","))
    return df.where(a.isNotNull()).agg(F.max_by(a, order).alias(array))


def fill_from_longest(df: DataFrame, array: str) -> DataFrame:
    """Null and empty arrays take the longest array of the data set; all are sorted sets.

    The longest array reaches the rows as a scalar subquery: one value, no join.
    """
    fallback = longest_array(df, array).scalar()
    given = F.when(F.size(array) > 0, F.col(array))
    filled = df.withColumn(array, F.coalesce(given, fallback))
    return filled.withColumn(array, sorted_names(F.col(array)))


# --- best element per key ---------------------------------------------------


def descending_nulls_last(c: Column) -> Column:
    """A number whose ascending order is that of ``c`` descending with nulls at the end."""
    return F.coalesce(-c.cast("double"), F.lit(float("inf")))


def keep_best_in_array(
    df: DataFrame, array: str, key: ColumnFn, order: Sequence[ColumnFn] = ()
) -> DataFrame:
    """For each distinct key keep one element: the greatest by ``order``, then the first.

    The array is sorted once by (key, order, position) inside the row and the
    head of every run of equal keys is kept; survivors return to their first
    order.  Null and empty arrays become null.
    """
    def ranked(x: Column, i: Column) -> Column:
        ranks = [descending_nulls_last(fn(x)).alias(f"order{n}") for n, fn in enumerate(order)]
        return F.struct(key(x).alias("key"), *ranks, i.alias("pos"), x.alias("value"))

    runs = F.col("__runs")
    head = F.filter(
        runs,
        lambda x, i: (i == 0) | ~x["key"].eqNullSafe(F.get(runs, i - 1)["key"]),
    )
    back = F.sort_array(F.transform(head, lambda x: F.struct(x["pos"].alias("pos"), x["value"].alias("value"))))
    kept = F.when(F.size(runs) > 0, F.transform(back, lambda x: x["value"]))
    return (
        df.withColumn("__runs", F.sort_array(F.transform(F.col(array), ranked)))
        .withColumn(array, kept)
        .drop("__runs")
    )


def dedupe_in_array(df: DataFrame, array: str, key: str) -> DataFrame:
    return keep_best_in_array(df, array, lambda x: x[key])


def keep_highest_in_array(df: DataFrame, array: str, key: str, level: str, ranks: dict[str, int]) -> DataFrame:
    rank = lambda x: F.coalesce(map_value(x[level], ranks), F.lit(0))
    return keep_best_in_array(df, array, lambda x: x[key], [rank])


def keep_latest_in_array(df: DataFrame, array: str, key: str, when: str) -> DataFrame:
    return keep_best_in_array(df, array, lambda x: x[key], [lambda x: x[when]])


def keep_longest_in_array(
    df: DataFrame, array: str, key: str, inner: str, text: str, pattern: str = fv.DIGITS_PATTERN
) -> DataFrame:
    """Longest by the number in the first inner element's text."""
    length = lambda x: first_number(F.get(x[inner], F.lit(0))[text].cast("string"), pattern)
    return keep_best_in_array(df, array, lambda x: x[key], [length])
