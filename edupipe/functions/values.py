"""Validation, canonical values, numbers, dates and rule-based labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.functions.text import clean_text, lower_trim


def canonical_value(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The value of the first matching pattern on the lower-cased, trimmed text; else null."""
    key = lower_trim(c)
    (pattern, value), *rest = rules
    first = F.when(key.rlike(pattern), F.lit(value))
    return reduce(lambda chain, rule: chain.when(key.rlike(rule[0]), F.lit(rule[1])), rest, first)


def canonical_level(c: Column) -> Column:
    return canonical_value(c, fv.LEVEL_PATTERNS)


def map_value(c: Column, mapping: Mapping[str, object]) -> Column:
    """Exact lookup in a short constant mapping; null when absent."""
    (key, value), *rest = mapping.items()
    first = F.when(c == key, F.lit(value))
    return reduce(lambda chain, item: chain.when(c == item[0], F.lit(item[1])), rest, first)


def required_level(program_level: Column) -> Column:
    return map_value(program_level, fv.REQUIRED_LEVEL)


def enum_or_null(c: Column, allowed: Sequence[str]) -> Column:
    key = lower_trim(c)
    return F.when(key.isin(list(allowed)), key)


def email_or_null(c: Column, pattern: str = fv.EMAIL_PATTERN) -> Column:
    return F.when(c.rlike(pattern), lower_trim(c))


def int_in_range_or_null(c: Column, low: int, high: int) -> Column:
    number = lenient_int(c)
    return F.when(number.between(low, high), number.cast("int"))


def lenient_int(c: Column) -> Column:
    """Whole or decimal number or text to a 64-bit integer, cut towards zero; anything else is null.

    Whole numbers are read as such, because a double holds them up to 2^53 only.
    """
    whole = c.cast("string").rlike(r"^\s*[+-]?\d+\s*$")
    return F.when(whole, c.try_cast("long")).otherwise(c.try_cast("double").try_cast("long"))


def first_number(c: Column, pattern: str = fv.DECIMAL_PATTERN, type_name: str = "float") -> Column:
    """The first number in a text; null without one (checked first: a failing cast is slow)."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1).try_cast(type_name))


def placeholder_default(c: Column, default: str = fv.NOT_SPECIFIED) -> Column:
    return F.when(c.isNull() | clean_text(c).isin(fv.CLEANED_PLACEHOLDERS), F.lit(default)).otherwise(c)


def parse_date(c: Column, fmt: str = fv.DATE_FORMAT) -> Column:
    return F.try_to_date(c, fmt)


def parse_timestamp(c: Column, fmt: str = fv.DATE_TIME_FORMAT) -> Column:
    return F.try_to_timestamp(c, F.lit(fmt))


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, fv.ISO_FORMAT)


def status_after_update(status: Column, deadline: Column, updated: Column) -> Column:
    """``closed`` when the deadline lies before the day of the last update, else unchanged."""
    return F.when(parse_date(deadline) < parse_timestamp(updated).cast("date"), F.lit("closed")).otherwise(status)


def status_as_of(deadline: Column, as_of: Column) -> Column:
    """``open`` when the deadline lies after ``as_of``; closed otherwise or if unreadable."""
    return F.when(parse_date(deadline) > as_of, F.lit("open")).otherwise(F.lit("closed"))


def is_covered(amount: Column) -> Column:
    text = lower_trim(F.coalesce(amount, F.lit("")))
    return ~text.isin("", fv.NOT_SPECIFIED)


def funding_category(coverage: Column) -> Column:
    """``fully funded`` when both tuition and monthly allowance are covered."""
    both = is_covered(F.try_element_at(coverage, F.lit("tuition"))) & is_covered(
        F.try_element_at(coverage, F.lit("monthly_allowance"))
    )
    return F.when(both, F.lit("fully funded")).otherwise(F.lit("partially funded"))


def field_of_study(code: Column) -> Column:
    return map_value(code, fv.FIELDS_OF_STUDY)


def reference_value_or_null(
    df: DataFrame, column: str, known: DataFrame, known_column: str, pattern: str
) -> DataFrame:
    """The lower-cased, trimmed value if it fits the pattern and is in the reference list, else null.

    The list is sent to every task: shuffled by the value, all rows of a common one would go to one task.
    """
    names = known.select(lower_trim(F.col(known_column)).alias("__known")).distinct()
    key = F.when(F.col(column).rlike(pattern), lower_trim(F.col(column)))
    return df.withColumn(column, key).join(F.broadcast(names), F.col(column) == F.col("__known"), "left").select(
        *[F.col("__known").alias(c) if c == column else F.col(c) for c in df.columns]
    )
