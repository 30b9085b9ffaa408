"""Text cleaning and assembly."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def lower_trim(c: Column) -> Column:
    return F.lower(F.trim(c))


def strip_all(c: Column) -> Column:
    """Strip every kind of blank, line breaks included (``trim`` strips spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def filled(c: Column) -> Column:
    """The text, or null when empty.  Unlike ``nullif`` this evaluates a costly text once."""
    return F.get(F.filter(F.array(c), lambda x: x != ""), F.lit(0))


def clean_text(c: Column) -> Column:
    """Lower-case and trim; any run of two or more blanks becomes one space."""
    return F.regexp_replace(F.trim(F.lower(c)), r"\s{2,}", " ")


def strip_suffix(c: Column, pattern: str) -> Column:
    return F.regexp_replace(c, pattern, "")


def after_label(c: Column, label: str) -> Column:
    """The stripped text after ``label`` (up to its next occurrence); null without the label."""
    return strip_all(F.get(F.split(c, re.escape(label)), F.lit(1)))


def list_text(c: Column) -> Column:
    """An array written as ``['a', 'b']``; null arrays as ``[]``."""
    quoted = F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def compose_text(cols: Sequence[Column]) -> Column:
    """Non-empty fields, lower-cased and joined by a space."""
    return F.lower(F.concat_ws(" ", *[F.nullif(c.cast("string"), F.lit("")) for c in cols]))


def composite_key(prefix: str, *parts: Column) -> Column:
    return F.concat_ws(":", F.lit(prefix), *[p.cast("string") for p in parts])


def key_part(key: Column, position: int) -> Column:
    return F.get(F.split(key, ":"), F.lit(position))


def labelled_sections(sections: Sequence[tuple[str, Column]]) -> Column:
    """``LABEL:\\nvalue`` blocks separated by an empty line; null values are empty."""
    blocks = [
        F.concat(F.lit(f"{label}:\n"), F.coalesce(value.cast("string"), F.lit("")))
        for label, value in sections
    ]
    return F.concat_ws("\n\n", *blocks)


def fill_template(template: str, payload: Column, slot: str = "{payload}") -> Column:
    return F.replace(F.lit(template), F.lit(slot), payload)
