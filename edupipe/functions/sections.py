"""Sections of free text: what stands between a heading line and the next known heading.

A heading and its stops are lists of words (``fixed_values``); the pattern is
made from them here, and one expression serves every section.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.functions.text import filled, strip_all

_LINE = r"\n"
_COLON_OR_LINE = r"\s*(?:\n|:)"


@dataclass(frozen=True)
class Section:
    """One way to find a section.

    own_line: the heading must be preceded by a line break
    colon:    headings and stops may end in a colon, and the text may end the section
    """

    headings: Sequence[str]
    stops: Sequence[str]
    own_line: bool = True
    colon: bool = False

    @property
    def opening(self) -> str:
        line = r"\n" if self.own_line else ""
        return f"{line}(?:{'|'.join(self.headings)}){_COLON_OR_LINE if self.colon else _LINE}"

    @property
    def pattern(self) -> str:
        """Opening, then whole lines up to the first stop line; no backtracking over the text."""
        ending = _COLON_OR_LINE if self.colon else _LINE
        stop = rf"\n(?:{'|'.join(self.stops)}){ending}"
        must_stop = "" if self.colon else f"(?={stop})"
        return rf"(?iu){self.opening}[^\n]*+(?:(?!{stop})\n[^\n]*+)*+{must_stop}"

    def body(self, text: Column) -> Column:
        """Stripped body; '' for an empty section, null when the section is absent."""
        found = F.get(F.regexp_extract_all(text, F.lit(self.pattern), 0), F.lit(0))
        return strip_all(F.regexp_replace(found, rf"(?iu)\A{self.opening}", ""))


def extract_section(
    attempts: Sequence[tuple[Column, Section]],
    *,
    skip_empty: bool = False,
    null_if_null: Column | None = None,
    default: str = fv.NOT_SPECIFIED,
) -> Column:
    """The first attempt that finds a section; ``default`` when none does.

    skip_empty: a found but empty section does not count
    null_if_null: the result is null whenever this column is
    """
    bodies = [section.body(text) for text, section in attempts]
    if skip_empty:
        bodies = [filled(body) for body in bodies]
    value = F.coalesce(*bodies, F.lit(default))
    return value if null_if_null is None else F.when(null_if_null.isNotNull(), value)


def description(overview: Column) -> Column:
    return extract_section(
        [
            (overview, Section(fv.DESCRIPTION_HEADINGS, fv.DESCRIPTION_STOPS, own_line=False)),
            (overview, Section(fv.OBJECTIVE_HEADINGS, fv.OBJECTIVE_STOPS, own_line=False)),
        ],
        null_if_null=overview,
    )


def funding_info(overview: Column) -> Column:
    return extract_section(
        [
            (overview, Section(fv.VALUE_HEADINGS, fv.VALUE_STOPS)),
            (overview, Section(fv.FUNDED_HEADINGS, fv.FUNDED_STOPS)),
        ],
        null_if_null=overview,
    )


def duration(overview: Column) -> Column:
    return extract_section(
        [
            (overview, Section(fv.DURATION_HEADINGS, fv.DURATION_STOPS)),
            (overview, Section(fv.FUNDING_DURATION_HEADINGS, fv.FUNDING_DURATION_STOPS)),
        ],
        null_if_null=overview,
    )


def deadline(procedure: Column, overview: Column) -> Column:
    sources = [(procedure, fv.DEADLINE_PROCEDURE_STOPS), (overview, fv.DEADLINE_OVERVIEW_STOPS)]
    attempts = [
        (text, Section([heading], stops, own_line=False, colon=True))
        for text, stops in sources
        for heading in fv.DEADLINE_HEADINGS
    ]
    return extract_section(attempts, skip_empty=True)


def _given(c: Column) -> Column:
    """The stripped text of a filled-in field; null for null, blank or ``N/A``."""
    return F.when(c != "N/A", filled(strip_all(c)))


def requirements(application_requirements: Column, overview: Column) -> Column:
    section = Section(fv.REQUIREMENT_HEADINGS, fv.REQUIREMENT_STOPS)
    return F.coalesce(_given(application_requirements), extract_section([(overview, section)]))


def documents(procedure: Column, overview: Column) -> Column:
    listed = [
        filled(Section([heading], fv.DOCUMENT_STOPS, colon=True).body(procedure))
        for heading in fv.DOCUMENT_HEADINGS
    ]
    papers = extract_section([(overview, Section(fv.PAPER_HEADINGS, fv.PAPER_STOPS))])
    return F.coalesce(F.when(_given(procedure).isNotNull(), F.coalesce(*listed)), papers)
