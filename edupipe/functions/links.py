"""Web addresses in text and in link lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.functions.text import filled


def _address_pattern(start: str, domains: Sequence[str]) -> str:
    host = "|".join(domains)
    tail = rf"(?:/[^.,;)\s]*)?(?:\.(?:{fv.URL_EXTENSIONS}))?/?(?=[.,;)\s]|\z)"
    return rf"(?iuU){start}(?:{host}){tail}"


def _tidy(url: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(url, fv.URL_NOISE, ""), fv.URL_TRAILING, "")
    bare = F.regexp_replace(bare, r"/+\z", "")
    return F.when(bare.rlike(r"^https?://"), bare).when(bare != "", F.concat(F.lit("https://"), bare))


def extract_websites(
    texts: Sequence[Column],
    domains: Sequence[str] = tuple(fv.URL_DOMAINS),
    keep: str = fv.URL_KEEP,
    special_words: Sequence[str] = tuple(fv.URL_SPECIAL_WORDS),
    special_default: str = fv.URL_SPECIAL_DEFAULT,
) -> Column:
    """Addresses on known domains, sorted and joined by ``; ``.

    Without any, a text naming one of ``special_words`` gets ``special_default``.
    """
    text = F.concat_ws(" ", *[F.nullif(t, F.lit("")) for t in texts])
    found = F.array_union(
        F.regexp_extract_all(text, F.lit(_address_pattern(r"https?://(?:www\.)?", domains)), 0),
        F.regexp_extract_all(text, F.lit(_address_pattern(r"www\.", domains)), 0),
    )
    kept = F.filter(F.transform(found, _tidy), lambda u: u.isNotNull() & u.rlike(keep))
    joined = F.array_join(F.array_sort(F.array_distinct(kept)), "; ")
    named = F.lit(False)
    for word in special_words:
        named = named | F.contains(F.lower(text), F.lit(word))
    return F.coalesce(
        filled(joined), F.when(named, F.lit(special_default)), F.lit(fv.NOT_SPECIFIED)
    )


def without_trailing_slash(c: Column) -> Column:
    return F.regexp_replace(c, r"/+\z", "")


def with_main_link(links: Column, main: Column) -> Column:
    """Distinct links, the main link first when it is missing (a trailing ``/`` does not count)."""
    distinct = F.array_distinct(links)
    present = F.array_contains(F.transform(distinct, without_trailing_slash), without_trailing_slash(main))
    return F.when(present, distinct).otherwise(F.concat(F.array(main), distinct))
