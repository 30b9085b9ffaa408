"""JSON text, declared-schema coercion and deterministic ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edupipe import fixed_values as fv
from edupipe.functions.text import filled, strip_all


def json_array_to_text(c: Column) -> Column:
    """A JSON array of texts becomes comma-joined; other text stays; a broken array is empty."""
    items = F.from_json(c, T.ArrayType(T.StringType()))
    return F.when(c.rlike(r"^\s*\["), F.concat_ws(", ", items)).otherwise(c)


def embedded_json(c: Column) -> Column:
    """The widest ``{...}`` inside a text; null when there is none."""
    return filled(F.regexp_extract(c, r"(?s)\{.*\}", 0))


def map_to_json(m: Column) -> Column:
    return F.to_json(m)


def values_as_text(m: Column) -> Column:
    return F.transform_values(m, lambda _, v: v.cast("string"))


def parse_object(json: Column, schema: T.StructType) -> Column:
    """The declared fields of a JSON object as texts, in one parse; containers keep their JSON."""
    return F.from_json(json, T.StructType([T.StructField(name, T.StringType()) for name in schema.names]))


def _coerced(raw: Column, data_type: T.DataType, default: str) -> Column:
    if isinstance(data_type, (T.ArrayType, T.MapType)):
        opening, empty = ("[", F.array()) if isinstance(data_type, T.ArrayType) else ("{", F.create_map())
        value = F.when(F.startswith(raw, F.lit(opening)), F.from_json(raw, data_type))
        return F.coalesce(value, empty.cast(data_type))
    if isinstance(data_type, T.StringType):
        return F.coalesce(F.nullif(raw, F.lit("")), F.lit(default))
    return raw.try_cast(data_type)


def coerced_fields(parsed: Column, schema: T.StructType, default: str = fv.NOT_SPECIFIED) -> Sequence[Column]:
    """One column per declared field of a :func:`parse_object` result.

    A wrong container gives an empty one; containers in a text field stay JSON;
    null and empty text become the default; other types are cast or null.
    """
    return [_coerced(parsed[f.name], f.dataType, default).alias(f.name) for f in schema.fields]


def field_or(json: Column, name: str, fallback: Column) -> Column:
    """A text field of a JSON object, or the fallback when it is missing or empty."""
    return F.coalesce(filled(F.get_json_object(json, f"$['{name}']")), fallback)


def deterministic_id(parts: Sequence[Column]) -> Column:
    """16 hex digits: SHA-256 over lower-cased, stripped parts joined by ``|``."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]), 256), 1, 16)


def id_text(c: Column) -> Column:
    return strip_all(F.lower(c))


def id_list(a: Column) -> Column:
    """Array part of an id: sorted, comma-joined, lower-cased."""
    return F.lower(F.array_join(F.array_sort(a), ","))


def scholarship_id(name: Column, countries: Column, level: Column, codes: Column) -> Column:
    return deterministic_id([id_text(name), id_list(countries), id_text(level), id_list(codes)])
