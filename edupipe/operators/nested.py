"""Arrays of structs across rows: explode, keep the best per key, rebuild."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edupipe.operators.dedupe import best_per_key


def explode_keep_empty(df: DataFrame, array: str, into: str) -> DataFrame:
    """One row per element; a null or empty array gives one row with a null element."""
    return df.withColumn(into, F.explode_outer(array)).drop(array)


def facet(df: DataFrame, owner: str, array: str, fields: Mapping[str, str]) -> DataFrame:
    """(owner, fields…) for every element; ``fields`` maps output name to element field."""
    return df.select(owner, F.explode(array).alias("__e")).select(
        owner, *[F.col(f"__e.{source}").alias(name) for name, source in fields.items()]
    )


def facet_two_level(
    df: DataFrame, owner: str, outer: str, inner: str, outer_fields: Mapping[str, str], inner_fields: Mapping[str, str]
) -> DataFrame:
    """As :func:`facet`, one row per element of an array inside each element."""
    elements = df.select(owner, F.explode(outer).alias("__o")).select(
        owner,
        *[F.col(f"__o.{source}").alias(name) for name, source in outer_fields.items()],
        F.explode(F.col(f"__o.{inner}")).alias("__i"),
    )
    return elements.select(
        owner, *outer_fields, *[F.col(f"__i.{source}").alias(name) for name, source in inner_fields.items()]
    )


def merge_same_key(
    df: DataFrame,
    key: str,
    arrays: Mapping[str, tuple[str, Sequence[str]]],
    scalars: Sequence[str],
    order: Sequence[Column],
) -> DataFrame:
    """Merge the rows that share ``key`` (null included) into one.

    arrays:  array column -> (element field that must stay unique, at most one
             greater-is-better field)
    scalars: the first non-null value by ``order`` is kept

    All arrays are reduced in one pass to one element per (key, element field),
    map side first, before any is rebuilt: what is collected per key is bounded by
    the distinct names, not by the rows.
    """
    first = F.struct(*order)
    owner = F.col(key).alias("__key")
    no_rank = F.lit(None).cast("double")

    def slots(filled: str, value: Column) -> list[Column]:
        """One column per array and one for the scalars, all null but one."""
        types = {array: df.schema[array].dataType.elementType for array in arrays}
        types["__row"] = T.StructType([df.schema[c] for c in scalars])
        return [(value if name == filled else F.lit(None)).cast(kind).alias(name) for name, kind in types.items()]

    def elements(array: str, field: str, better: Sequence[str]) -> DataFrame:
        e = F.col("__e")
        rank = e[better[0]].cast("double") if better else no_rank
        exploded = df.select(owner, F.explode(array).alias("__e"))
        return exploded.select(
            "__key", F.lit(array).alias("__kind"), e[field].cast("string").alias("__field"), rank.alias("__rank"),
            F.to_json(e).alias("__text"), *slots(array, e),
        )

    kept_scalars = df.groupBy(owner).agg(
        F.struct(*[F.min_by(c, F.when(F.col(c).isNotNull(), first)).alias(c) for c in scalars]).alias("__s")
    )
    nothing = F.lit(None).cast("string")
    rows = kept_scalars.select(
        "__key", F.lit("__row").alias("__kind"), nothing.alias("__field"), no_rank.alias("__rank"),
        nothing.alias("__text"), *slots("__row", F.col("__s")),
    )
    for array, (field, better) in arrays.items():
        rows = rows.unionByName(elements(array, field, better))
    best = best_per_key(rows, ["__key", "__kind", "__field"], [F.col("__rank").desc_nulls_last(), F.asc("__text")])
    merged = best.groupBy("__key").agg(
        F.first("__row", ignorenulls=True).alias("__row"),
        *[F.sort_array(F.collect_list(array)).alias(array) for array in arrays],
    )
    filled = [F.when(F.size(array) > 0, F.col(array)).alias(array) for array in arrays]
    return merged.select(F.col("__key").alias(key), *[F.col("__row")[c].alias(c) for c in scalars], *filled)
