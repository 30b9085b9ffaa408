"""Property graph of people as two tables.

nodes(label, key, …)   edges(src, type, dst, …)

An edge joins a person (src) to an item (dst) of the type's target label.
Edges are unique per (src, type, dst), so a question about a person or an item
is a filter, an equi join and a pre-aggregated count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.operators.quality import duplicate_keys
from edupipe.operators.relational import having_any
from edupipe.session import materialise


def upsert_nodes(
    df: DataFrame, label: str, key: str, properties: Sequence[str] = (), order: Sequence[Column] = ()
) -> DataFrame:
    """One node per trimmed, non-null key; of each property the last value by ``order``."""
    rows = df.withColumn("__key", F.trim(F.col(key).cast("string"))).where(F.col("__key").isNotNull())
    grouped = rows.groupBy(F.col("__key").alias("key"))
    if not properties:
        nodes = grouped.agg(F.lit(label).alias("label"))
    else:
        last = F.struct(*order)
        nodes = grouped.agg(F.lit(label).alias("label"), *[F.max_by(p, last).alias(p) for p in properties])
    return nodes.select("label", "key", *properties)


def repeated_nodes(nodes: DataFrame) -> DataFrame:
    """(label, key, n) of node keys that are not unique within their label."""
    return duplicate_keys(nodes, ["label", "key"])


def upsert_edges(
    df: DataFrame, kind: str, src: str, dst: str, properties: Sequence[str] = (), order: Sequence[Column] = ()
) -> DataFrame:
    """One edge per (src, type, dst); null ends are left out; the last property values win."""
    rows = df.where(F.col(src).isNotNull() & F.col(dst).isNotNull())
    grouped = rows.groupBy(F.col(src).alias("src"), F.col(dst).alias("dst"))
    if not properties:
        edges = grouped.agg(F.lit(kind).alias("type"))
    else:
        last = F.struct(*order)
        edges = grouped.agg(F.lit(kind).alias("type"), *[F.max_by(p, last).alias(p) for p in properties])
    return edges.select("src", "type", "dst", *properties)


def edges_of_columns(df: DataFrame, src: str, targets: Mapping[str, str]) -> DataFrame:
    """Unique (src, type, dst) edges of several types from one pass over the rows.

    targets: edge type -> column with its target; the columns have one common type.
    """
    ends = F.array(*[F.struct(F.lit(kind).alias("type"), F.col(c).alias("dst")) for kind, c in targets.items()])
    rows = df.select(F.col(src).alias("src"), F.explode(ends).alias("e"))
    return rows.select("src", "e.type", "e.dst").where("src is not null and dst is not null").distinct()


def union_edges(parts: Sequence[DataFrame]) -> DataFrame:
    """All edge types in one (src, type, dst) table.

    Whole-number ends stay numbers, so that a filter on an end reaches the scan; ends of
    other or mixed types become text.
    """
    def common(end: str) -> str:
        return "bigint" if all(dict(p.dtypes)[end] in ("tinyint", "smallint", "int", "bigint") for p in parts) else "string"

    src, dst = common("src"), common("dst")
    typed = [p.select(F.col("src").cast(src), "type", F.col("dst").cast(dst)) for p in parts]
    return reduce(DataFrame.unionByName, typed)


def top_targets(edges: DataFrame, n: int, name: str, count: str) -> DataFrame:
    """The ``n`` targets with the most people (ties by name)."""
    return (
        edges.groupBy(F.col("dst").alias(name))
        .agg(F.count("*").alias(count))
        .orderBy(F.desc(count), name)
        .limit(n)
    )


def _people_with(edges: DataFrame, item) -> DataFrame:
    return edges.where(F.col("dst") == item).select("src")


def top_targets_for_item(item_edges: DataFrame, item, target_edges: DataFrame, n: int, name: str, count: str) -> DataFrame:
    """Where the people with ``item`` point to through another edge type, the ``n`` most common."""
    return top_targets(having_any(target_edges, "src", _people_with(item_edges, item), "src"), n, name, count)


def related_items(edges: DataFrame, item, n: int, name: str, count: str) -> DataFrame:
    """Items that occur most often with ``item`` at the same person."""
    others = having_any(edges.where(F.col("dst") != item), "src", _people_with(edges, item), "src")
    return top_targets(others, n, name, count)


def _key(edges: DataFrame, person) -> Column:
    """A person's key in the type of the edges; a column (such as a scalar subquery) is cast to it."""
    return (person if isinstance(person, Column) else F.lit(person)).cast(edges.schema["src"].dataType)


def common_neighbours(
    edges: DataFrame, recipients: DataFrame, target, scholarship, n: int = fv.TOP_ITEMS,
    types: Sequence[str] = tuple(fv.SIMILARITY_EDGES),
) -> DataFrame:
    """Holders of a scholarship by the number of items they share with one person.

    ``recipients`` are HAS_SCHOLARSHIP edges.  A target who holds any scholarship
    has no result.  Holders without a shared item stay with score 0.
    """
    recipients = recipients.withColumn("src", F.col("src").cast(edges.schema["src"].dataType))
    target = _key(edges, target)
    holders = recipients.where((F.col("dst") == scholarship) & (F.col("src") != target)).select("src").distinct()
    target_holds = F.coalesce(recipients.where(F.col("src") == target).agg(F.max(F.lit(True))).scalar(), F.lit(False))
    known = edges.where(F.col("type").isin(list(types)))
    # the person's few items first: the key reaches the scan, and all other edges are met by what it left
    own_items = materialise(known.where(F.col("src") == target).select("type", "dst"), "own")
    shared = (
        known.where(F.col("src") != target)
        .join(own_items, ["type", "dst"], "left_semi")
        .groupBy("src")
        .agg(F.count("*").alias("n"))
    )
    return (
        holders.where(~target_holds)
        .join(shared, "src", "left")
        .select(F.col("src").cast("string").alias("person"), F.coalesce("n", F.lit(0)).alias("total_matches"))
        .orderBy(F.desc("total_matches"), "person")
        .limit(n)
    )


def edge_weight(kind: Column, weights: Mapping[str, float]) -> Column:
    """Weight of an edge type; types without a weight count nothing."""
    (first, w), *rest = weights.items()
    chain = F.when(kind == first, F.lit(float(w)))
    return reduce(lambda c, item: c.when(kind == item[0], F.lit(float(item[1]))), rest, chain)


def profile_similarity(
    edges: DataFrame, target, n: int, weights: Mapping[str, float] = fv.EDGE_WEIGHTS
) -> DataFrame:
    """Cosine between one person's weighted items and everyone else's.

    The person's items, found by a filter that reaches the scan, are joined to all edges; norm and dot
    product come from one pre-aggregated pass, so nothing of size people × people arises.
    """
    target = _key(edges, target)
    weighted = edges.withColumn("w", edge_weight(F.col("type"), weights)).where("w is not null")
    own = materialise(weighted.where(F.col("src") == target).select("type", "dst", F.col("w").alias("own_w")), "own")
    own_norm = F.sqrt(own.agg(F.sum(F.col("own_w") * F.col("own_w"))).scalar())
    others = weighted.where(F.col("src") != target)
    return (
        others.join(own, ["type", "dst"], "left")
        .groupBy(F.col("src").cast("string").alias("person"))
        .agg(F.sum(F.col("w") * F.col("own_w")).alias("dot"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
        .where("dot is not null")
        .select("person", (F.col("dot") / (F.col("norm") * own_norm)).alias("score"))
        .orderBy(F.desc("score"), "person")
        .limit(n)
    )


def person_status(people: DataFrame, key: str, scholarships: DataFrame, owner: str, name: str) -> DataFrame:
    """Every person with ``alumni`` or ``user`` and the first scholarship name, if any.

    The names are reduced to one per person before the join.
    """
    first = scholarships.groupBy(F.col(owner).alias("__owner")).agg(F.min(name).alias("scholarship_id"))
    return (
        people.join(first, F.col(key) == F.col("__owner"), "left")
        .withColumn("status", F.when(F.col("__owner").isNotNull(), "alumni").otherwise("user"))
        .drop("__owner")
    )
