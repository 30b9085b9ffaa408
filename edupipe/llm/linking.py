"""Connected components of a table of links, and streams of groups inside a task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edupipe.session import materialise


CONNECTED = 200_000   # nodes whose connections a task holds
ROUND_ROWS = 200_000  # links of one task of a round


def grouped(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of a partition sorted by its first ``n_keys`` columns, group by group; nothing is held."""
    rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
    return groupby(rows, itemgetter(*range(n_keys)) if n_keys > 1 else lambda row: (row[0],))


class Sets:
    """Union-find over whatever can be a dict key."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, x):
        parent, top = self.parent, x
        while (above := parent.get(top, top)) != top:
            top = above
        while (above := parent.get(x, x)) != top:
            parent[x] = top
            x = above
        return top

    def union(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def stars(sets: Sets) -> pa.RecordBatch:
    """What is connected so far: each member with the least one."""
    members = [x for x in sets.parent if sets.find(x) != x]
    return pa.RecordBatch.from_arrays([pa.array([sets.find(x) for x in members]), pa.array(members)], names=["a", "b"])


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links (a, b) of a task as stars around the least nodes; at most ``CONNECTED`` nodes are held."""
    sets = Sets()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sets.union(a, b)
        if len(sets.parent) > CONNECTED:
            yield stars(sets)
            sets.parent.clear()
    if sets.parent:
        yield stars(sets)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the least node of its component, for every node that has an edge.

    Rounds of large stars and small stars: every node hands its neighbours to the
    least of them, first the greater ones, then the lesser ones, until all edges lead to the least
    node of the component.  Each round is a few joins of a table of links with one row per
    node, which is read back from files, so that Spark can split a node with very many links.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    kind = dict(pairs.dtypes)["a"]
    stars = pairs.mapInArrow(contracted, f"a {kind}, b {kind}")  # what a task can join needs no round
    now = stars.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, state = materialise(now, "edges"), None
    while (found := _fingerprint(now)) != state:
        state = found
        tasks = max(1, -(-found[0] // ROUND_ROWS))  # a round over few links needs few tasks and files
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(tasks), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large.coalesce(tasks), "large")
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks), "least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialise(small.unionByName(least.withColumnRenamed("m", "v")).distinct().coalesce(tasks), "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u, 7))")).first())


def unique_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, whichever; the rows of a key are equal."""
    others = [F.first(c).alias(c) for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(*others)
