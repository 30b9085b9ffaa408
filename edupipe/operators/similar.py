"""The most similar people of every person, over weighted items.

A person is a sparse vector: an item has the whole-number weight of its edge type, similarity is the cosine.
All weights are positive, so what two people share so far bounds their similarity from below, and what the items
not yet looked at can add at most bounds it from above.

Rounds.  Items count in order of how many people have them, hubs last.  A round looks at whole items of
at most ``cap`` people, and of a hub at the ``cap`` people with the shortest profiles, in order of length and id: of
those who share only hubs with somebody, these are the most similar.  The k-th best sum that a person has
found by then is a threshold that its true neighbours reach; a person is done when nobody that it has not met can
reach it.  Its candidates that may still reach it get their exact score over the hubs.  The others go on with
a larger cap.  People are never paired with all people: pairs come from shared items, and a hub is used only as far as
it decides.

A person's items are sent to it with the people who have them, as lists, and added up in one place: the pairs
themselves are neither shuffled nor written, only those that can be among the best.  A round goes through its people in
slices, dealt by hash, and the lists of a slice are gone from the disk before those of the next one are sent.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.operators.dedupe import best_per_key
from edupipe.operators.graph import edge_weight
from edupipe.session import materialise

FIRST_CAP = 64
GROWTH = 16
PIECE = 1024  # people of an item in one row
SENT = 50_000_000  # people in the lists of a slice, or
SENT_PER_ROW = 4   # so many for each row of the vectors, whichever is more

ITEM = ["type", "dst"]


def profile_vectors(edges: DataFrame, weights: Mapping[str, int] = fv.EDGE_WEIGHTS) -> DataFrame:
    """(src, type, dst, w, norm2, people): a row per person and item, which ``people`` have."""
    weighted = edges.select("src", *ITEM, edge_weight(F.col("type"), weights).cast("long").alias("w")).where("w > 0").distinct()
    weighted = materialise(weighted, "profiles")
    norms = materialise(weighted.groupBy("src").agg(F.sum(F.col("w") * F.col("w")).alias("norm2")), "norms")
    vectors = materialise(weighted.join(norms, "src"), "vectors")
    # counted first and read back plainly, so that Spark can split a hub
    items = vectors.groupBy(*ITEM).agg(F.count("*").alias("people"))
    return materialise(vectors.join(materialise(items, "items"), ITEM), "vectors")


def _lists(vectors: DataFrame, cap: int) -> DataFrame:
    """(type, dst, hub, last, others, norms): the first ``cap`` people of every item, by length and id, in pieces.

    ``hub``: more people have the item.  ``last``: the piece that ends at the cap of a hub.
    """
    at = F.row_number().over(Window.partitionBy(*ITEM).orderBy("norm2", "src"))
    first = vectors.select(*ITEM, "src", "norm2", "people").withColumn("at", at).where(F.col("at") <= cap)
    piece = F.floor((F.col("at") - 1) / PIECE).alias("piece")
    rows = F.sort_array(F.collect_list(F.struct("norm2", "src")))
    hub = F.first("people") > cap
    listed = first.groupBy(*ITEM, piece).agg(hub.alias("hub"), (hub & (F.max("at") == cap)).alias("last"), rows.alias("rows"))
    return listed.select(*ITEM, "hub", "last", F.col("rows.src").alias("others"), F.col("rows.norm2").alias("norms"))


def _hub_bound(norm2: int, hubs: list[tuple]) -> float:
    """The greatest score of somebody who shares only hubs with a person, and comes after the cap in all that are shared.

    hubs: (norm2 of the last one looked at, squared weight of the item); who comes later is not shorter.
    """
    ends = np.array(sorted(hubs), np.int64)
    return float((np.cumsum(ends[:, 1]) / np.sqrt((norm2 * ends[:, 0]).astype(np.float64))).max())


def _able(src, norm2: int, parts: list[tuple], k: int | None) -> tuple | None:
    """(others, dots over whole items, norms) that may be among the ``k`` best of a person; None when strangers may be.

    parts: (w, hub, last, others, norms) of its items.  Without ``k`` all that it meets.
    """
    ids = np.concatenate([p[3] for p in parts])
    sizes = [len(p[3]) for p in parts]
    squares = np.repeat([p[0] * p[0] for p in parts], sizes)
    whole = np.repeat([not p[1] for p in parts], sizes)
    others, at, inverse = np.unique(ids, return_index=True, return_inverse=True)
    norms = np.concatenate([p[4] for p in parts])[at]
    seen = np.bincount(inverse, squares, len(others))  # whole numbers
    dots = np.bincount(inverse, squares * whole, len(others))
    met = others != src
    others, norms, seen, dots = others[met], norms[met], seen[met], dots[met]
    if k is None:
        return others, dots.astype(np.int64), norms
    hubs = [p for p in parts if p[2]]
    lengths = np.sqrt((norm2 * norms).astype(np.float64))
    if len(others) < k:
        return None if hubs else (others, dots.astype(np.int64), norms)
    low = seen / lengths
    least = np.partition(low, -k)[-k]
    last = others[low == least][k - 1 - int((low > least).sum())]  # ids ascend
    if hubs:
        bound = _hub_bound(norm2, [(p[4][-1], p[0] * p[0]) for p in hubs])
        # of equal scores the lesser id counts, and who comes after the cap with the same length has a greater one
        if bound > least or (bound == least and last > min(p[3][-1] for p in hubs)):
            return None
    high = (dots + sum(p[0] * p[0] for p in hubs)) / lengths
    able = (high > least) | ((high == least) & (others <= last))
    return others[able], dots[able].astype(np.int64), norms[able]


def partial_scores(vectors: DataFrame, probes: DataFrame, cap: int, k: int | None = None) -> DataFrame:
    """``_added`` for some people at once."""
    lists = materialise(_lists(vectors if k is not None else vectors.where(F.col("people") <= cap), cap), "lists")
    return _added(vectors.join(probes, "src", "left_semi"), lists, k)


def _added(vectors: DataFrame, lists: DataFrame, k: int | None) -> DataFrame:
    """(src, other, dot, norm2, other_norm2) of people who share an item, with the sums over items of at most ``cap`` people.

    With ``k`` only pairs that may be among the ``k`` best of ``src``, those met in the heads of hubs included; a
    person whom this does not decide has one row without ``other``.  Without ``k`` all pairs that meet over such items.
    """
    mine = vectors.select("src", *ITEM, "w", "norm2")
    sent = mine.join(lists, ITEM).select("src", "norm2", "w", "hub", "last", "others", "norms")
    kind = vectors.schema["src"].dataType.simpleString()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given(rows: list[tuple]) -> pa.RecordBatch:
            columns = [
                pa.concat_arrays([pa.array(np.repeat(np.array([r[0]], dtype=r[2].dtype), len(r[2])), id_type) for r in rows]),
                pa.concat_arrays([pa.array(r[2], id_type) if r[5] else pa.nulls(1, id_type) for r in rows]),
                pa.array(np.concatenate([r[3] for r in rows])), pa.array(np.concatenate([np.full(len(r[2]), r[1]) for r in rows])),
                pa.array(np.concatenate([r[4] for r in rows])),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["src", "other", "dot", "norm2", "other_norm2"])

        def finished(src, norm2: int, parts: list[tuple]) -> tuple:
            able = _able(src, norm2, parts, k)
            if able is not None:
                return src, norm2, *able, True
            one = np.array([src], dtype=parts[0][3].dtype)
            return src, norm2, one, np.zeros(1, np.int64), np.zeros(1, np.int64), False

        person, parts, rows, held, id_type = None, [], [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            id_type = batch.column("src").type
            people, norm2s, w = (batch.column(c).to_pylist() for c in ("src", "norm2", "w"))
            hub, last = (batch.column(c).to_pylist() for c in ("hub", "last"))
            starts = batch.column("others").offsets.to_numpy()
            others, norms = (batch.column(c).values.to_numpy(zero_copy_only=False) for c in ("others", "norms"))
            for i, src in enumerate(people):
                if person is None or src != person[0]:
                    if parts:
                        rows.append(finished(*person, parts))
                        held += len(rows[-1][2])
                        if held >= 65_536:
                            yield given(rows)
                            rows, held = [], 0
                    person, parts = (src, norm2s[i]), []
                span = slice(starts[i], starts[i + 1])
                parts.append((w[i], hub[i], last[i], others[span], norms[span]))
            parts = [(*p[:3], p[3].copy(), p[4].copy()) for p in parts]  # the batch is let go
        if parts:
            rows.append(finished(*person, parts))
        if rows:
            yield given(rows)

    ordered = sent.repartition("src").sortWithinPartitions("src")
    return ordered.mapInArrow(add, f"src {kind}, other {kind}, dot long, norm2 long, other_norm2 long")


def _score(dot: str = "dot"):
    return F.col(dot) / F.sqrt((F.col("norm2") * F.col("other_norm2")).cast("double"))


def _sliced(vectors: DataFrame, probes: DataFrame | None, k: int, cap: int) -> DataFrame:
    """``partial_scores``, written slice by slice; everybody where there are no ``probes``."""
    lists = materialise(_lists(vectors, cap), "lists")
    mine = vectors if probes is None else materialise(vectors.join(probes, "src", "left_semi"), "mine")
    size = mine.agg(F.sum(F.least("people", F.lit(cap))).alias("sent"), F.count("*").alias("rows")).first()
    slices = max(1, -(-(size["sent"] or 0) // max(SENT, SENT_PER_ROW * size["rows"])))
    parts = []
    for i in range(slices):
        some = mine.where(F.pmod(F.xxhash64("src"), F.lit(slices)) == i) if slices > 1 else mine
        parts.append(materialise(_added(some, lists, k), "partial"))
    return reduce(DataFrame.unionByName, parts)


def _round(vectors: DataFrame, probes: DataFrame | None, k: int, cap: int) -> tuple[DataFrame, DataFrame]:
    """(neighbours of the people who are done, the people who are not), of ``probes`` or of everybody."""
    partial = _sliced(vectors, probes, k, cap)
    able = partial.where("other IS NOT NULL")
    hubs = vectors.where(F.col("people") > cap)
    mine = hubs.select("src", *ITEM, "w")
    theirs = hubs.select(F.col("src").alias("other"), *ITEM, F.col("w").alias("other_w"))
    more = able.select("src", "other").join(mine, "src").join(theirs, ["other", *ITEM])
    more = more.groupBy("src", "other").agg(F.sum(F.col("w") * F.col("other_w")).alias("more"))
    exact = able.join(more, ["src", "other"], "left").withColumn("dot", F.col("dot") + F.coalesce("more", F.lit(0)))
    found = best_per_key(exact.select("src", "other", _score().alias("score")), ["src"], [F.desc("score"), F.asc("other")], k)
    return found, partial.where("other IS NULL").select("src")


def most_similar(
    edges: DataFrame, k: int = fv.TOP_ITEMS, weights: Mapping[str, int] = fv.EDGE_WEIGHTS, first_cap: int = FIRST_CAP, growth: int = GROWTH
) -> DataFrame:
    """(src, other, score): the ``k`` most similar people of every person, ties by the lesser id.

    edges(src, type, dst); repeated edges count once, edges without a weight nothing.  People who share nothing with anybody
    have no row.  Exact.
    """
    vectors = profile_vectors(edges, weights)
    largest = vectors.agg(F.max("people")).first()[0] or 0
    found, cap, probes = [], first_cap, None
    while True:
        done, open_ = _round(vectors, probes, k, cap)
        found.append(materialise(done, "similar"))
        if cap >= largest or open_.isEmpty():
            break
        probes, cap = materialise(open_, "people"), cap * growth
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result
