"""Near duplicates by SimHash fingerprints and BK-trees.

A fingerprint has 64 bits: bit i is set when more than half of the text's shingles (of ``WORDS`` words,
repeats included) have it set in their XXH64.  Two documents link when their fingerprints differ in
``RADIUS`` bits at most.

*Shards.*  The 64 bits are cut into six blocks.  Fingerprints that differ in four bits agree in
two blocks at least, so every link lies in one of the fifteen shards families that two blocks name;
a shard is a pair of blocks and their value (21 or 22 bits).  Equal fingerprints are one.

*Trees.*  Each shard is a BK-tree: a child's key is its Hamming distance from its parent.  All
members ask for their neighbours together: at a node the distances of those that came so far
are taken at once, and each follows only the edges whose key is within the radius of its own distance.  What a task's
shards connect leaves it as one row for each fingerprint, with the least one it is connected to.

*Where the trees go.*  The trees of all documents together grow with the corpus, so they are not broadcast to
every task: a shard's tree is built in the task that the shard's key names, and its queries come there too.

*Very large shards* (more than ``SHARD``) are left out of the trees and solved by midpoints: fingerprints that
differ in four bits have a common neighbour at two bits from each, and all that share such a
neighbour link.  A row for each neighbour, a least member for each, no pairs: linear in the members,
split over tasks like any grouping.

Defined results.  Null and empty texts and texts of blanks have fingerprint zero, which links
like any other; with fewer words than a shingle the whole sequence is one.  Every row is a
document of its own (see ``common.keyed``); rows with equal texts link.  An empty table gives an
empty result.  Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edupipe.llm.common import KEY, keyed, whole_text
from edupipe.llm.linking import CONNECTED, Sets, components, stars
from edupipe.session import materialise

WORDS = 4
SEED = 42
RADIUS = 4
BLOCKS = (0, 11, 22, 33, 43, 54, 64)  # bounds of the six blocks: 11, 11, 11, 10, 11 and 10 bits
SHARD = 16_384                        # members of the largest tree
SEGMENT = 1 << 20                     # bytes of a text that are split into words at a time
HASHES = 1 << 16                      # hashes whose bits are counted at a time

blank = re.compile(rb"[\x20\x09-\x0D]")
FAMILIES = tuple(combinations(range(len(BLOCKS) - 1), 2))
MASKS = tuple(sum(((1 << BLOCKS[b + 1]) - (1 << BLOCKS[b])) for b in two) for two in FAMILIES)


def _hashes(words: list[bytes]) -> np.ndarray:
    """The hashes of the shingles of these words, or of all of them where they are fewer."""
    text = b" ".join(words)
    span = min(WORDS, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = len(words) - span + 1
    pieces = [text[x:y] for x, y in zip(starts[:n].tolist(), ends[span - 1 :].tolist())]
    return np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, n)


def fingerprint(text: bytes) -> int:
    """The fingerprint of a text of any length; words are read a segment at a time."""
    text, at = text.lower(), 0  # bytes.lower changes A-Z only
    bits, total = np.zeros(64, np.int64), 0
    held: list[bytes] = []
    while True:
        cut = blank.search(text, at + SEGMENT) if at + SEGMENT < len(text) else None
        end = cut.start() if cut else len(text)
        held += text[at:end].split()  # on the ASCII white space
        last = end == len(text)
        if len(held) >= WORDS or (last and held and not total):
            hashes = _hashes(held)
            total += len(hashes)
            for x in range(0, len(hashes), HASHES):
                rows = hashes[x : x + HASHES].astype("<u8").view(np.uint8).reshape(-1, 8)
                bits += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            held = held[1 - WORDS :] if len(held) >= WORDS else []
        if last:
            break
        at = end
    return sum(1 << i for i in np.flatnonzero(2 * bits > total).tolist())


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_signed(fingerprint(text.as_py())) for text in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], names=["dk", "doc_id", "fp"])


class BKTree:
    """Fingerprints; the children of a node are keyed by their Hamming distance from it."""

    def __init__(self, values: np.ndarray) -> None:
        """``values`` are different unsigned 64-bit numbers."""
        self.values = values
        self.children: list[dict[int, int]] = [{} for _ in range(len(values))]
        stack = [np.arange(len(values))] if len(values) else []
        while stack:  # the first of each part is its node, the others go below it by their distance
            part = stack.pop()
            node, below = int(part[0]), part[1:]
            if not len(below):
                continue
            distance = np.bitwise_count(values[below] ^ values[node])
            order = np.argsort(distance, kind="stable")
            below, distance = below[order], distance[order]
            cuts = np.flatnonzero(distance[1:] != distance[:-1]) + 1
            for members, key in zip(np.split(below, cuts), distance[np.concatenate([[0], cuts])].tolist()):
                self.children[node][key] = int(members[0])
                stack.append(members)

    def near(self, queries: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[int, np.ndarray]]:
        """(node, positions of the queries within the radius of it), node by node."""
        stack = [(0, np.arange(len(queries)))] if len(self.values) and len(queries) else []
        while stack:
            node, asked = stack.pop()
            distance = np.bitwise_count(queries[asked] ^ self.values[node]).astype(np.int64)
            found = asked[distance <= radius]
            if len(found):
                yield node, found
            for key, child in self.children[node].items():
                follow = asked[np.abs(distance - key) <= radius]
                if len(follow):
                    stack.append((child, follow))


def connecting(values: np.ndarray) -> list[tuple[int, int]]:
    """For each position that pairs within the radius connect to a lesser one: (the least of them, the position)."""
    if len(values) == 2:
        return [(0, 1)] if int(values[0] ^ values[1]).bit_count() <= RADIUS else []
    label = np.arange(len(values))
    for node, found in BKTree(values).near(values):
        labels = np.unique(label[found])  # the node is among them
        if len(labels) > 1:
            label[np.isin(label, labels)] = labels[0]
    moved = np.flatnonzero(label != np.arange(len(values)))
    return list(zip(label[moved].tolist(), moved.tolist()))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside shards, from rows (family, value, fp) sorted by shard.

    What the shards of a task connect is put together before it leaves the task, so that few rounds join the rest.
    """
    rest = tuple(np.zeros(0, np.int64) for _ in range(3))
    sets = Sets()

    def solved(family: np.ndarray, value: np.ndarray, fp: np.ndarray, final: bool) -> int:
        """Connect what whole shards connect; returns where the shard begins that may go on."""
        edges = np.flatnonzero((family[1:] != family[:-1]) | (value[1:] != value[:-1])) + 1
        starts = np.concatenate([[0], edges])
        ends = np.concatenate([edges, [len(fp)]])
        many = ends - starts > 1
        many[-1] &= final
        for x, y in zip(starts[many].tolist(), ends[many].tolist()):
            members = fp[x:y]
            for i, j in connecting(members.view(np.uint64)):
                sets.union(int(members[i]), int(members[j]))
        return int(starts[-1])

    for batch in batches:
        columns = tuple(np.concatenate([old, batch.column(i).to_numpy(zero_copy_only=False)]) for i, old in enumerate(rest))
        if len(columns[0]):
            low = solved(*columns, False)
            rest = tuple(c[low:] for c in columns)
        if len(sets.parent) > CONNECTED:
            yield stars(sets)
            sets.parent.clear()
    if len(rest[0]):
        solved(*rest, True)
    if sets.parent:
        yield stars(sets)


def _midpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(mid, fp): all that differ from fp in half the radius at most."""
    single = np.uint64(1) << np.arange(64, dtype=np.uint64)
    flips = [0, *single.tolist(), *(int(x | y) for x, y in combinations(single, RADIUS // 2))]
    masks = np.array(flips, np.uint64)
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for x in range(0, len(values), 64):
            own = values[x : x + 64]
            mids = (own.view(np.uint64)[:, None] ^ masks[None, :]).reshape(-1).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(mids), pa.array(np.repeat(own, len(masks)))], names=["mid", "fp"])


def links(fingerprints: DataFrame) -> DataFrame:
    """Links (a, b) between different fingerprints (fp) that connect all that links connect."""
    keys = [F.struct(F.lit(i).alias("family"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("value")) for i, mask in enumerate(MASKS)]
    rows = fingerprints.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.family", "k.value", "fp")
    sizes = rows.groupBy("family", "value").agg(F.count("*").alias("members"))
    large = materialise(sizes.where(F.col("members") > SHARD).select("family", "value"), "large")
    no_large = large.isEmpty()
    small = rows if no_large else rows.join(large, ["family", "value"], "left_anti")
    ordered = small.repartition("family", "value").sortWithinPartitions("family", "value", "fp")
    found = ordered.mapInArrow(_shards, "a long, b long")
    if no_large:
        return found
    members = rows.join(large, ["family", "value"], "left_semi").select("fp").distinct()
    around = members.mapInArrow(_midpoints, "mid long, fp long")
    least = around.groupBy("mid").agg(F.min("fp").alias("a"))
    stars = around.join(least, "mid").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()
    return found.unionByName(stars)


def simhash_duplicates(docs: DataFrame) -> DataFrame:
    """For each document: dk, doc_id, fingerprint (16 hex digits) and component_id (least doc_id that links lead to)."""
    rows = keyed(docs)
    texts = rows.select(KEY, F.col("row.doc_id").alias("doc_id"), whole_text().cast("binary").alias("text"))
    shape = f"dk long, doc_id {dict(docs.dtypes)['doc_id']}, fp long"
    prints = materialise(texts.mapInArrow(_fingerprints, shape), "fingerprints")
    classes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    labels = components(links(classes.select("fp"))).select(F.col("node").alias("fp"), "label")
    labelled = classes.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    of = materialise(labelled.select("fp", "label").join(least, "label").select("fp", "component_id"), "components")
    return prints.join(of, "fp").select(KEY, "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
