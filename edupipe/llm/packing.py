"""Best-fit packing of documents into sequences of fixed length, with conflicts.

A bin (one training sequence) holds ``CAPACITY`` units and never two documents of the same source or of the same
cluster of duplicates.  Documents longer than a bin are cut; whole pieces fill bins of their own
and the last piece is packed like a short document.

Pieces are taken by decreasing length.  Bins are ordered by residual; the search starts at
the least residual that a piece fits in and goes on to the next one until the bitmaps of the bin's
sources and clusters have neither of the piece's.  So the tightest compatible bin is found, of equal ones
the oldest, and a new bin is opened only when there is none.  For values that many
pieces have (``OFTEN``) there is a second order of the bins without them, so the search does not
walk past the bins that cannot take them.

Documents are dealt into shards of about ``SHARD`` by a hash; a shard is packed by one task, which holds a few
numbers for each document.  The shards depend on the number of documents only.  No text is shuffled.

Defined results.  Documents without units (null and empty texts) take no room: bin and start are null.  A null
source or cluster conflicts with nothing.  Every row is a document of its own (see ``common.keyed``).  An
empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edupipe.llm.common import KEY, keyed, whole_text
from edupipe.llm.linking import grouped

CAPACITY = 2048
SHARD = 20_000
OFTEN = 16      # a value of one piece in so many has an order of bins of its own

PACKED = "dk long, piece long, n_units long, shard long, bin long, start long"


class _Order:
    """Bins by residual, then age.  Entries are not taken out when bins change, but checked when met."""

    def __init__(self, capacity: int) -> None:
        self.heaps: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.filled = 0  # a bit for every residual with entries

    def add(self, residual: int, number: int) -> None:
        heappush(self.heaps[residual], number)
        self.filled |= 1 << residual

    def tightest(self, bins: list[list[int]], room: int, bits: int) -> int | None:
        """The oldest bin of the least residual from ``room`` on that shares no bit."""
        at = room
        while rest := self.filled >> at:
            at += (rest & -rest).bit_length() - 1
            heap, passed, found, before = self.heaps[at], [], None, -1
            while heap:
                number = heappop(heap)
                if bins[number][0] != at or number == before:  # changed since, or entered twice
                    continue
                before = number
                passed.append(number)
                if not bins[number][1] & bits:
                    found = number
                    break
            for number in passed:
                heappush(heap, number)
            if not heap:
                self.filled &= ~(1 << at)
            if found is not None:
                return found
            at += 1
        return None


def pack(pieces: list[tuple[int, list]], capacity: int) -> list[tuple[int, int]]:
    """The (bin, start) of each piece (units, values), which come by decreasing units.

    Pieces with a value in common (null left out) are never in one bin.
    """
    times = Counter(value for _, values in pieces for value in values)
    bit = {value: 1 << i for i, value in enumerate(v for v, n in times.items() if n > 1)}
    often = {value for value, n in times.items() if n > 1 and n * OFTEN >= len(pieces)}
    everywhere = _Order(capacity)
    without = {value: _Order(capacity) for value in often}
    bins: list[list[int]] = []  # residual, bitmap
    placed = []
    for units, values in pieces:
        bits = 0
        for value in values:
            bits |= bit.get(value, 0)
        own = max((v for v in values if v in often), key=lambda v: (times[v], repr(v)), default=None)
        number = (everywhere if own is None else without[own]).tightest(bins, units, bits)
        if number is None:
            number = len(bins)
            bins.append([capacity, 0])
        start = capacity - bins[number][0]
        bins[number][0] -= units
        bins[number][1] |= bits
        placed.append((number, start))
        residual, held = bins[number]
        if residual:
            everywhere.add(residual, number)
            for value, order in without.items():
                if not held & bit[value]:
                    order.add(residual, number)
    return placed


def _shards(capacity: int):
    """Pack the documents of each shard: rows (shard, dk, n, source, cluster), sorted by shard and decreasing n."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 6
        names = ["dk", "piece", "n_units", "shard", "bin", "start"]
        for (shard,), rows in grouped(batches, 1):
            last: list[tuple[int, list, int, int]] = []
            full = 0  # bins with whole pieces get the negative numbers
            done: list[tuple] = []
            for _, key, n, source, cluster in rows:
                whole, rest = divmod(n, capacity)
                for piece in range(whole):
                    full += 1
                    done.append((key, piece, capacity, shard, -full, 0))
                    if len(done) >= 8192:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
                        done = []
                if rest:
                    values = [("source", source)] * (source is not None) + [("cluster", cluster)] * (cluster is not None)
                    last.append((rest, values, key, whole))
                elif not whole:
                    done.append((key, 0, 0, shard, None, None))
            last.sort(key=lambda p: (-p[0], p[2]))
            for (units, _, key, piece), (number, start) in zip(last, pack([p[:2] for p in last], capacity)):
                done.append((key, piece, units, shard, number, start))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    return run


def n_words() -> Column:
    """Words between white space, the default unit."""
    return F.regexp_count(whole_text(), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def same_text() -> Column:
    """The default cluster: documents with the same text but for white space; none without text."""
    bare = F.translate(whole_text(), " \t\n\x0b\x0c\r", "")
    return F.when(bare != "", F.xxhash64(bare))


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, units: Column | None = None, source: Column | None = None, cluster: Column | None = None
) -> DataFrame:
    """Rows doc_id, piece, n_units, shard, bin and start: where each piece of each document lies.

    ``units`` (a whole number), ``source`` and ``cluster`` are columns over ``row``, a document; by default its
    words, its source and its text without white space.
    """
    rows = keyed(docs)
    shards = max(1, -(-docs.count() // SHARD))
    known = rows.select(
        F.pmod(F.xxhash64(KEY), F.lit(shards)).cast("long").alias("shard"), KEY,
        (n_words() if units is None else units).cast("long").alias("n"),
        (F.col("row.source") if source is None else source).cast("string").alias("source"),
        (same_text() if cluster is None else cluster).alias("cluster"),
    )
    ordered = known.repartition(shards, "shard").sortWithinPartitions("shard", F.desc("n"), KEY)
    packed = ordered.mapInArrow(_shards(capacity), PACKED)
    ids = rows.select(KEY, F.col("row.doc_id").alias("doc_id"))
    return packed.join(ids, KEY).select("doc_id", "piece", "n_units", "shard", "bin", "start")
