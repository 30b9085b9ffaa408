"""Packing against a search through all bins."""

import random
from collections import defaultdict

import pytest

from edupipe.llm import packing
from edupipe.llm.queries import op2
from edupipe.llm.queries import table as read_table


def brute(pieces, capacity):
    """The same order of pieces; each goes to the tightest bin that takes it, the oldest of equal ones."""
    bins, placed = [], []
    for units, values in pieces:
        fits = [(b[0], i) for i, b in enumerate(bins) if b[0] >= units and not b[1] & set(values)]
        if fits:
            at = min(fits)[1]
        else:
            at = len(bins)
            bins.append([capacity, set()])
        placed.append((at, capacity - bins[at][0]))
        bins[at][0] -= units
        bins[at][1] |= set(values)
    return placed


@pytest.mark.parametrize("seed", range(8))
def test_tightest_compatible_bin(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 50, 300])
    pieces = []
    for _ in range(400):
        values = [("source", rng.choice("aaaabcdefghij"))] * (rng.random() < 0.9)
        values += [("cluster", rng.choice([1, 1, *range(200)]))] * (rng.random() < 0.7)
        pieces.append((rng.randrange(1, capacity + 1), values))
    pieces.sort(key=lambda p: -p[0])
    assert packing.pack(pieces, capacity) == brute(pieces, capacity)


def verify(rows, docs, capacity):
    """Every unit of every document lies in one place, and no bin has a conflict."""
    bins, cover = defaultdict(list), defaultdict(list)
    for r in rows:
        cover[r.doc_id].append(r)
        if r.bin is not None:
            bins[r.shard, r.bin].append(r)
    for i, text, source in docs:
        pieces = sorted(cover.pop(i), key=lambda r: r.piece)
        words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert sum(r.n_units for r in pieces) == len(words)
        assert (pieces[0].bin is None) == (not words)
    assert not cover
    source_of = {i: s for i, _, s in docs}
    for held in bins.values():
        held.sort(key=lambda r: r.start)
        assert all(a.start + a.n_units == b.start for a, b in zip(held, held[1:]))
        assert held[0].start == 0 and held[-1].start + held[-1].n_units <= capacity
        sources = [source_of[r.doc_id] for r in held]
        assert len(set(sources)) == len(sources)
    return bins


def test_documents(spark, table, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 40)
    rng = random.Random(3)
    rows = [(i, "word " * rng.choice([0, 1, 3, 9, 10, 25, 47])) for i in range(150)] + [(500, None), (501, "  ")]
    docs = table(rows)
    packed = packing.pack_documents(docs, 10).collect()
    verify(packed, [(r.doc_id, r.text, r.source) for r in docs.collect()], 10)
    again = packing.pack_documents(docs.repartition(3), 10).collect()
    assert sorted(map(tuple, packed), key=repr) == sorted(map(tuple, again), key=repr)


def test_clusters_sources_and_shared_ids(spark):
    rows = [(1, "a b", None), (2, "a  b", None), (3, "c", "s"), (4, "d", "s"), (4, "e", None), (None, "f", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    packed = packing.pack_documents(docs, 100).collect()
    assert len(packed) == 6
    bins = defaultdict(list)
    for r in packed:
        bins[r.bin].append(r.doc_id)
    assert all(not {1, 2} <= set(ids) and not (3 in ids and ids.count(4) == 2) for ids in bins.values())
    assert packing.pack_documents(docs.limit(0)).collect() == []


def test_op2_whole_table(spark, small):
    docs = [(r.doc_id, r.text, r.source) for r in read_table(spark, small, "documents").collect()]
    bins = verify(op2(spark, small).collect(), docs, packing.CAPACITY)
    # the whole table is one shard: the same bins as the search through all of them
    last = []
    for i, text, source in docs:
        n = len((text or "").split())
        bare = "".join((text or "").split())
        if n % packing.CAPACITY:
            last.append((-(n % packing.CAPACITY), i, [("source", source), ("cluster", bare)]))
    placed = brute([(-n, values) for n, _, values in sorted(last, key=lambda p: p[:2])], packing.CAPACITY)
    assert max(b for _, b in bins) == max(at for at, _ in placed)
    found = {r.doc_id: (b, r.start) for (_, b), held in bins.items() for r in held if b >= 0}
    assert found == {i: place for (_, i, _), place in zip(sorted(last, key=lambda p: p[:2]), placed)}
