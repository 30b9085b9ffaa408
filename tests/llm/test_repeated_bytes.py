"""Repeated byte strings against a table of all strings."""

import hashlib
import random
from collections import Counter

import pytest

from edupipe.llm import repeated_bytes as rb
from edupipe.llm.queries import op9
from edupipe.llm.queries import table as read_table


def brute(rows, depth):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text)."""
    data = [(i, (t or "").encode()) for i, t in rows]
    times = Counter(hash(b[at : at + depth]) for _, b in data for at in range(len(b) - depth + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for at in range(len(b) - depth + 1):
            if times[hash(b[at : at + depth])] > 1:
                gone[at : at + depth] = b"\x01" * depth
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for at, g in enumerate(gone) if g and (not at or not gone[at - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(docs):
    rows = rb.removals(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def texts(rng, count, alphabet, high):
    """Texts put together from shared pieces, with changes."""
    pieces = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(3, high))) for _ in range(25)]
    out = []
    for _ in range(count):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 5)))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(alphabet) + text[at + rng.randrange(2) :]
        out.append(text)
    return out


@pytest.mark.parametrize("seed,members,segment", [(0, 2048, 1 << 20), (1, 3, 1 << 20), (2, 2, 10), (3, 2048, 7)])
def test_small_depth(spark, table, monkeypatch, seed, members, segment):
    for name, value in {"DEPTH": 12, "GRAM": 4, "MEMBERS": members, "RANGES": (4, 2, 1), "SEGMENT": segment}.items():
        monkeypatch.setattr(rb, name, value)
    rng = random.Random(seed)
    rows = texts(rng, 60, "ab", 30) + texts(rng, 60, "abcdefgh é", 40) + ["a" * 50, "ab" * 30, "ab" * 6, "ab" * 6, None, "", "x" * 11]
    rows = list(enumerate(rows))
    assert found(table(rows)) == brute(rows, 12)


def test_hot_passage_with_other_surroundings(spark, table, monkeypatch):
    for name, value in {"DEPTH": 24, "GRAM": 8, "MEMBERS": 5, "RANGES": (8, 4, 1)}.items():
        monkeypatch.setattr(rb, name, value)
    rng = random.Random(9)
    passages = ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (16, 23, 24, 25, 40)]
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 30)))
    rows = [(i, word() + passages[i % 5] + word()) for i in range(200)] + [(i, passages[4] + "copy of all") for i in range(200, 260)]
    assert found(table(rows)) == brute(rows, 24)


def test_rows_that_share_an_id(spark, table):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh ") for _ in range(900))
    rows = [(1, text), (1, text), (None, "q" + text[:450]), (2, text[:399]), (3, None)]
    assert found(table(rows)) == brute(rows, 400)
    assert found(table([])) == []
    removed = {r.doc_id: r for r in rb.removals(table(rows)).collect()}
    assert rb.without_repeats(b"q" + text[:450].encode(), removed[None].starts, removed[None].stops) == b"q"


def test_op9_whole_table(spark, small):
    rows = [(r.doc_id, r.text) for r in read_table(spark, small, "documents").collect()]
    got = sorted((tuple(r)[:5] for r in op9(spark, small).collect()), key=repr)
    assert got == brute(rows, 400)
    assert any(r[2] for r in got)
