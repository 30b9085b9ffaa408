"""Contamination against a search for every window in every document."""

import hashlib
import random
import re

import pytest

from edupipe.llm import decontaminate as dc
from edupipe.llm.queries import op5
from edupipe.llm.queries import table as read_table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window):
    """(doc_id, n_words, n_hit, items) by looking every window up in every document."""
    windows = {}
    for name, text in items:
        ws = words(text)
        size = min(window, len(ws))
        for at in range(len(ws) - size + 1 if ws else 0):
            windows.setdefault(tuple(ws[at : at + size]), set()).add("" if name is None else str(name))
    sizes = {len(w) for w in windows}
    out = []
    for i, text in docs:
        ws, hit, found = words(text), set(), set()
        for size in sizes:
            for at in range(len(ws) - size + 1):
                names = windows.get(tuple(ws[at : at + size]))
                if names:
                    hit.update(range(at, at + size))
                    found |= names
        out.append((i, len(ws), len(hit), sorted(found)))
    return sorted(out, key=repr)


def found(spark, docs, items, window):
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = dc.contamination(docs, bench, window).select("row.doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    assert all(r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words) for r in rows)
    return sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in rows], key=repr)


@pytest.mark.parametrize("at_once", [dc.WORDS_AT_ONCE, 40])
@pytest.mark.parametrize("seed", range(4))
def test_random_words(spark, table, monkeypatch, seed, at_once):
    monkeypatch.setattr(dc, "WORDS_AT_ONCE", at_once)
    monkeypatch.setattr(dc, "PIECE_WORDS", 12 if seed % 2 else dc.PIECE_WORDS)
    rng = random.Random(seed)
    vocabulary = ["a", "B", "c1", "Éa", "d"][: 2 + seed]

    def text(low, high):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", "-", ", "]) for _ in range(rng.randrange(low, high)))

    items = [(i // 2, text(0, 12)) for i in range(10)] + [(None, text(2, 6)), (7, None), (8, ""), (50, text(30, 60))]
    docs = [(i, text(0, 40)) for i in range(30)] + [(90, None), (91, ""), (92, " .,"), (93, text(300, 400))]
    assert found(spark, table(docs), items, 5) == brute(docs, items, 5)


def test_long_text_in_segments(spark, table, monkeypatch):
    monkeypatch.setattr(dc, "SEGMENT", 7)
    docs = [(1, "one two three four five six seven eight nine ten")]
    items = [(3, "four five six seven")]
    assert found(spark, table(docs), items, 4) == [(1, 10, 4, ["3"])]


def test_op5_whole_table(spark, small):
    docs = [(r.doc_id, r.text) for r in read_table(spark, small, "documents").collect()]
    items = [(r.item_id, r.text) for r in read_table(spark, small, "benchmark").collect()]
    expected = [
        (i, n, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hit > 0 and 20 * hit >= n)
        for i, n, hit, names in brute(docs, items, 13)
    ]
    got = sorted((tuple(r) for r in op5(spark, small).collect()), key=repr)
    assert got == sorted(expected, key=repr)
    assert any(r[5] for r in got)


def test_rows_kept_and_cut(spark, table):
    docs = table([(1, "x y z"), (2, " ".join(f"w{i}" for i in range(200)) + ", x y, z!"), (3, None), (3, "x"), (None, "q")])
    bench = spark.createDataFrame([(1, "X Y Z")], "item_id long, text string")
    kept = dc.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted([docs.collect()[1].text, "", "x", "q"])
    cut = dc.decontaminate(docs, bench, longest=2)
    assert cut.schema == docs.schema
    assert {r.text for r in cut.where("doc_id = 2").collect()} == {docs.collect()[1].text.replace("x y, z", "")}
    assert dc.decontaminate(docs.limit(0), bench).collect() == []
    assert dc.decontaminate(docs, bench.limit(0)).count() == 5
