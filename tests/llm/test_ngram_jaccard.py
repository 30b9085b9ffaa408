"""Near-duplicate components against comparing all pairs."""

import random
import re

import numpy as np
import pytest

from edupipe.llm import ngram_jaccard as nj
from edupipe.llm.linking import Sets, components
from edupipe.llm.queries import op1
from edupipe.llm.queries import table as read_table

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    span = min(5, len(words))
    return frozenset(tuple(words[i : i + span]) for i in range(len(words) - span + 1))


def brute(rows):
    """(doc_id, n_shingles, component_id) for rows with unique ids."""
    sets = {i: shingles(t) for i, t in rows}
    holders, parts = {}, Sets()
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    overlap = {}
    for ids in holders.values():
        for at, a in enumerate(ids):
            for b in ids[at + 1 :]:
                overlap[a, b] = overlap.get((a, b), 0) + 1
    for (a, b), n in overlap.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            parts.union(a, b)
    return sorted((i, len(s), parts.find(i)) for i, s in sets.items())


def variants(rng, count, low, high, vocabulary):
    rows = []
    while len(rows) < count:
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(low, high))]
        for _ in range(rng.choice([1, 1, 2, 5, 9])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                if copy:
                    copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                copy = copy[: rng.randrange(len(copy) // 2, len(copy) + 1)]
            rows.append(rng.choice([" ", "\n", "\t ", "  "]).join(w.upper() if rng.random() < 0.1 else w for w in copy))
    return rows


def check(spark, table, texts):
    ids = list(range(100, 100 + len(texts)))
    random.Random(5).shuffle(ids)
    rows = list(zip(ids, texts))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in nj.near_duplicates(table(rows)).collect())
    assert got == brute(rows)
    return got


LIMITS = {"plain": {}, "chained": {"LIST_MEMBERS": 3, "COMMON_FROM": 4, "PROPOSE_FROM": 2, "SALTS": 3}, "blocks": {"BUCKET_SHINGLES": 400, "LIST_MEMBERS": 4}}


@pytest.mark.parametrize("limits", LIMITS)
def test_random_texts(spark, table, monkeypatch, limits):
    for name, value in LIMITS[limits].items():
        monkeypatch.setattr(nj, name, value)
    rng = random.Random(len(limits))
    vocabulary = [f"w{i}" for i in range(60)]
    texts = variants(rng, 150, 0, 80, vocabulary) + variants(rng, 40, 3, 9, ["a", "b"])
    texts += [None, "", " \n", "one two", "One  two", "one two three", "é É"]
    got = check(spark, table, texts)
    assert len({c for _, _, c in got}) < len(got)


def test_thousands_of_copies_and_a_common_passage(spark, table):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = [rng.choice(vocabulary) for _ in range(60)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    texts = [" ".join(base)] * 700
    for _ in range(700):
        copy = list(base)
        copy[rng.randrange(60)] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    texts += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))) for _ in range(300)]
    check(spark, table, texts)


def test_bounds_never_exclude_a_link():
    rng = np.random.default_rng(2)
    for _ in range(400):
        a = rng.integers(0, 1 << 63, int(rng.integers(1, 300))).astype(np.uint64)
        b = np.concatenate([a[: int(len(a) * rng.uniform(0.7, 1))], rng.integers(0, 1 << 63, int(rng.integers(0, 60))).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        if not len(b):
            continue
        n = len(np.intersect1d(a, b))
        tree = nj.SignatureTree([len(a), len(b)], [nj.bitmap(a), nj.bitmap(b)], Sets(), [1, 2], lambda i, j: True)
        if 100 * n >= 80 * (len(a) + len(b) - n):
            assert n >= nj.least_overlap(len(a), len(b))
            assert sorted(tree.connect()[0]) == [1, 2]


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(70)] + [(2000, 2000 + i) for i in range(90)]
    sets = Sets()
    for a, b in pairs:
        sets.union(a, b)
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    got = {(r.node, r.label) for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {(x, sets.find(x)) for x in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_rows_that_stay(spark, table):
    text = "one two three four five six seven"
    docs = table([(4, text), (2, text.upper()), (2, "other words here now again"), (None, text), (9, None), (9, "")])
    kept = nj.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.text or "")[:3].lower() for r in kept.collect()) == ["", "", "one", "oth"]
    found = nj.near_duplicates(docs).collect()
    assert len(found) == 6 and {r.component_id for r in found if r.n_shingles == 3} == {2}
    assert nj.near_duplicates(table([])).collect() == []
    assert nj.without_near_duplicates(table([])).collect() == []


def test_op1_whole_table(spark, small):
    rows = [(r.doc_id, r.text) for r in read_table(spark, small, "documents").collect()]
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in op1(spark, small).collect()) == brute(rows)


def test_copies_are_listed_once(spark, table, monkeypatch):
    """Documents with equal sets are one in the lists, so copies do not make them longer or more."""
    listed = []
    write = nj.materialise

    def materialise(df, label):
        written = write(df, label)
        if label == "lists":
            listed.append(written.count())
        return written

    monkeypatch.setattr(nj, "materialise", materialise)
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(10_000)}" for _ in range(60)) for _ in range(20)]
    check(spark, table, texts * 9)
    assert listed == [0]


def test_sizes_that_cannot_link_share_no_list():
    """Sizes 10, 12, 13 and 60, 70 have two lists; with a salt all are one chain."""
    names, sizes = ["h", "salt", "n", "dk"], [10, 12, 13, 60, 70, 100]
    rows = [(5, 0, n, k) for k, n in enumerate(sizes)] + [(6, 3, n, k) for k, n in enumerate(sizes)]

    def found(cut):
        parts = [rows[at : at + cut] for at in range(0, len(rows), cut)]
        batches = [nj.pa.RecordBatch.from_arrays([nj.pa.array(c) for c in zip(*part)], names=names) for part in parts]
        return [r for b in nj._lists(iter(batches)) for r in b.to_pylist()]

    for cut in (1, 4, 12):
        rows_out = found(cut)
        assert [r["members"] for r in rows_out if r["members"]] == [[0, 1, 2], [3, 4]]
        assert [(r["a"], r["b"]) for r in rows_out if r["b"] is not None] == [(k, k + 1) for k in range(5)]
        assert [(r["a"], r["h"]) for r in rows_out if r["h"] is not None] == [(0, 6)]
