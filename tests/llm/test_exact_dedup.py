"""Exact duplicates against a plain grouping in memory."""

import hashlib
import random
import re
from collections import defaultdict

from edupipe.llm import exact_dedup
from edupipe.llm.exact_dedup import exact_copies, without_copies


def brute(rows):
    """Expected decisions of (doc_id, text) rows with unique ids."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((-len(text or ""), i))
    out = []
    for body, members in groups.items():
        keep = min(members)[1]
        digest = hashlib.sha256(body.encode()).hexdigest()
        out += [(i, keep, len(members), i == keep, digest) for _, i in members]
    return sorted(out)


def test_copies_of_all_lengths(spark, table, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BLOCK_BYTES", 8)
    rng = random.Random(3)
    texts = [None, "", " \n", "a b", "ab", "a  b\t", "abcdefgh", "abcdefgh" * 2, "abcdefgh" * 3, "é" * 9, "日本" * 30]
    texts += ["".join(rng.choice("ab") for _ in range(rng.randrange(0, 70))) for _ in range(60)]
    texts += [t[:20] + " " + t[20:] for t in texts if t][:40] + ["abcdefgh" * 2] * 200
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = sorted(tuple(r) for r in exact_copies(table(rows)).collect())
    assert got == brute(rows)


def test_rows_that_share_an_id(spark, table):
    docs = table([(1, "x y"), (1, "xy"), (None, "xy"), (2, "z"), (2, "z")])
    got = exact_copies(docs).collect()
    assert sorted(r.group_size for r in got) == [2, 2, 3, 3, 3]
    assert {r.keep_id for r in got} == {1, 2}
    assert sum(r.kept for r in got) == 2
    assert sorted(r.text for r in without_copies(docs).collect()) == ["x y", "z"]


def test_no_documents(spark, table):
    assert exact_copies(table([])).collect() == []
    assert without_copies(table([])).columns == table([]).columns
