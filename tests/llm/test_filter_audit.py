"""The audit against running every order of the filters over the rows."""

import random
import re
from collections import defaultdict
from itertools import permutations

from edupipe.llm.filter_audit import COLUMNS, filter_audit, packed_mask, unpack

NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


def failing(rows):
    """The filters that each row (doc_id, text, source) fails."""
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        same = [i for i, t, _ in rows if (t or "") == text and i is not None and doc_id is not None and i < doc_id]
        out.append({
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": bool(same),
        })
    return out


def brute(rows, labels):
    fails = failing(rows)
    good = {i for i, quality, _ in labels if quality == 1}
    toxic = {i for i, _, t in labels if t == 1}
    parts = defaultdict(list)
    for row, f in zip(rows, fails):
        parts[row[2] or ""].append((row[0], f))
    out = []
    for part, members in parts.items():
        of_filter, mine = defaultdict(int), []
        for order in permutations("ABCDE"):
            left = members
            for step, name in enumerate(order, 1):
                lost = [m for m in left if m[1][name]]
                gone = len(members) - len(left)
                kept = [m for m in left if not m[1][name]]
                redundant = sum(m[1][name] for m in members) - len(lost)
                assert redundant <= gone
                alone = sum(m[1][name] and sum(m[1].values()) == 1 for m in members)
                of_filter[name] += len(lost)
                mine.append((
                    part, "".join(order), step, len(kept), len(lost), redundant, alone,
                    sum(m[0] in good for m in lost), sum(m[0] in toxic for m in lost), name,
                ))
                left = kept
        out += [(*row[:-1], of_filter[row[-1]]) for row in mine]
    return sorted(out)


def run(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, s, 1, 2, "x") for i, t, s in rows], "doc_id long, text string, source string, mask int, dk long, part string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return sorted(tuple(r) for r in filter_audit(docs, marks).select(*NAMES).collect())


def test_random_rows(spark):
    rng = random.Random(8)
    pool = [None, "", " ", "A B", "a # b", "é" * 10 + "ABC", " ".join("ab"), "the cat"]
    pool += [" ".join(f"{rng.choice(['w', 'W', 'W|', 'é'])}{rng.randrange(90)}" for _ in range(rng.randrange(40, 70))) for _ in range(30)]
    rows = [(i, rng.choice(pool), rng.choice([None, "", "s1", "s2", "s2"])) for i in range(150)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (999, 1, 1)]
    assert run(spark, rows, labels) == brute(rows, labels)


def test_ids_that_are_null_or_repeat(spark):
    rows = [(1, "x", "s"), (1, "x", "s"), (None, "x", "s"), (2, "x", "t"), (0, "y", "t"), (3, None, None), (4, "", None)]
    assert run(spark, rows, []) == brute(rows, [])


def test_no_rows(spark):
    assert run(spark, [], []) == []


def test_fields_do_not_run_over():
    total = ((1 << 62) - 1) * packed_mask(0b10101, True, False) + (1 << 61) * packed_mask(0, False, True)
    fields, alone = unpack(total)
    assert fields[0, 0].tolist() == [1 << 61, (1 << 62) - 1, 0, (1 << 62) - 1, 0]
    assert alone.tolist() == [0] * 5


def test_whole_table(spark, duck, small):
    from oracle import compare

    from edupipe.llm.queries import ORACLES, QUERIES

    assert compare(QUERIES["op13_filter_audit"](spark, small), duck, ORACLES["op13_filter_audit"]) is None
