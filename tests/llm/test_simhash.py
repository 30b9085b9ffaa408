"""SimHash against fingerprints taken word by word and all pairs."""

import random

import numpy as np
import xxhash

from edupipe.llm import simhash
from edupipe.llm.simhash import BKTree, connecting, fingerprint, simhash_duplicates


def plain_print(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Least position that links lead to."""
    label = list(range(len(prints)))
    changed = True
    near = [[j for j in range(len(prints)) if (prints[i] ^ prints[j]).bit_count() <= 4] for i in range(len(prints))]
    while changed:
        changed = False
        for i, others in enumerate(near):
            least = min(label[j] for j in others)
            if least < label[i]:
                label[i], changed = least, True
    return label


def brute(rows):
    prints = [plain_print(t) for _, t in rows]
    label = plain_components(prints)
    groups = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(label[k], []).append(i)
    least = {k: min((i for i in ids if i is not None), default=None) for k, ids in groups.items()}
    return sorted(((i, f"{p:016x}", least[label[k]]) for k, ((i, _), p) in enumerate(zip(rows, prints))), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def test_fingerprints(monkeypatch):
    monkeypatch.setattr(simhash, "SEGMENT", 16)
    rng = random.Random(1)
    texts = ["", " \n\t", "a", "A b", "one two three", "One two three four", "é É ñ Ñ x", "  a　b c d e"]
    texts += [" ".join(rng.choice(["alpha", "Beta", "x" * 40, "é"]) for _ in range(rng.randrange(1, 60))) for _ in range(50)]
    for text in texts:
        assert fingerprint(text.encode()) == plain_print(text)


def test_tree_finds_all_neighbours():
    rng = random.Random(2)
    centres = [rng.getrandbits(64) for _ in range(20)]
    values = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for c in centres for _ in range(15)}
    array = np.array(sorted(values, key=lambda x: x * 7919 % 10007), np.uint64)
    found = {(node, int(q)) for node, asked in BKTree(array).near(array) for q in asked}
    expected = {(i, j) for i, x in enumerate(array.tolist()) for j, y in enumerate(array.tolist()) if (x ^ y).bit_count() <= 4}
    assert found == expected
    label = plain_components(array.tolist())
    assert sorted(connecting(array)) == sorted((low, i) for i, low in enumerate(label) if low != i)


def test_any_four_bits_share_a_shard():
    rng = random.Random(3)
    assert len(simhash.MASKS) == 15 and simhash.BLOCKS[-1] == 64
    for _ in range(2000):
        x = rng.getrandbits(64)
        y = x ^ sum(1 << b for b in rng.sample(range(64), 4))
        assert any(x & m == y & m for m in simhash.MASKS)


def near_texts(n, seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(n // 6):
        base = [rng.choice(words) for _ in range(rng.choice([30, 120, 400]))]
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((rng.randrange(10**6), " ".join(copy)))
    return rows


def test_documents(spark, table):
    rows = near_texts(180) + [(7, None), (8, ""), (9, " \n"), (10, "a"), (11, "A"), (5, "same text here now ok"), (6, "SAME text here now ok")]
    assert got(simhash_duplicates(table(rows))) == brute(rows)


def test_large_shards_by_midpoints(spark, table, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 2)
    rows = near_texts(60, 6) + [(1, None), (2, "b b b b b")]
    assert got(simhash_duplicates(table(rows))) == brute(rows)


def test_rows_that_share_an_id(spark, table):
    rows = [(1, "x y z"), (1, "x y z"), (None, "x y z"), (2, "other words in here"), (2, "x y z")]
    assert got(simhash_duplicates(table(rows))) == brute(rows)


def test_no_documents(spark, table):
    assert simhash_duplicates(table([])).collect() == []


def test_whole_table(spark, small):
    from edupipe.llm.queries import QUERIES

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op12_simhash"](spark, small)) == brute(docs)
