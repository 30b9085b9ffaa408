"""The alignment against both libraries on whole texts and a plain walk over byte offsets."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from edupipe.llm import cross_tokenizer
from edupipe.llm.cross_tokenizer import aligned_groups, alignment, id_pairs, packed, unpacked

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def letters():
    """The byte that each letter of the byte-level vocabulary stands for."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table, extra = {}, 256
    for b in range(256):
        if b in plain:
            table[chr(b)] = b
        else:
            table[chr(extra)] = b
            extra += 1
    return table


class Brute:
    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.letters = letters()

    def tokens(self, text):
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        a_bytes = [bytes(self.letters[c] for c in self.a.id_to_token(i)) for i in a]
        b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        whole = (" " + text).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            return [], []
        return list(zip(a, map(len, a_bytes))), list(zip(b, map(len, b_bytes)))

    def groups(self, text):
        a, b = self.tokens(text)
        i = j = x = y = 0
        out, mine, other = [], [], []
        while i < len(a) or j < len(b):
            if x <= y:
                mine.append(a[i][0])
                x += a[i][1]
                i += 1
            else:
                other.append(b[j][0])
                y += b[j][1]
                j += 1
            if x == y:
                out.append((mine, other))
                mine, other = [], []
        return out

    def links(self, text):
        a, b = self.tokens(text)
        ends_a, ends_b = np.cumsum([n for _, n in a]).tolist(), np.cumsum([n for _, n in b]).tolist()
        at = {e: i for (i, _), e in zip(b, ends_b)}
        return [(i, at[e]) for (i, _), e in zip(a, ends_a) if e in at]

    def rows(self, docs):
        links = {k: self.links(t or "") for k, (_, t) in enumerate(docs)}
        counts = Counter(p for found in links.values() for p in found)
        most = {}
        for (_, b), n in counts.items():
            most[b] = max(most.get(b, 0), n)
        out = []
        for k, (i, text) in enumerate(docs):
            groups = self.groups(text or "")
            digest = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
            out.append((
                i, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links[k]),
                sum(counts[p] == most[p[1]] for p in links[k]), sum(counts[p] for p in links[k]),
                hashlib.sha256(digest.encode()).hexdigest() if digest else "",
            ))
        return sorted(out, key=repr)


@pytest.fixture(scope="module")
def brute():
    return Brute()


ODD = [
    None, "", " ", "   ", "a", " a", "a ", "a  ", "  a  b", "a\n b\n\n  c", "\t\tx", "<s>x</s><|endoftext|>", "x ▁ y", "a\x00b",
    "<0x41>", "ﬁ é é", " x　y", "日本語 text", "don't we'll 1234567 $%&", "😀 a 😀😀", "word" * 400, "x" * 3000, "\r\n" * 20,
]


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_odd_texts(spark, table, brute):
    rows = list(enumerate(ODD)) + [(3, "a"), (None, "a b"), (None, None)]
    assert got(alignment(table(rows), A, B)) == brute.rows(rows)


def test_random_texts(spark, table, brute, monkeypatch):
    monkeypatch.setattr(cross_tokenizer, "CHUNK_TOKENS", 500)
    rng = random.Random(5)
    parts = ["the", "Hello", " ", "  ", "\n", "é", "日", "'s", "123", "zqx", "-", "😀", "\t", "ing", ".", " "]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 60)))) for i in range(300)]
    assert got(alignment(table(rows), A, B)) == brute.rows(rows)


def test_pairs_beyond_the_table(spark, table, brute, monkeypatch):
    monkeypatch.setattr(cross_tokenizer, "FREQUENT", 3)
    rows = [(i, "the cat sat on the mat " * (i % 4) + f"word{i} other{i % 3}") for i in range(60)]
    assert got(alignment(table(rows), A, B)) == brute.rows(rows)
    monkeypatch.setattr(cross_tokenizer, "HELD_PAIRS", 2)
    assert got(alignment(table(rows), A, B)) == brute.rows(rows)


def test_groups(spark, table, brute):
    rows = [(i, t) for i, t in enumerate(ODD) if t != "x" * 3000]
    for r in aligned_groups(table(rows), A, B).collect():
        expected = brute.groups(ODD[r.doc_id] or "")
        cuts = list(zip([0, *r.a_cuts], r.a_cuts, [0, *r.b_cuts], r.b_cuts))
        assert [(r.a_ids[w:x], r.b_ids[y:z]) for w, x, y, z in cuts] == expected
        assert not expected or r.byte_cuts[-1] == len((" " + ODD[r.doc_id]).encode())


def test_id_pairs(spark, table, brute):
    rows = [(i, t) for i, t in enumerate(["a cat", "a dog", "a cat sat", None])]
    counts = Counter(p for _, t in rows for p in brute.links(t or ""))
    found = id_pairs(table(rows), A, B).collect()
    assert {(r.a_id, r.b_id): r.n for r in found} == counts
    assert all(r.best == (r.n == max(n for (_, b), n in counts.items() if b == r.b_id)) for r in found)


def test_no_documents(spark, table):
    assert alignment(table([]), A, B).collect() == []
    assert id_pairs(table([]), A, B).collect() == []


def test_planes():
    for values in ([], [0], [5, 300, 1 << 40, (1 << 64) - 1]):
        array = np.array(values, np.uint64)
        assert unpacked(packed(array)).tolist() == values


def test_whole_table(spark, small, brute):
    from edupipe.llm.queries import QUERIES

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op11_cross_tokenizer"](spark, small)) == brute.rows(docs)
