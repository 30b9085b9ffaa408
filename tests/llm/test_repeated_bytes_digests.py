"""Hot groups are compared by their bytes: digests of dealt digits may collide."""

import random
import types

import test_repeated_bytes as plain
import xxhash

from edupipe.llm import repeated_bytes as rb


def test_digits_that_collide(spark, table, monkeypatch):
    for name, value in {"DEPTH": 12, "GRAM": 4, "MEMBERS": 2, "RANGES": (4, 2, 1)}.items():
        monkeypatch.setattr(rb, name, value)
    real = xxhash.xxh3_128_intdigest
    digest = lambda data, seed=None: real(data) if seed is None else 5
    monkeypatch.setattr(rb, "xxhash", types.SimpleNamespace(xxh3_128_intdigest=digest))
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(4, 20)))
    rows = [(i, word() + "same" * 2 + word()) for i in range(60)]
    assert plain.found(table(rows)) == plain.brute(rows, 12)
