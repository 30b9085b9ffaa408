"""Repeated runs of lines against a search for equal runs in memory."""

import random

import pytest

from edupipe.llm import line_dedup as ld
from edupipe.llm.queries import QUERIES
from edupipe.llm.queries import table as read_table


def brute(rows):
    """doc_id -> (what is left of the text, lines, lines removed, runs removed): equal runs are grown line by line, rows with unique ids."""
    texts = [(i, t, [] if t is None else t.split("\n")) for i, t in sorted(rows)]
    blank = lambda line: not line.strip(" \t\n\r\x0b\x0c")
    places, out = {}, {}
    for d, (i, text, lines) in enumerate(texts):
        gone = set()
        for at, line in enumerate(lines):
            for e, b in places.get(line, []):
                other, n = texts[e][2], 1
                while at + n < len(lines) and b + n < len(other) and lines[at + n] == other[b + n] and not (blank(lines[at + n]) and blank(lines[at + n - 1])):
                    n += 1
                if n > 1 or len(line.encode().split()) > 50:
                    gone.update(range(at, at + n))
            places.setdefault(line, []).append((d, at))
        left = "\n".join(x for at, x in enumerate(lines) if at not in gone) if gone else text
        out[i] = (left, len(lines), len(gone), sum(at - 1 not in gone for at in gone))
    return out


def found(docs):
    rows = ld.line_dedup(docs).select("row.doc_id", "row.text", "n_lines", "n_removed", "n_runs").collect()
    return {r.doc_id: (r.text, r.n_lines, r.n_removed, r.n_runs) for r in rows}


def some_rows(seed):
    rng = random.Random(seed)
    fresh = iter(range(10**6))
    long = [" ".join(f"w{rng.random()}" for _ in range(n)) for n in (50, 51, 80)]
    passages = [[f"p{k} é{i}" for i in range(rng.randrange(1, 8))] + ["", "  ", ""][: rng.randrange(4)] for k in range(8)]
    texts = []
    for _ in range(80):
        parts = [rng.choice([*passages, [rng.choice(long)], [f"own {next(fresh)}"], [""]]) for _ in range(rng.randrange(1, 7))]
        texts.append("\n".join(line for part in parts for line in part))
    rows = list(enumerate([*texts, None, "", "\n\n\n", "only one line", "only one line"], 7))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_random_runs(spark, table, seed):
    rows = some_rows(seed)
    assert found(table(rows)) == brute(rows)


def test_every_shared_passage_goes(spark, table):
    """Between lines of their own, as short as two lines or one long line: chunks leave most of these."""
    rows, n = [], 0
    for size in (2, 3, 5, 12):
        for k in range(10):
            passage = [f"s {size} {k} {i}" for i in range(size)]
            for _ in range(2):
                rows.append((n, "\n".join([f"a{n}", *passage, f"b{n}"])))
                n += 1
    line = " ".join(f"w{i}" for i in range(51))
    rows += [(n, f"x\n{line}\ny"), (n + 1, f"z\n{line}\nu")]
    got = found(table(rows))
    for i, text in rows:
        lines = text.split("\n")
        assert got[i][0] == (f"{lines[0]}\n{lines[-1]}" if i % 2 else text)


def test_hashes_that_collide(spark, table, monkeypatch):
    monkeypatch.setattr(ld, "_hash", lambda line: len(line) % 2)
    rows = some_rows(5)
    assert found(table(rows)) == brute(rows)


def test_digests_of_chunks_that_collide(spark, table, monkeypatch):
    monkeypatch.setattr(ld.xxhash, "xxh3_128_intdigest", lambda body: 5)
    rows = some_rows(6)
    assert found(table(rows)) == brute(rows)


def test_copies_send_chunks_and_not_lines(spark, table):
    """Of a text that many have, only the first document's lines are looked up."""
    lines = [f"line {i}" for i in range(40)]
    texts = table([(i, "\n".join(lines)) for i in range(30)]).selectExpr("doc_id as dk", "cast(text as binary) as text")
    cut = ld.materialise(texts.mapInArrow(ld._cut, ld.CUT), "cut")
    gone = ld.repeated_chunks(texts, cut.where("d1 is not null"))
    units = cut.where("l1 is not null").join(gone.selectExpr("dk", "at as chunk"), ["dk", "chunk"], "left_anti")
    inside = sum(stop - start - 1 for start, stop in ld.chunks([line.encode() for line in lines]))
    assert cut.where("l1 is not null").count() == 30 * 39 and units.count() == 39 + 29 * (39 - inside)


def test_boundaries_resist_shifts():
    rng = random.Random(1)
    lines = [str(rng.random()).encode() for _ in range(300)]
    ends = {lines[stop - 1] for _, stop in ld.chunks(lines)}
    moved = {line for line in ([b"new", *lines][stop - 1] for _, stop in ld.chunks([b"new", *lines]))}
    assert len(ends & moved) > 0.9 * len(ends)
    assert all(stop - start >= 2 for start, stop in ld.chunks(lines))


def test_empty_table_and_repeated_ids(spark, table):
    assert ld.line_dedup(table([])).collect() == []
    docs = table([(1, "a b\nc d"), (1, "a b\nc d"), (None, "x\ny")])
    assert sorted(r.text for r in ld.line_dedup(docs).select("row.text").collect()) == ["", "a b\nc d", "x\ny"]


def test_whole_table(spark, small):
    expected = brute([(r.doc_id, r.text) for r in read_table(spark, small, "documents").collect()])
    rows = QUERIES["op10_line_dedup"](spark, small).collect()
    assert {r.doc_id: (r.n_chars_left, r.n_lines, r.n_removed, r.n_runs) for r in rows} == {i: (len(left), *rest) for i, (left, *rest) in expected.items()}


@pytest.mark.parametrize("held", [1, 16_000_000])
def test_bytes_of_copies_are_not_written(table, monkeypatch, held):
    """Equal chunks inside and between tasks; chunks meet by their bytes once, and no intermediate keeps these."""
    written, write = [], ld.materialise

    def materialise(df, label):
        written.append((label, [f.dataType.simpleString() for f in df.schema]))
        return write(df, label)

    monkeypatch.setattr(ld, "materialise", materialise)
    monkeypatch.setattr(ld, "HELD_BYTES", held, raising=False)
    rng = random.Random(8)
    texts = ["\n".join(f"line {rng.randrange(40)} of {rng.randrange(3)}" for _ in range(rng.randrange(1, 30))) for _ in range(25)]
    rows = list(enumerate(texts + texts[::-1] + [texts[0] + "\n" + texts[1], None, "", "a\nb", "a\nb"]))
    rng.shuffle(rows)
    assert found(table(rows).repartition(5)) == brute(rows)
    assert "gone" in dict(written) and not [label for label, kinds in written if "binary" in kinds]
