"""Operators against straightforward Python on many generated inputs."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.functions import arrays, sections
from edupipe.operators import web
from edupipe.streaming.ttl import passing

LINES = ["duration", "Duration", "scholarship value", "application papers", "x", "", " y ", "duration ", "number of scholarships", "value"]


def _section(lines, heading, stops):
    """The lines between the first heading that has a stop and that stop."""
    low = [line.lower() for line in lines]
    for i in range(1, len(lines) - 1):
        if low[i] == heading:
            for j in range(i + 2, len(lines) - 1):
                if low[j] in stops:
                    return "\n".join(lines[i + 1:j]).strip()
    return None


def test_sections_between_lines(spark):
    rng = random.Random(11)
    texts = [[rng.choice(LINES) for _ in range(rng.randrange(1, 14))] for _ in range(3000)]
    df = spark.createDataFrame([(i, "\n".join(t)) for i, t in enumerate(texts)], "i int, t string")
    section = sections.Section(fv.DURATION_HEADINGS, fv.DURATION_STOPS)
    got = {r["i"]: r["x"] for r in df.select("i", section.body(F.col("t")).alias("x")).collect()}
    expected = {i: _section(t, "duration", fv.DURATION_STOPS) for i, t in enumerate(texts)}
    assert got == expected
    assert sum(x is not None for x in expected.values()) > 100


def test_best_in_array(spark):
    rng = random.Random(12)
    rows = [
        (i, [(rng.choice(["a", "b", "c", None]), rng.choice([1, 2, 3, None]), p) for p in range(rng.randrange(0, 9))])
        for i in range(800)
    ]

    def brute(elements):
        best = {}
        for k, n, p in elements:
            rank = (n is None, -(n or 0), p)
            if k not in best or rank < best[k][0]:
                best[k] = (rank, (k, n, p))
        return sorted((e for _, e in best.values()), key=lambda e: e[2]) or None

    df = spark.createDataFrame(rows, "i int, a array<struct<k:string,n:int,p:int>>")
    got = {r["i"]: r["a"] and [tuple(x) for x in r["a"]] for r in arrays.keep_latest_in_array(df, "a", "k", "n").collect()}
    assert got == {i: brute(a) for i, a in rows}


@given(st.lists(st.integers(0, 30_000), unique=True), st.one_of(st.none(), st.integers(-5000, 0)))
@settings(max_examples=300, deadline=None)
def test_passing_events_are_apart_and_none_is_missed(seconds, last):
    ordered = sorted(seconds)
    kept = [ordered[at] for at in passing(np.array(ordered, np.int64), last, 3600)]
    before = ([] if last is None else [last]) + kept
    assert all(b - a >= 3600 for a, b in zip(before, before[1:]))
    for second in set(ordered) - set(kept):
        assert any(0 <= second - passed < 3600 for passed in before)


@given(st.recursive(st.text(alphabet="ab <&", max_size=5), lambda c: st.tuples(st.sampled_from(["p", "div", "b", "li"]), st.lists(c, max_size=4)), max_leaves=12))
@settings(max_examples=200, deadline=None)
def test_blocks_of_well_formed_pages(tree):
    def html(node):
        if isinstance(node, str):
            return node.replace("&", "&amp;").replace("<", "&lt;")
        return f"<{node[0]}>{''.join(map(html, node[1]))}</{node[0]}>"

    def texts(node):
        """Stripped text runs; neighbouring texts form one run."""
        runs = [""]
        for child in node[1]:
            if isinstance(child, str):
                runs[-1] += child
            else:
                runs += [*texts(child), ""]
        return [r.strip() for r in runs]

    def blocks(node):
        if isinstance(node, str):
            return []
        own = [(node[0], "".join(texts(node)))] if node[0] != "b" else []
        return [b for b in own if b[1]] + [b for child in node[1] for b in blocks(child)]

    assert web.blocks_of(html(tree)) == blocks(tree)
