"""Stored tables, the stored vector index, snapshots, counts taken while writing, and similar people for all."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edupipe.operators import quality, similar, stored, vector_index
from edupipe.session import fresh_path
from edupipe.sources import snapshots
from helpers import tuples

NODE = "label string, key string, name string, at int"


def _files(path):
    """The files of each bucket of a table on the local disk."""
    root = path.removeprefix("file:")
    return {d: sorted(f for f in os.listdir(f"{root}/{d}") if f.startswith("part-")) for d in os.listdir(root) if d.startswith(stored.BUCKET)}


def test_last_writer_wins_and_untouched_buckets_keep_their_files(spark):
    path = fresh_path(spark, "nodes")
    first = spark.createDataFrame([("P", str(i), f"a{i}", 0) for i in range(200)] + [("P", None, "nobody", 0), ("P", "5", "later", 9)], NODE)
    assert stored.merge_rows(first, path, ["label", "key"], [F.col("at")], 1, 16) == 16
    before = _files(path)
    second = spark.createDataFrame([("P", "3", "b3", 0), ("P", "3", "c3", 1), ("P", "new", "n", 0)], NODE)
    touched = stored.merge_rows(second, path, ["label", "key"], [F.col("at")], 2, 16)
    after = _files(path)
    assert touched <= 2 and sum(after[b] == before[b] for b in before) == 16 - touched
    rows = {r["key"]: r["name"] for r in stored.read_stored(spark, path).collect()}
    assert rows["3"] == "c3" and rows["new"] == "n" and rows["5"] == "later" and rows[None] == "nobody" and len(rows) == 202
    assert stored.read_stored(spark, path).columns == ["label", "key", "name", "at"]


def test_an_older_run_does_not_win_and_a_repeated_one_changes_nothing(spark):
    path = fresh_path(spark, "nodes")
    new = spark.createDataFrame([("P", "1", "new", 0), ("P", "2", "new", 0)], NODE)
    old = spark.createDataFrame([("P", "1", "old", 5), ("P", "3", "old", 5)], NODE)
    for changes, version in ((new, 2), (old, 1), (new, 2), (old, 1)):
        stored.merge_rows(changes, path, ["label", "key"], [F.col("at")], version, 8)
        if version == 1:
            assert tuples(stored.read_stored(spark, path), "key", "name") == [("1", "new"), ("2", "new"), ("3", "old")]
    assert stored.merge_rows(new.limit(0), path, ["label", "key"], [F.col("at")], 3, 8) == 0


def _brute_similar(edges, weights, k):
    vectors = {}
    for src, kind, dst in set(edges):
        if weights.get(kind):
            vectors.setdefault(src, {})[kind, dst] = weights[kind]
    norms = {s: sum(w * w for w in v.values()) for s, v in vectors.items()}
    out = []
    for s, v in vectors.items():
        scored = []
        for o, u in vectors.items():
            dot = sum(w * u[i] for i, w in v.items() if i in u)
            if o != s and dot:
                scored.append((-(dot / math.sqrt(float(norms[s] * norms[o]))), o))
        out += [(s, o, -x) for x, o in sorted(scored)[:k]]
    return sorted(out)


@pytest.mark.parametrize("cap", [1, 4, 1000])
def test_similar_people_against_all_pairs(spark, cap):
    rng = random.Random(3)
    edges = [(p, "HAS_SKILL", f"s{min(int(rng.paretovariate(0.7)), 60)}") for p in range(80) for _ in range(rng.randrange(1, 9))]
    edges += [(p, "LIVES_IN", f"c{p % 3}") for p in range(80)] + [(200, "HAS_SKILL", "alone"), (201, "OTHER", "x"), (202, "SPEAKS", "z"), (203, "SPEAKS", "z")]
    weights = {"HAS_SKILL": 2, "LIVES_IN": 1, "SPEAKS": 2}
    df = spark.createDataFrame(edges + edges[:20], "src long, type string, dst string")
    found = similar.most_similar(df, 3, weights, first_cap=cap, growth=3)
    expected = _brute_similar(edges, weights, 3)
    got = sorted(tuple(r) for r in found.collect())
    assert [r[:2] for r in got] == [r[:2] for r in expected]
    assert all(abs(a[2] - b[2]) < 1e-12 for a, b in zip(got, expected))


def test_people_are_not_paired_with_all_people(spark):
    """Everybody shares a hub; twins share rare items, and the hub decides nothing."""
    n = 4000
    people = spark.range(n).select(F.col("id").alias("src"))
    rare = people.select("src", F.lit("HAS_SKILL").alias("type"), F.explode(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.concat_ws("-", F.floor(F.col("src") / 4).cast("string"), i.cast("string")))).alias("dst"))
    hub = people.select("src", F.lit("LIVES_IN").alias("type"), F.lit("here").alias("dst"))
    edges = rare.union(hub)
    vectors = similar.profile_vectors(edges, {"HAS_SKILL": 2, "LIVES_IN": 1})
    candidates = similar.partial_scores(vectors, people, similar.FIRST_CAP).count()
    assert candidates == 3 * n  # of n * (n - 1) pairs
    found, open_ = similar._round(vectors, people, 3, similar.FIRST_CAP)
    assert open_.isEmpty() and found.count() == 3 * n
    assert found.where("floor(src / 4) <> floor(other / 4)").isEmpty()


@pytest.mark.parametrize("kind", ["long", "string"])
def test_one_short_profile_does_not_open_a_hub(spark, kind):
    """Somebody with only the hub is as near to all as the hub can bring them; nobody is paired over the whole hub."""
    rng = random.Random(4)
    edges = [(p, "HAS_SKILL", f"s{rng.randrange(300)}") for p in range(300) for _ in range(6)]
    edges += [(p, "LIVES_IN", "here") for p in range(320)]  # the last 20 have nothing else
    weights = {"HAS_SKILL": 2, "LIVES_IN": 1}
    edges = [(p if kind == "long" else f"p{p:03}", t, d) for p, t, d in edges]
    df = spark.createDataFrame(edges, f"src {kind}, type string, dst string")
    vectors = similar.profile_vectors(df, weights)
    found, open_ = similar._round(vectors, vectors.select("src").distinct(), 3, 64)
    assert open_.isEmpty()
    expected = _brute_similar(edges, weights, 3)
    assert sorted(tuple(r)[:2] for r in found.collect()) == sorted(r[:2] for r in expected)
    made = similar.partial_scores(vectors, vectors.select("src").distinct(), 64, 3)
    assert made.count() < 320 * 20  # of 320 * 319 pairs


def _vectors(rng, n, dimension=6):
    centres = [[rng.gauss(0, 1) for _ in range(dimension)] for _ in range(8)]
    return [(i, "l", [c + rng.gauss(0, 0.05) for c in rng.choice(centres)]) for i in range(n)]


def _brute_nearest(rows, point, k, without=None):
    def cosine(v):
        length = math.sqrt(sum(x * x for x in v)) * math.sqrt(sum(x * x for x in point))
        return sum(x * y for x, y in zip(v, point)) / length if length else 0.0

    return sorted(((-round(cosine(v), 12), i) for i, _, v in rows if i != without and v is not None))[:k]


def test_index_is_exact_after_inserts_and_reads_few_rows(spark):
    rng = random.Random(11)
    rows = _vectors(rng, 900) + [(900, "null", None), (901, "zero", [0.0] * 6)]
    path, shape = fresh_path(spark, "index"), "id long, label string, v array<double>"
    vector_index.create(spark.createDataFrame(rows[:400], shape), "id", "v", path, ["label"])
    folders = len(os.listdir(path.removeprefix("file:") + "/pivots"))
    for low, high in ((400, 700), (700, len(rows))):
        vector_index.insert(spark.createDataFrame(rows[low:high], shape), "id", "v", path, ["label"])
    assert len(os.listdir(path.removeprefix("file:") + "/pivots")) == folders
    for query in (5, 450, 850):
        found, compared = vector_index.nearest(spark, path, rows[query][2], 5, without=query)
        expected = _brute_nearest(rows, rows[query][2], 5, query)
        assert [(-round(r["score"], 12), r["key"]) for r in found.collect()] == expected
        assert compared < 450  # of 901: the far cells are not read
    found, _ = vector_index.nearest(spark, path, [rng.gauss(0, 1) for _ in range(6)], 901)
    assert found.count() == 901


def test_index_without_vectors(spark):
    path = fresh_path(spark, "index")
    empty = spark.createDataFrame([(1, "x", None)], "id long, label string, v array<double>")
    vector_index.create(empty, "id", "v", path)
    with pytest.raises(ValueError):
        vector_index.insert(empty, "id", "v", path)


def test_pivots_grow_with_the_vectors(spark):
    counts = []
    for n in (25, 400):
        path = fresh_path(spark, "index")
        vector_index.create(spark.createDataFrame(_vectors(random.Random(n), n), "id long, label string, v array<double>"), "id", "v", path)
        counts.append(spark.read.parquet(f"{path}/pivots").count())
    assert counts == [5, 20]


def test_a_version_that_fails_half_way_is_not_seen(spark):
    folder = fresh_path(spark, "snapshot")
    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, folder)
    one = {"a": spark.range(3), "b": spark.range(5)}
    assert snapshots.publish(spark, one, folder) == 1
    failing = spark.range(4).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        snapshots.publish(spark, {"a": spark.range(30), "b": failing}, folder)
    assert {k: v.count() for k, v in snapshots.read_snapshot(spark, folder).items()} == {"a": 3, "b": 5}
    assert snapshots.publish(spark, {"a": spark.range(7), "b": spark.range(8)}, folder) == 2
    assert {k: v.count() for k, v in snapshots.read_snapshot(spark, folder).items()} == {"a": 7, "b": 8}
    assert {k: v.count() for k, v in snapshots.read_snapshot(spark, folder, 1).items()} == {"a": 3, "b": 5}
    with pytest.raises(FileExistsError):
        snapshots.publish(spark, one, folder, 2)


def test_counts_are_taken_by_the_write(spark):
    """The counts come with the write: one job, no scan of what was written."""
    path = fresh_path(spark, "outcomes")
    rows = spark.createDataFrame([(i, '{"k": 1}' if i % 3 else '{"k"') for i in range(90)], "id long, json string")
    marked = quality.mark_outcome(rows, "json", T.StructType([T.StructField("k", T.IntegerType())]))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("observed", "observed")
    try:
        seen = quality.write_outcomes(marked.select("id", "json", "outcome"), path)
    finally:
        jobs = tracker.getJobIdsForGroup("observed")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert seen == {"input": 90, "succeeded": 60, "failed": 30} and len(jobs) == 1
    assert spark.read.parquet(path).groupBy("outcome").count().count() == 2
    empty = quality.write_outcomes(marked.where("id < 0").select("id", "outcome"), fresh_path(spark, "outcomes"))
    assert empty == {"input": 0, "succeeded": 0, "failed": 0}


def test_similar_people_go_through_in_slices(spark, monkeypatch):
    """However few lists are sent at a time, everybody gets the same neighbours."""
    written, write = [], similar.materialise

    def materialise(df, label):
        written.append(label)
        return write(df, label)

    monkeypatch.setattr(similar, "materialise", materialise)
    monkeypatch.setattr(similar, "SENT", 1, raising=False)
    monkeypatch.setattr(similar, "SENT_PER_ROW", 1, raising=False)
    rng = random.Random(12)
    edges = [(s, "HAS_SKILL", rng.randrange(25)) for s in range(60) for _ in range(6)] + [(s, "LIVES_IN", s % 3) for s in range(60)]
    df = spark.createDataFrame(edges, "src long, type string, dst long")
    weights = {"HAS_SKILL": 2, "LIVES_IN": 1}
    found = similar.most_similar(df, 3, weights, first_cap=4, growth=3)
    assert sorted(map(tuple, found.withColumn("score", F.round("score", 9)).collect())) == [(s, o, round(x, 9)) for s, o, x in _brute_similar(edges, weights, 3)]
    assert written.count("partial") > written.count("lists") > 1
