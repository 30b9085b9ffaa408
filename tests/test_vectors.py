import numpy as np
import pytest
from pyspark.sql import functions as F

from edupipe.operators import vectors


def _frame(spark, matrix, labels=None):
    rows = [(i, [float(x) for x in v], int(labels[i]) if labels is not None else 0) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "id long, v array<float>, label int")


def _brute(matrix, k, corpus=None):
    m = np.asarray(matrix, dtype=np.float32).astype(np.float64)
    length = np.sqrt((m * m).sum(axis=1))
    out = {}
    for i in range(len(m)):
        if length[i] == 0:
            continue
        scored = [
            (-round(float((m[i] / length[i]) @ (m[j] / length[j])), 12), j)
            for j in (range(len(m)) if corpus is None else corpus)
            if j != i and length[j] > 0
        ]
        out[i] = [j for _, j in sorted(scored)[:k]]
    return out


def _table(df):
    got = {}
    for r in df.orderBy(F.desc("score"), "recommended_id").collect():
        got.setdefault(r["id"], []).append(r["recommended_id"])
    return got


def _matrix():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8)) * 4
    clustered = np.concatenate([c + rng.normal(size=(30, 8)) for c in centres])
    copies = np.repeat(clustered[:1], 80, axis=0)  # a large group of copies
    return np.concatenate([clustered, copies, np.zeros((2, 8))])


@pytest.mark.parametrize("block_rows", [4096, 16])
def test_knn_table_equals_brute_force(spark, block_rows):
    m = _matrix()
    got = _table(vectors.knn_table(_frame(spark, m), "id", "v", 5, block_rows=block_rows))
    assert got == _brute(m, 5)


def test_knn_table_with_filtered_corpus(spark):
    m = _matrix()
    labels = np.arange(len(m)) % 2
    df = _frame(spark, m, labels)
    got = _table(vectors.knn_table(df.where("label = 1"), "id", "v", 3, queries=df, block_rows=20))
    assert got == _brute(m, 3, [i for i in range(len(m)) if labels[i] == 1])


def test_pruning_leaves_out_far_cells(spark):
    rng = np.random.default_rng(5)
    m = np.concatenate([np.eye(16)[i] + rng.normal(size=(40, 16)) * 0.01 for i in range(16)])
    pivots = np.eye(16)
    cells = vectors._with_cells(vectors._unit_vectors(_frame(spark, m), "id", "v"), pivots)
    radii = {c: r for c, (_, r) in vectors._cell_stats(cells).items()}
    pairs = vectors._cell_pairs(pivots, radii, radii, vectors._inner_radii(cells, 6))
    assert sorted(pairs) == [(i, i) for i in range(16)]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_vectors_are_sent_by_tiles_not_by_blocks(spark, monkeypatch, kind):
    """Without close neighbours nothing is left out; a vector still goes to a few tiles of the other side only."""
    rng = np.random.default_rng(8)
    m = np.concatenate([rng.normal(size=(600, 24)), np.ones((3, 24))])
    df = _frame(spark, m).withColumn("id", F.col("id").cast(kind))
    sent = spark.sparkContext.accumulator(0)
    real = vectors._matrix
    monkeypatch.setattr(vectors, "_matrix", lambda column: sent.add(len(column)) or real(column))
    monkeypatch.setattr(vectors, "TILES", 4)
    got = _table(vectors.knn_table(df, "id", "v", 3, block_rows=8))
    if kind == "long":
        assert got == _brute(m, 3)
    else:
        by_text = sorted(range(len(m)), key=str)
        expected = _brute(m[by_text], 3)
        assert got == {str(by_text[i]): [str(by_text[j]) for j in found] for i, found in expected.items()}
    # found cells twice, then both sides in at most six tiles; by blocks each of 76 would meet 76
    assert 0 < sent.value < 603 * 20


def test_text_keys(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.1]), ("c", [0.0, 1.0])], "id string, v array<float>")
    assert _table(vectors.knn_table(df, "id", "v", 1)) == {"a": ["b"], "b": ["a"], "c": ["b"]}


def test_empty_corpus(spark):
    df = _frame(spark, [[1.0, 0.0]])
    assert vectors.knn_table(df.where("id < 0"), "id", "v", 5, queries=df).count() == 0
    assert vectors.knn_table(df, "id", "v", 5).count() == 0


def test_top_k(spark):
    df = _frame(spark, [[1, 0], [1, 0.1], [0, 1], [1, 0.2], [0, 0]], [1, 0, 0, 1, 0])
    ids = lambda **kw: [r["id"] for r in vectors.top_k(df, "id", "v", **kw).collect()]
    assert ids(wanted=0, k=2) == [1, 3]
    assert ids(wanted=0, k=9) == [1, 3, 2]  # fewer than k; the zero vector has no direction
    assert ids(wanted=0, k=2, condition=F.col("label") == 0) == [1, 2]  # exactly k although the filter drops the query
    assert ids(wanted=99, k=2) == []
    assert vectors.lookup(df, "id", 99).count() == 0


def test_neighbour_lists(spark):
    table = spark.createDataFrame([(1, 5, 0.5), (1, 3, 0.9), (1, 2, 0.5)], "id long, recommended_id long, score double")
    row = vectors.neighbour_lists(table, "id").first()
    assert [tuple(x) for x in row["neighbours"]] == [(3, 0.9), (2, 0.5), (5, 0.5)]
