"""Held-out accuracy and the rules of language identification."""

import zlib

import numpy as np

from edupipe.llm import language_id as li
from edupipe.llm.queries import op6
from edupipe.llm.queries import table as read_table


def test_op6_whole_table(spark, small):
    known = {r.doc_id: (r.text, r.lang) for r in read_table(spark, small, "documents").collect()}
    rows = op6(spark, small).collect()
    assert {r.doc_id for r in rows} == set(known) and len(rows) == len(known)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.lang_pred in {"en", "de", "fr", "es", "und"} for r in rows)
    right = [r.lang_pred == known[r.doc_id][1] for r in rows if r.held_out]
    assert sum(right) >= 0.95 * len(right)


def test_labels_of_held_out_rows_do_not_matter(spark, small):
    docs = read_table(spark, small, "documents").select("doc_id", "text", "lang")
    from pyspark.sql import functions as F

    wrong = docs.withColumn("lang", F.when(li.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    a = {r[0]: r[1:] for r in li.identify(docs).select("row.doc_id", "lang_pred", "score").collect()}
    b = {r[0]: r[1:] for r in li.identify(wrong.repartition(5)).select("row.doc_id", "lang_pred", "score").collect()}
    assert a.keys() == b.keys()
    assert all(a[i][0] == b[i][0] and abs(a[i][1] - b[i][1]) < 1e-9 for i in a)


def test_odd_texts(spark, table, small):
    model = li.fit(read_table(spark, small, "documents"))
    docs = table([(1, None), (1, ""), (2, "123 !? ..."), (None, "the and of " * 50), (3, "é" * 100_000), (4, "日本語")])
    found = li.identify(docs, model).select("row.text", "held_out", "lang_pred", "score").collect()
    for r in found:
        assert (r.lang_pred == "und") == (r.text is None or not any(c.isalpha() for c in r.text))
        assert r.score > 0 or r.lang_pred == "und"
    assert li.with_language(docs.where("text is null or text = ''")).collect() == []
    assert li.identify(table([])).collect() == []


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "words", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in li.identify(docs).collect()} == {("und", 0.0)}


def test_penalties_make_the_model_sparse_and_temperature_fits():
    learner = li.Learner(2)
    rng = np.random.default_rng(0)
    for _ in range(300):
        language = int(rng.integers(2))
        noise = 100 + rng.choice(5000, 20, replace=False)
        at = np.unique(np.append(noise, language))
        values = np.full(len(at), 1 / np.sqrt(len(at)))
        learner.learn(at, values, language)
    weights = learner.weights(slice(None))
    assert weights[0, 0] > 0 > weights[1, 0]
    assert (weights == 0).mean() > 0.8
    truth = rng.integers(0, 2, 4000)
    sure = np.where(rng.random(4000) < 0.75, truth, 1 - truth)  # right three times out of four
    logits = np.zeros((4000, 2))
    logits[np.arange(4000), sure] = 9.0
    heat = li.temperature(logits, truth)
    assert abs(li.softmax(logits / heat).max(axis=1).mean() - 0.75) < 0.03


def test_counts_are_grams():
    a, b = li.gram_counts("Ab c"), li.gram_counts("ab, c!")
    assert np.array_equal(a, b) and a.sum() == 6 + 5 + 4
    assert li.gram_counts("12 .") is None
