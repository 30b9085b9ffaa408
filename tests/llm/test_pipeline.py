"""Every stage of the pipeline against its brute-force version on what the stage before kept."""

import test_decontaminate
import test_line_dedup
import test_ngram_jaccard
import test_packing

import corpus_pipeline
from edupipe.llm import language_id, packing
from edupipe.llm.queries import table as read_table


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_stages(spark, small, tmp_path):
    docs = read_table(spark, small, "documents")
    columns, model = docs.columns, language_id.fit(docs)
    items = [(r.item_id, r.text) for r in read_table(spark, small, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = texts(docs)
        stage(spark, docs, small).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name == "pack":
            rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
            test_packing.verify(after.collect(), rows, packing.CAPACITY)
            break
        assert after.columns == columns
        if name == "language_id":
            expected = [(i, t) for i, t in before if model.predict(t)[0] != "und" and model.predict(t)[1] >= language_id.LEAST_SCORE]
        elif name == "line_dedup":
            left = test_line_dedup.brute(before)
            expected = [(i, t) for i, (t, _, gone, _) in sorted(left.items()) if not gone or t.strip()]
        elif name == "ngram_jaccard":
            parts = test_ngram_jaccard.brute(before)
            stay = {i for i, _, part in parts if i == part}
            expected = [(i, t) for i, t in before if i in stay]
        else:
            found = test_decontaminate.brute(before, items, 13)
            bad = {i for i, n, hit, _ in found if hit and 20 * hit >= n}
            expected = [(i, t) for i, t in before if i not in bad]
        assert texts(after) == expected
        assert 0 < len(expected) <= len(before)
        docs = after


def test_run(spark, small):
    rows = corpus_pipeline.run(spark, small)
    assert rows.columns == ["doc_id", "piece", "n_units", "shard", "bin", "start"]
    assert rows.count() > 100


def test_empty_table_and_odd_ids(spark, table, small, tmp_path):
    """No rows; null and repeated ids, null texts and columns whose names operators use: every stage keeps the columns and the clean rows."""
    words = [" ".join(f"word{k * 100 + i}" for i in range(30)) for k in range(4)]
    odd = [(1, words[0]), (1, words[1]), (None, words[2]), (None, None), (2, ""), (3, words[3])]
    for n, rows in enumerate(([], odd)):
        docs = table(rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            path = str(tmp_path / f"{n}-{name}")
            stage(spark, docs, small).write.parquet(path)
            after = spark.read.schema(docs.schema).parquet(path)
            assert after.columns == docs.columns
            docs = after
        texts_left = sorted(r.text for r in docs.collect())
        assert texts_left == (sorted(words) if rows else [])
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, small)
        assert packed.count() == len(texts_left)
