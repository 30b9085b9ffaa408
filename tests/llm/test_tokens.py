"""Token counts and token files against the tokenizers library itself."""

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from edupipe.llm import token_files as tf
from edupipe.llm.queries import QUERIES, op3, op8
from edupipe.llm.queries import table as read_table
from edupipe.llm.token_counts import token_counts

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "\n\n  a", "it's I'LL we've  2½ x² ÀÉ ǅ", "a<|endoftext|>b <|startoftext|> c", "ΣΑΣ ΟΔΟΣ", "İstanbul",
    "日本語 テキスト", "é é", "\x1c\x1d tab\there \x85\xa0", "x" * 5000, "!!!??? ... --", "😀 emoji 👍🏽", "ﬁ ﬂ ǆ", "word " * 3000,
]


def test_counts_are_the_librarys(spark, table):
    docs = table([(i, t) for i, t in enumerate(ODD)] + [(0, "again"), (0, "again"), (None, "no id")])
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, BYTE, 100).collect())
    plain = Tokenizer.from_file(BYTE)
    expected = []
    for i, text in [(r.doc_id, r.text or "") for r in docs.collect()]:
        n = len(plain.encode(text, add_special_tokens=False))
        expected.append((i is None, i or 0, len(text.encode()), n, n > 100))
    assert got == sorted(expected)


def test_op3_whole_table(spark, small):
    plain = Tokenizer.from_file(BYTE)
    texts = {r.doc_id: r.text for r in read_table(spark, small, "documents").collect()}
    for row in op3(spark, small).collect():
        assert row.n_tokens == len(plain.encode(texts.pop(row.doc_id), add_special_tokens=False))
    assert not texts


def test_counts_of_nothing(spark, table):
    assert token_counts(table([]), BYTE).collect() == []


@pytest.mark.parametrize("width", [1, 3, 8, 11, 16, 17, 24, 32])
def test_packing_round_trip(width):
    rng = np.random.default_rng(width)
    for count in (0, 1, 7, 8, 9, 1000):
        ids = rng.integers(0, 1 << width, count, dtype=np.uint64).astype(np.uint32)
        data = tf.pack(ids, width)
        assert len(data) == -(-count * width // 8)
        assert np.array_equal(tf.unpack(data, count, width), ids)


def test_least_width():
    assert [tf.bit_width(n) for n in (1, 2, 3, 256, 257, 49408, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


class _File:
    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, count, at):
        return self.data[at : at + count]


def test_random_access():
    rng, out = random.Random(1), io.BytesIO()
    docs = [(i, np.array([rng.randrange(70_000) for _ in range(rng.choice([0, 1, 5, 4096, 9000]))], np.uint32)) for i in range(60)]
    writer = tf.Writer(out, 17)
    for i, ids in docs:
        writer.add(None if i == 3 else i, ids)
    writer.close()
    reader = tf.Reader(_File(out.getvalue()))
    for i in rng.sample(range(60), 60):
        assert np.array_equal(reader.document(i), docs[i][1])
    assert reader.nulls[3] and not reader.nulls[4]
    with pytest.raises(ValueError):
        tf.Reader(_File(out.getvalue()[:-80] + out.getvalue()[-79:]))


def _expected(rows):
    plain, start, out = Tokenizer.from_file(WORD), 0, []
    for i, text in rows:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_op8_whole_table(spark, small):
    docs = sorted((r.doc_id, r.text) for r in read_table(spark, small, "documents").collect())
    assert sorted(tuple(r) for r in op8(spark, small).collect()) == _expected(docs)


def test_files_of_odd_texts(spark, table):
    docs = table(list(enumerate(ODD)))
    back = tf.read_token_files(spark, tf.write_token_files(docs, WORD, 2)).collect()
    got = sorted((r.doc_id, r.start, len(r.ids) // 4, zlib.crc32(r.ids)) for r in back)
    assert got == _expected(enumerate(ODD))


def test_files_of_repeated_and_null_ids(spark, table):
    docs = table([(5, "b"), (5, "b"), (None, "n"), (5, "a"), (1, None)])
    back = sorted(tf.read_token_files(spark, tf.write_token_files(docs, WORD, None)).collect(), key=lambda r: (r.start, len(r.ids)))
    assert [r.doc_id for r in back if r.ids] == [None, 5, 5, 5]
    assert len(back) == 5
    assert tf.read_token_files(spark, tf.write_token_files(table([]), WORD, 2)).collect() == []


def test_queries_are_registered():
    assert {"op3_token_counts", "op8_token_files"} <= set(QUERIES)


def test_new_pieces_are_encoded_together():
    from edupipe.llm.token_counts import _Counter

    counter = _Counter(BYTE)
    pieces = [f" w{chr(97 + i % 26)}x{chr(97 + i // 26)}" for i in range(400)] + ["'s", "  ", " ", "\n", " été", " '", " 12", "日本", " 日本"]
    alone = [len(counter.tokenizer.encode(p, add_special_tokens=False)) for p in pieces]
    asked = []

    class Counted:
        def encode_batch_fast(self, texts, add_special_tokens):
            asked.extend(texts)
            return tokenizer.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    tokenizer, counter.tokenizer = counter.tokenizer, Counted()
    assert counter.encode(pieces) == alone and len(asked) < 20
    assert counter.counts(["a b", "", " c  d"], {}) == [len(tokenizer.encode(t, add_special_tokens=False)) for t in ("a b", "", " c  d")]


def test_token_files_are_fed_small_batches(spark):
    from edupipe.llm.common import BATCH_ROWS

    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "10000")
        docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
        tf.write_token_files(docs, WORD, 2)
        assert int(spark.conf.get(setting)) <= BATCH_ROWS
    finally:
        spark.conf.set(setting, before)
