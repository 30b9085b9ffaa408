"""What a chain of filters loses, and to which filter, for every order of the filters.

Five filters look at each document by itself; a mask says which of them it fails.  In one order
of the filters a document goes at the first one it fails, so its mask decides what it adds
to each of the 120 x 5 (order, step) outcomes.

Wide packed counters: every mask, with what ``labels`` says of the document, is one big integer with a field
of 64 bits for each outcome and measure.  Documents of a part are counted by mask first; the
integers, times these counts, are added up per part and the fields read from the one sum.  No field can
run into the next one below 2**64 documents.

The filters: A under 50 words; B 100 x different words below 65 x words; C 100 x capitals A-Z above
5 x code points; D holds one of ``#$%&*|``; E the text of a row with a smaller doc_id, removed or not.  Texts are the same
when their SHA-256 is.  What E needs is one row per text that repeats, joined back by a plain
shuffle join that Spark splits where a text is hot.

Defined results.  A null text is the empty one; a null part is ''.  Rows that share a doc_id do not
make each other fail E, a null doc_id is not smaller than any, nor is any smaller than it.  Several labels
of a doc_id count as one: 1 where any is 1.  A part has 600 rows, zeros included; an empty table
gives an empty result.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edupipe.llm.common import KEY, keyed, whole_text, worker_state
from edupipe.llm.linking import grouped
from edupipe.session import materialise

FILTERS = "ABCDE"
ORDERS = tuple("".join(p) for p in permutations(FILTERS))
MEASURES = ("kept", "removed", "redundant", "good_lost", "toxic_lost")
WORDS_AT_LEAST = 50
DIFFERENT_PERCENT = 65
CAPITAL_PERCENT = 5
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
SIGNS = b"#$%&*|"
E_BIT = 1 << FILTERS.index("E")
FIELD_BYTES = 8


def own_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()  # on the ASCII white space
    few = len(words) < WORDS_AT_LEAST
    same = 100 * len(set(words)) < DIFFERENT_PERCENT * len(words)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    loud = 100 * capitals > CAPITAL_PERCENT * len(text.decode())
    signs = len(text.translate(None, SIGNS)) < len(text)
    return few | same << 1 | loud << 2 | signs << 3


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(3)
        masks = [own_mask(t.as_py()) for t in texts]
        digests = [hashlib.sha256(t.as_py()).digest() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(3)), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
            names=["dk", "doc_id", "part", "mask", "digest"],
        )


def packed_mask(mask: int, good: bool, toxic: bool) -> int:
    """One document as a big integer: a field for each order, step and measure, then one for each filter that alone it fails."""
    fields = np.zeros((len(ORDERS), len(FILTERS), len(MEASURES)), "<u8")
    for o, order in enumerate(ORDERS):
        gone = False
        for step, name in enumerate(order):
            fails = bool(mask >> FILTERS.index(name) & 1)
            lost = fails and not gone
            fields[o, step] = (not gone and not fails, lost, fails and gone, lost and good, lost and toxic)
            gone |= fails
    alone = np.array([mask == 1 << i for i in range(len(FILTERS))], "<u8")
    return int.from_bytes(fields.tobytes() + alone.tobytes(), "little")


def unpack(total: int) -> tuple[np.ndarray, np.ndarray]:
    """The fields of a sum: (order, step, measure), and failures of one filter only."""
    n = len(ORDERS) * len(FILTERS) * len(MEASURES)
    fields = np.frombuffer(total.to_bytes((n + len(FILTERS)) * FIELD_BYTES, "little"), "<u8").astype(np.int64)
    return fields[:n].reshape(len(ORDERS), len(FILTERS), len(MEASURES)), fields[n:]


COLUMNS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The 600 rows of each part, from rows (part, mask, good, toxic, n) sorted by part."""
    wide = worker_state("filter_audit")
    letters = [name for order in ORDERS for name in order]
    which = np.array([FILTERS.index(name) for name in letters])
    for (part,), rows in grouped(batches, 1):
        total = 0
        for _, mask, good, toxic, n in rows:
            kind = (mask, good, toxic)
            if kind not in wide:
                wide[kind] = packed_mask(*kind)
            total += n * wide[kind]
        fields, alone = unpack(total)
        kept, removed, redundant, good_lost, toxic_lost = (fields[:, :, i].reshape(-1) for i in range(len(MEASURES)))
        of_filter = np.zeros(len(FILTERS), np.int64)
        np.add.at(of_filter, which, removed)
        orders = [order for order in ORDERS for _ in order]
        steps = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))
        columns = [[part] * len(orders), orders, steps, kept, removed, redundant, alone[which], good_lost, toxic_lost, of_filter[which]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in COLUMNS.split(", ")])


def failures(docs: DataFrame, part: str = "source") -> DataFrame:
    """For each document: dk, doc_id, part and mask, whose bits from the lowest on are the filters A to E it fails."""
    rows = keyed(docs)
    name = F.coalesce(F.col(f"row.{part}").cast("string"), F.lit("")).alias("part")
    texts = rows.select(KEY, F.col("row.doc_id").alias("doc_id"), name, whole_text().cast("binary").alias("text"))
    shape = f"dk long, doc_id {dict(docs.dtypes)['doc_id']}, part string, mask int, digest binary"
    own = materialise(texts.mapInArrow(_masks, shape), "masks")
    repeats = own.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")).where("rows > 1")
    repeats = materialise(repeats.select("digest", "first"), "repeats")  # read back plainly, so that Spark can split a hot text
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int") * E_BIT
    return own.join(repeats, "digest", "left").select(KEY, "doc_id", "part", F.col("mask").bitwiseOR(later).alias("mask"))


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """For each part, order of the filters and step: what is kept and removed, and what that costs."""
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c)
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(one("quality"), one("toxic"))
    marked = failures(docs, part).join(known, "doc_id", "left")
    good, toxic = (F.coalesce(c, F.lit(False)).alias(c) for c in ("quality", "toxic"))
    counts = marked.groupBy("part", "mask", good, toxic).agg(F.count("*").alias("n"))
    ordered = counts.repartition("part").sortWithinPartitions("part")  # at most 128 rows a part
    return ordered.mapInArrow(_audits, COLUMNS)
