"""Leave documents that a join cannot change out of its shuffle.

A Bloom filter of the documents that the other side has is broadcast.  Its size is fixed; with more documents
than it has room for it lets more through, which costs time and changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edupipe.llm.common import KEY

WORDS = 1 << 20  # 64-bit words of the filter: 8 MB


def document_filter(keys: DataFrame) -> np.ndarray:
    """The filter of the column dk, of at most ``WORDS`` rows when it is collected."""
    return hash_filter(keys.select(*spots()))


def hash_filter(keys: DataFrame) -> np.ndarray:
    """The same of rows that are hashes already, in every column."""
    hashes = keys.select(F.explode(F.array(*keys.columns)).alias("x"))
    word = F.pmod("x", F.lit(WORDS)).cast("int").alias("word")
    bit = F.expr("shiftleft(1L, cast(pmod(shiftright(x, 32), 64) as int))").alias("bit")
    rows = hashes.select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(WORDS, np.int64)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return words


def spots():
    """The two hashes of a row's document that name its bits."""
    return F.xxhash64(KEY).alias("_x1"), F.xxhash64(F.lit(1), KEY).alias("_x2")


def inside(bits: np.ndarray, columns: list[pa.Array]) -> np.ndarray:
    """Which rows the filter lets through, from their ``spots``."""
    found = np.ones(len(columns[0]), bool)
    for column in columns:
        x = column.to_numpy()
        found &= (bits[x % len(bits)] >> ((x >> 32) % 64)) & 1 == 1
    return found


def narrowed(rows: DataFrame, words: np.ndarray, wanted: bool) -> DataFrame:
    """The rows (dk, ...) that the filter lets through, or the others."""
    shared = rows.sparkSession.sparkContext.broadcast(words)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            kept = batch.filter(pa.array(inside(bits, batch.columns[-2:]) == wanted))
            yield pa.RecordBatch.from_arrays(kept.columns[:-2], names=batch.schema.names[:-2])

    return rows.select("*", *spots()).mapInArrow(keep, rows.schema)
