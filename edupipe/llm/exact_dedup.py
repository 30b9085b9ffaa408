"""Exact duplicates by deterministic block naming.

A text without white space is cut into blocks of fixed size.  All blocks are sorted
and equal blocks get one integer name; then adjacent names are paired, the pairs are
sorted and named, and so on until every document has a single name.  Names are given by
comparing whole contents, never by a hash alone, so two documents have the same name
exactly when their texts are equal.

The sort is by range over (hash of the content, content, document, position): a block
that a third of the documents share is spread over as many tasks as its rows need.
Runs that reach over the edge of a task are joined by comparing the contents at the
edges, which are at most a few rows for each task.

Defined results.  A null or empty text, and one of white space only, is the empty text:
all such documents are copies of each other.  Every row is a document of its own, also
when its doc_id is null or repeats (then the rows are numbered, see ``common.keyed``).
Of equal texts the row with the most code points stays, then the smallest doc_id (null last),
then the first row.  An empty table gives an empty result.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edupipe.llm.common import KEY, keyed
from edupipe.session import materialise

BLOCK_BYTES = 32_768
WHITE = b" \t\n\x0b\x0c\r"
RUN_BITS = 40  # a name is the task's number followed by the number of the run in it
ROWS_PER_BATCH = 256

BLOCKS = "dk long, pos long, n_blocks long, n_chars long, sha binary, content binary"
NAMED = "dk long, pos long, n_blocks long, n_chars long, sha binary, name long, edge binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the normalised texts; the first one carries the document's length and digest."""
    schema = pa.schema([
        ("dk", pa.int64()), ("pos", pa.int64()), ("n_blocks", pa.int64()), ("n_chars", pa.int64()),
        ("sha", pa.binary()), ("content", pa.binary()),
    ])
    rows: list[tuple] = []

    def flush() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        rows.clear()
        return made

    for batch in batches:
        for key, n_chars, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            body = (text.as_py() or b"").translate(None, WHITE)
            n_blocks = max(1, -(-len(body) // BLOCK_BYTES))
            digest = hashlib.sha256(body).digest()
            for i in range(n_blocks):
                first = i == 0
                block = body[i * BLOCK_BYTES : (i + 1) * BLOCK_BYTES]
                rows.append((key, i, n_blocks, n_chars if first else None, digest if first else None, block))
                if len(rows) >= ROWS_PER_BATCH:
                    yield flush()
    if rows:
        yield flush()


def _name_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal contents in a sorted partition.

    Rows whose hash is the first or the last of the partition may have equals in a neighbour:
    one row of each such run carries its content.
    """
    base = TaskContext.get().partitionId() << RUN_BITS
    first_hash = last_hash = last_content = None
    run = -1
    edges: list[tuple[int, bytes]] = []  # runs with the hash that was read last
    for batch in batches:
        hashes = batch.column("h").to_pylist()
        contents = batch.column("content")
        names, edge = [], []
        for h, content in zip(hashes, contents):
            value = content.as_py()
            new = h != last_hash or value != last_content
            if h != last_hash:
                first_hash = h if run < 0 else first_hash
                edges.clear()
            if new:
                run += 1
                edges.append((base | run, value))
            names.append(base | run)
            edge.append(value if new and h == first_hash else None)
            last_hash, last_content = h, value
        kept = [batch.column(c) for c in ("dk", "pos", "n_blocks", "n_chars", "sha")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(names, pa.int64()), pa.array(edge, pa.binary())],
            names=["dk", "pos", "n_blocks", "n_chars", "sha", "name", "edge"],
        )
    if edges and last_hash != first_hash:  # no row of a document: only the contents at the end
        none = [None] * len(edges)
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(none, pa.int64())] * 4, pa.array(none, pa.binary()),
             pa.array([n for n, _ in edges], pa.int64()), pa.array([c for _, c in edges], pa.binary())],
            names=["dk", "pos", "n_blocks", "n_chars", "sha", "name", "edge"],
        )


def give_names(blocks: DataFrame, label: str) -> DataFrame:
    """Add ``name``: equal for rows of equal ``content``, different otherwise."""
    hashed = blocks.withColumn("h", F.xxhash64("content"))
    ordered = hashed.repartitionByRange("h", KEY, "pos").sortWithinPartitions("h", "content", KEY, "pos")
    found = materialise(ordered.mapInArrow(_name_runs, NAMED), label)
    edges = found.where("edge is not null").groupBy("edge", "name").agg(F.lit(1).alias("one"))
    least = edges.groupBy("edge").agg(F.min("name").alias("least"), F.collect_set("name").alias("names"))
    renamed = least.select("least", F.explode("names").alias("name")).where("name <> least")
    # at most two rows for each task of the sort, however many documents there are
    joined = found.where("dk is not null").drop("edge").join(F.broadcast(renamed), "name", "left")
    return joined.withColumn("name", F.coalesce("least", "name")).drop("least")


def document_names(docs: DataFrame) -> DataFrame:
    """(dk, level, name, n_chars, sha) of each document: (level, name) is its collision-free identity."""
    texts = docs.select(KEY, F.length("row.text").alias("n_chars"), F.col("row.text").cast("binary").alias("text"))
    texts = texts.withColumn("n_chars", F.coalesce("n_chars", F.lit(0)).cast("long"))
    named = give_names(texts.mapInArrow(_cut, BLOCKS), "names0")
    single, level = [], 0
    while True:
        done = named.where("n_blocks = 1")
        single.append(done.select(KEY, F.lit(level).alias("level"), "name", "n_chars", "sha"))
        open_ = named.where("n_blocks > 1")
        if open_.isEmpty():
            break
        level += 1
        half = F.expr("pos div 2")
        pairs = open_.groupBy(KEY, half.alias("pos")).agg(
            F.expr("(max(n_blocks) + 1) div 2").alias("n_blocks"),
            F.max("n_chars").alias("n_chars"),
            F.max("sha").alias("sha"),
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("b"),
        )
        content = F.concat_ws(",", "a", "b").cast("binary").alias("content")
        named = give_names(pairs.select(KEY, "pos", "n_blocks", "n_chars", "sha", content), f"names{level}")
    result = single[0]
    for more in single[1:]:
        result = result.unionByName(more)
    return result


def exact_copies(docs: DataFrame) -> DataFrame:
    """For each document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    return _decided(keyed(docs)).drop(KEY)


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = keyed(docs)
    return rows.join(_decided(rows).where("kept").select(KEY), KEY, "left_semi").select("row.*")


def _decided(rows: DataFrame) -> DataFrame:
    # doc_id is dk itself unless the rows were numbered: only then it is looked up
    named = document_names(rows)
    ids = rows.select(KEY, F.col("row.doc_id").alias("doc_id"))
    named = materialise(named.join(ids, KEY), "identities")
    order = F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id"), F.col(KEY).alias("k"))
    groups = named.groupBy("level", "name").agg(F.count("*").alias("group_size"), F.min(order).alias("best"))
    groups = materialise(groups, "groups")  # read back plainly, so that Spark can split a hot name
    joined = named.join(groups, ["level", "name"])
    return joined.select(
        KEY, "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col(KEY) == F.col("best.k")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )
