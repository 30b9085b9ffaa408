"""Repeated passages of lines, by content-defined chunks of lines and what adjoins them.

A passage is a run of two lines or more, no two blank ones in a row, or one line of over ``WORDS`` words.  What
occurs again goes, and of equal passages the first (least document, then first in it) stays.

*Chunks.*  A text is cut into chunks of lines.  A boundary is where a rolling hash over the hashes of the last
``WINDOW`` lines falls into one of ``SPREAD`` classes, so it depends on the lines before it alone: lines put
in or taken out move the boundaries near them and no others.  Chunks whose 128-bit digest occurs once are left
alone; the bytes of the others meet, and a chunk that an earlier place has byte by byte goes whole.

*What chunks leave.*  The ends of a passage share a chunk with other lines, and a short passage may have no
chunk of its own.  So each adjacent pair of lines and each long line that is not inside a chunk that goes is looked up
by itself: a run occurred before exactly if all of its pairs did.  Together with the chunks these grow every
repeated run to its whole length, wherever it begins.  Where a pair lies in a chunk that goes, the
chunk's first document has it too, so copies send their chunks and not their lines.

A document finds its own repeats by their bytes.  Of what it has, the hashes of lines meet with those of other
documents; the lines of whatever meets are compared byte by byte, and where lines with one hash differ, their
passages meet again by their bytes.  Joins are merge joins at every size: what a small table takes then tells what a large one takes.

Defined results.  A null text stays null and has no lines; an empty text is one empty line.  A single line of ``WORDS`` words or fewer is
not a passage and stays, and so do blank lines by themselves.  The lines that stay are joined as they were; a text that loses all its lines
is empty.  Every row is a document of its own (see ``common.keyed``).  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edupipe.llm.common import BATCH_ROWS, KEY, keyed
from edupipe.llm.linking import grouped
from edupipe.llm.narrowing import document_filter, hash_filter, inside, narrowed
from edupipe.session import materialise

WINDOW = 2      # lines that decide on a boundary
SPREAD = 3      # one place in so many is a boundary
LEAST = 2       # lines of a chunk
WORDS = 50      # a line of more words is a passage by itself
HELD_BYTES = 16_000_000  # of chunks that a task holds to send equal ones once
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
UNIT = ["l1", "l2", "n"]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _hash(line: bytes) -> int:
    return _signed(xxhash.xxh3_64_intdigest(line))


def chunks(lines: list[bytes]) -> list[tuple[int, int]]:
    """The chunks [start, stop) of a text's lines; a text of fewer than ``LEAST`` lines has none."""
    if len(lines) < LEAST:
        return []
    hashes = [xxhash.xxh3_64_intdigest(line) for line in lines]
    lead = pow(BASE, WINDOW, 1 << 64)
    rolling, start, found = 0, 0, []
    for at, value in enumerate(hashes):
        rolling = (rolling * BASE + value) & MASK
        if at >= WINDOW:
            rolling = (rolling - hashes[at - WINDOW] * lead) & MASK
        mixed = ((rolling ^ (rolling >> 29)) * 0xBF58476D1CE4E5B9) & MASK
        if at + 1 - start >= LEAST and (mixed >> 32) % SPREAD == 0:
            found.append((start, at + 1))
            start = at + 1
    if len(lines) - start >= LEAST or not found:
        found.append((start, len(lines)))
    elif start < len(lines):
        found[-1] = (found[-1][0], len(lines))
    return found


def units(lines: list[bytes]) -> dict[tuple[bytes, ...], list[int]]:
    """The pairs of lines and the long lines of a text, each with the places where it begins."""
    places: dict[tuple[bytes, ...], list[int]] = {}
    blank = [not line.strip() for line in lines]
    for at, line in enumerate(lines):
        if len(line) > 2 * WORDS and len(line.split()) > WORDS:
            places.setdefault((line,), []).append(at)
        if at + 1 < len(lines) and not (blank[at] and blank[at + 1]):
            places.setdefault((line, lines[at + 1]), []).append(at)
    return places


CUT = "dk long, at long, n long, l1 long, l2 long, chunk long, d1 long, d2 long"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks of each document, with digests, and its units, with hashes: each unit once, at its first
    place, and with the chunk that holds it if one does."""
    schema = pa.schema([(c.split()[0], pa.int64()) for c in CUT.split(", ")])
    for batch in batches:
        rows = []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            lines = text.as_py().split(b"\n")
            of = [-1] * len(lines)
            for start, stop in chunks(lines):
                body = b"\n".join(lines[start:stop])
                if body.strip():
                    of[start:stop] = [start] * (stop - start)
                    digest = xxhash.xxh3_128_intdigest(body)
                    rows.append((key, start, stop - start, None, None, None, _signed(digest >> 64), _signed(digest & MASK)))
            for unit, places in units(lines).items():
                at, n = places[0], len(unit)
                rows.append((key, at, n, _hash(unit[0]), _hash(unit[1]) if n > 1 else 0, of[at] if of[at] == of[at + n - 1] else -1, None, None))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different lines of some units with their hashes, from (dk, text, found)."""
    for batch in batches:
        bodies = set()
        for text, found in zip(batch.column(1), batch.column(2).to_pylist()):
            lines = text.as_py().split(b"\n")
            bodies.update(line for f in found for line in lines[f["at"] : f["at"] + f["n"]])
        if bodies:
            rows = list(bodies)
            yield pa.RecordBatch.from_arrays([pa.array(map(_hash, rows), pa.int64()), pa.array(rows, pa.binary())], names=["hash", "body"])


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of some units, from (dk, text, found)."""
    for batch in batches:
        rows = []
        for key, text, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            lines = text.as_py().split(b"\n")
            rows += [(key, f["at"], f["n"], b"\n".join(lines[f["at"] : f["at"] + f["n"]])) for f in found]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary() if i == 3 else pa.int64()) for i, c in enumerate(zip(*rows))], names=[KEY, "at", "n", "body"]
            )


def _with_texts(texts: DataFrame, some: DataFrame, label: str) -> DataFrame:
    """(dk, text, found) of the documents that have some units (dk, at, n)."""
    found = materialise(some.groupBy(KEY).agg(F.collect_list(F.struct("at", "n")).alias("found")), label)
    return narrowed(texts, document_filter(found), True).join(found.hint("merge"), KEY)


CHUNK = "h long, dk long, at long, n long, body binary"


def _met_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary() if c.endswith("binary") else pa.int64() for c in CHUNK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=[c.split()[0] for c in CHUNK.split(", ")])


def _common_chunks(often):
    """(h, dk, at, n, body) of the chunks whose digest ``often`` lets through.

    Of equal ones a task sends the bytes once, with the first place, while it holds them (``HELD_BYTES``); the
    others come without bytes, as they have one before them.
    """
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = often.value
        held: dict[bytes, tuple[int, int, int, int]] = {}
        size = 0

        def given() -> Iterator[pa.RecordBatch]:
            rows = [(*place, body) for body, place in held.items()]
            for at in range(0, len(rows), BATCH_ROWS):
                yield _met_rows(rows[at : at + BATCH_ROWS])

        for batch in batches:
            places, bodies, digests = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                lines = text.as_py().split(b"\n")
                for start, stop in chunks(lines):
                    body = b"\n".join(lines[start:stop])
                    if body.strip():
                        digest = xxhash.xxh3_128_intdigest(body)
                        digests.append((_signed(digest >> 64), _signed(digest & MASK)))
                        places.append((key, start, stop - start))
                        bodies.append(body)
            if not places:
                continue
            later = []
            for i in np.flatnonzero(inside(bits, [pa.array(d, pa.int64()) for d in zip(*digests)])).tolist():
                place, body = (digests[i][0], *places[i]), bodies[i]
                if body in held:
                    first, other = sorted((held[body], place))
                    held[body] = first
                    later.append((other[1], *other[1:], None))  # anywhere, so not to the task of the chunk
                else:
                    held[body] = place
                    size += len(body)
            if later:
                yield _met_rows(later)
            if size > HELD_BYTES:
                yield from given()
                held.clear()
                size = 0
        yield from given()

    return emit


def _after_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dk, at, n) of the chunks that have an equal one before them, from rows sorted by (h, dk, at)."""
    rows = []
    for _, some in grouped(batches, 1):
        seen = set()  # of one half of a digest: one, as a rule
        for _, key, at, n, body in some:
            if body is None or body in seen:
                rows.append((key, at, n))
            else:
                seen.add(body)
        if len(rows) >= 8192:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=[KEY, "at", "n"])
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=[KEY, "at", "n"])


def repeated_chunks(texts: DataFrame, cut: DataFrame) -> DataFrame:
    """(dk, at, n): the chunks that are equal byte by byte to one at an earlier place.

    Texts are cut once more where they lie, and only the bytes of chunks that may repeat are shuffled, once.
    """
    context, digest = texts.sparkSession.sparkContext, ["d1", "d2"]
    often = cut.groupBy(*digest).agg(F.count("*").alias("times")).where("times > 1").select(*digest)
    often = materialise(often, "digests")
    having = materialise(cut.join(often.hint("merge"), digest, "left_semi").select(KEY).distinct(), "chunk-documents")
    emit = _common_chunks(context.broadcast(hash_filter(often)))
    met = narrowed(texts, document_filter(having), True).mapInArrow(emit, CHUNK)
    met = met.repartition("h").sortWithinPartitions("h", KEY, "at")
    return materialise(met.mapInArrow(_after_first, "dk long, at long, n long"), "gone")


def later_units(texts: DataFrame, cut: DataFrame, gone: DataFrame) -> DataFrame:
    """(dk, at, n): the units that an earlier document has, of those outside the chunks that are gone."""
    held = gone.select(KEY, F.col("at").alias("chunk"))
    cut = materialise(cut.join(held.hint("merge"), [KEY, "chunk"], "left_anti").select(KEY, "at", *UNIT), "units")
    often = cut.groupBy(*UNIT).agg(F.count("*").alias("documents"), F.min(KEY).alias("first"))
    often = materialise(often.where("documents > 1").select(*UNIT, "first"), "often")
    again = materialise(cut.join(often.hint("merge"), UNIT), "again")
    lines = _with_texts(texts, again, "candidates").mapInArrow(_lines, "hash long, body binary")
    mixed = materialise(lines.distinct().groupBy("hash").count().where("count > 1").select("hash"), "mixed")
    place = [KEY, "at", "n"]
    if mixed.isEmpty():
        return again.where(F.col(KEY) != F.col("first")).select(*place)
    of = again.select(*place, F.explode(F.array("l1", "l2")).alias("hash"))
    unsure = materialise(of.join(mixed, "hash", "left_semi").select(*place).distinct(), "unsure")
    sure = again.join(unsure, place, "left_anti").where(F.col(KEY) != F.col("first")).select(*place)
    read = _with_texts(texts, unsure, "unsure-documents")
    bodies = materialise(read.mapInArrow(_bodies, "dk long, at long, n long, body binary"), "bodies")
    firsts = materialise(bodies.groupBy("n", "body").agg(F.min(KEY).alias("first")), "firsts")
    return sure.unionByName(bodies.join(firsts, ["n", "body"]).where(F.col(KEY) != F.col("first")).select(*place))


def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of texts, from (row, found)."""
    for batch in batches:
        row = batch.column("row")
        where = row.type.get_field_index("text")
        texts, n_lines, n_removed, n_runs, n_chunks = [], [], [], [], []
        for text, found in zip(row.field(where).to_pylist(), batch.column("found").to_pylist()):
            lines = [] if text is None else text.encode().split(b"\n")
            before = {(f["at"], f["n"]) for f in found or [] if not f["chunk"]}
            whole = [(f["at"], f["at"] + f["n"]) for f in found or [] if f["chunk"]]
            chunk = {at: start for start, stop in whole for at in range(start, stop)}
            gone = set()
            for unit, places in units(lines).items():
                at, n = places[0], len(unit)
                known = (at, n) in before or (at in chunk and chunk[at] == chunk.get(at + n - 1))
                for at in places if known else places[1:]:
                    gone.update(range(at, at + n))
            n_lines.append(len(lines))
            n_removed.append(len(gone))
            n_runs.append(sum(at - 1 not in gone for at in gone))
            n_chunks.append(len(whole))
            texts.append(b"\n".join(line for i, line in enumerate(lines) if i not in gone).decode() if gone else text)
        fields = [row.field(i) for i in range(row.type.num_fields)]
        fields[where] = pa.array(texts, row.type.field(where).type)
        made = pa.StructArray.from_arrays(fields, fields=list(row.type))
        counts = [pa.array(c, pa.int64()) for c in (n_lines, n_removed, n_runs, n_chunks)]
        yield pa.RecordBatch.from_arrays([made, *counts], names=["row", "n_lines", "n_removed", "n_runs", "n_chunks"])


def line_dedup(docs: DataFrame) -> DataFrame:
    """Each document as (row with what is left of the text, n_lines before, n_removed lines, n_runs of lines removed,
    n_chunks equal to an earlier one)."""
    rows = keyed(docs)
    texts = rows.select(KEY, F.coalesce(F.col("row.text").cast("string"), F.lit("")).cast("binary").alias("text"))
    cut = materialise(texts.mapInArrow(_cut, CUT), "cut")
    gone = repeated_chunks(texts, cut.where("d1 is not null"))
    later = later_units(texts, cut.where("l1 is not null"), gone)
    both = gone.withColumn("chunk", F.lit(True)).unionByName(later.withColumn("chunk", F.lit(False)))
    found = materialise(both.groupBy(KEY).agg(F.collect_list(F.struct("at", "n", "chunk")).alias("found")), "later")
    words = document_filter(found)
    kind = T.StructType([T.StructField("row", docs.schema), *(T.StructField(c, T.LongType()) for c in ("n_lines", "n_removed", "n_runs", "n_chunks"))])
    none = F.lit(None).cast(found.schema["found"].dataType)
    alone = narrowed(rows, words, False).select("row", none.alias("found"))  # needs no shuffle
    some = narrowed(rows, words, True).join(found.hint("merge"), KEY, "left").select("row", "found")
    return alone.unionByName(some).mapInArrow(_rest, kind)


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with what is left of their texts.  A document that has lost all it had is left out."""
    left = line_dedup(docs)
    return left.where((F.col("n_removed") == 0) | F.col("row.text").rlike(r"[^\x20\x09-\x0D]")).select("row.*")
