"""Repeated byte strings of a fixed length, by a depth-limited radix sort of sampled suffixes.

Every byte inside a string of ``DEPTH`` bytes that starts anywhere else too is found and
removed.  Sorting all suffixes to that depth would shuffle many times the input, so suffixes are
sampled: the anchor of a window of ``DEPTH`` bytes is the leftmost of its ``GRAM``-byte strings with
the least hash.  Equal windows have their anchors at the same place, and one anchor serves
a whole run of windows, about one for every ``(DEPTH - GRAM) / 2`` bytes.

The anchors are then sorted digit by digit, the most significant first, and a group of one is out of the
sort, as no window of it can be repeated:

* first digit: the ``GRAM`` bytes at the anchor;
* runs of windows that are equal as a whole (a 128-bit digest of all their bytes) are repeated as a
  whole: the inside of long copies ends here, in one row for each run;
* next digits, for what is left: windows of the run by their distance from the anchor, in ranges
  of 64, then halves of them down to one window.  The digit of a range is what its windows have
  in common, so a range on its own is out, and a range whose whole span is equal is repeated;
  a range of one window ends with groups that are exactly the repeated windows.  This part
  compares the bytes themselves.

A group that fits in a task is refined there.  A group of more than ``MEMBERS`` different runs is dealt out
anew by its next digit (a 128-bit digest that only brings rows together), up to single windows, whose bytes
are compared by counting them; no group is ever held as a whole.

Defined results.  Null is empty.  Texts shorter than ``DEPTH`` bytes lose nothing.  All occurrences go, the first one too,
and strings are judged on the input.  Every row is a document of its own (see ``common.keyed``), so a
repeated row of ``DEPTH`` bytes or more loses all its bytes.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edupipe.llm.common import KEY, keyed
from edupipe.llm.linking import grouped
from edupipe.llm.narrowing import document_filter, narrowed
from edupipe.session import materialise

DEPTH = 400
GRAM = 64
MEMBERS = 2048                # different runs of a group that one task refines
RANGES = (64, 8, 1)           # windows in a range, digit by digit, when a group is dealt out
SEGMENT = 1 << 20             # window starts that are anchored at a time
PLACE_BITS = 22               # of a key: the place inside a segment

ANCHORS = "dk long, p long, o_min int, o_max int, h long, u1 long, u2 long"
CONTEXTS = "g1 long, g2 long, dk long, p long, o_min int, o_max int, wanted boolean, low int, ctx binary"
SPANS = "dk long, start long, stop long"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes (a power of two) from every place on."""
    h, span = data.astype(np.uint64) + np.uint64(1), 1
    while span < GRAM:
        h = _mixed(h[:-span] * np.uint64(0x9E3779B97F4A7C15 + 2 * span) + h[span:])
        span *= 2
    return _mixed(h)


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first window, last window, hash) of the anchors of all windows of ``data``."""
    h = gram_hashes(data)
    width = DEPTH - GRAM + 1
    keys = (h >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(h), dtype=np.uint64)
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, ~np.uint64(0))
    padded[: len(keys)] = keys
    rows = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    windows = len(data) - DEPTH + 1
    least = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows])
    place = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:], [windows]]) - 1
    return place[first], first, last, h[place[first]]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["dk", "p", "o_min", "o_max", "h", "u1", "u2"]
    for batch in batches:
        columns: list[list[np.ndarray]] = [[] for _ in names]
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            whole = memoryview(text.as_py())
            for at in range(0, max(0, len(whole) - DEPTH + 1), SEGMENT):
                view = whole[at : at + SEGMENT + DEPTH - 1]
                place, first, last, h = anchors(np.frombuffer(view, np.uint8))
                digests = [xxhash.xxh3_128_intdigest(view[a : b + DEPTH]) for a, b in zip(first.tolist(), last.tolist())]
                values = (
                    np.full(len(place), key), place + at, (place - last).astype(np.int32), (place - first).astype(np.int32), h.view(np.int64),
                    np.array([_signed(d >> 64) for d in digests], np.int64), np.array([_signed(d & ((1 << 64) - 1)) for d in digests], np.int64),
                )
                for column, value in zip(columns, values):
                    column.append(value)
        if columns[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=names)


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes that the windows of each run span, from (dk, text, runs)."""
    for batch in batches:
        rows = []
        for key, text, runs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            data = text.as_py()
            for r in runs:
                p, low, high = r["p"], r["o_min"], r["o_max"]
                rows.append((r["h"], 0, key, p, low, high, r["wanted"], 0, data[p - high : p - low + DEPTH]))
        if rows:
            yield _contexts(rows)


def _contexts(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("g1", pa.int64()), ("g2", pa.int64()), ("dk", pa.int64()), ("p", pa.int64()), ("o_min", pa.int32()), ("o_max", pa.int32()),
             ("wanted", pa.bool_()), ("low", pa.int32()), ("ctx", pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], names=[n for n, _ in kinds])


def _common(o_max: int, ctx: bytes, low: int, high: int) -> bytes:
    """What the windows at distances from ``low`` to ``high`` have in common."""
    start = o_max - low
    return ctx[start : max(start, o_max + DEPTH - high)]


def repeated(members: list[tuple[int, int, bool, bytes]], ranges: list[tuple[int, int]]) -> dict[int, list[tuple[int, int]]]:
    """Of the members (o_min, o_max, wanted, bytes) with equal anchors, the ranges of distances of
    repeated windows of those that are wanted."""
    found: dict[int, list[tuple[int, int]]] = {}
    stack = [(low, high, list(range(len(members)))) for low, high in ranges]
    while stack:
        low, high, ids = stack.pop()
        by_digit: dict[bytes, list[int]] = {}
        for i in ids:
            o_min, o_max, _, ctx = members[i]
            if o_max >= low and o_min <= high:
                by_digit.setdefault(_common(o_max, ctx, low, high), []).append(i)
        for group in by_digit.values():
            if len(group) < 2:
                continue
            spans: dict[bytes, list[int]] = {}
            for i in group:
                o_min, o_max, _, ctx = members[i]
                if o_min <= low and o_max >= high:
                    spans.setdefault(ctx[o_max - high : o_max - low + DEPTH], []).append(i)
            same = {i for equal in spans.values() if len(equal) > 1 for i in equal}
            for i in same:
                if members[i][2]:
                    found.setdefault(i, []).append((low, high))
            if low < high and any(members[i][2] and i not in same for i in group):
                middle = (low + high) // 2
                stack += [(low, middle, group), (middle + 1, high, group)]
    return found


def _refine(size: int | None):
    """Spans of repeated windows of each group; ``size`` is that of the ranges that were dealt out, if any."""
    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = RANGES[0]
        for _, rows in grouped(batches, 3):
            members, places, low = [], [], 0
            for _, _, low, key, p, o_min, o_max, wanted, ctx in rows:
                members.append((o_min, o_max, wanted, ctx))
                places.append((key, p))
            ranges = [(low, low + size - 1)] if size else [(a, a + step - 1) for a in range(0, DEPTH - GRAM + 1, step)]
            spans = [(*places[i], a, b) for i, found in repeated(members, ranges).items() for a, b in found]
            if spans:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _, _, _ in spans], pa.int64()), pa.array([p - b for _, p, _, b in spans], pa.int64()),
                     pa.array([p - a + DEPTH for _, p, a, _ in spans], pa.int64())],
                    names=["dk", "start", "stop"],
                )

    return refine


def _deal(size: int, before: int | None):
    """Every run once for each range of ``size`` windows that it has, by the digit of the range."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for g1, g2, key, p, o_min, o_max, wanted, low, ctx in zip(*(c.to_pylist() for c in batch.columns)):
                first, last = (low, low + before - 1) if before else (0, DEPTH - GRAM)
                for a in range(first, last + 1, size):
                    if o_max >= a and o_min <= a + size - 1:
                        digit = xxhash.xxh3_128_intdigest(_common(o_max, ctx, a, a + size - 1), seed=g1 & 0xFFFFFFFF)
                        rows.append((_signed(digit >> 64), _signed(digit & ((1 << 64) - 1)), key, p, o_min, o_max, wanted, a, ctx))
                if len(rows) > 4096:
                    yield _contexts(rows)
                    rows = []
            if rows:
                yield _contexts(rows)

    return deal


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(dk, start, stop) of stretches of repeated windows of documents (dk, text as bytes); they may overlap."""
    found = materialise(texts.mapInArrow(_anchor_rows, ANCHORS), "anchors")
    often = found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    shared = materialise(found.join(materialise(often, "digits"), "h", "left_semi"), "shared-anchors")

    run = ["h", "o_min", "o_max", "u1", "u2"]
    runs = shared.groupBy(*run).agg(F.count("*").alias("n"), F.min(F.struct(KEY, "p")).alias("one"))
    runs = materialise(runs, "runs")
    equal = shared.join(runs.where("n > 1").select(*run), run, "left_semi")
    spans = equal.select(KEY, (F.col("p") - F.col("o_max")).alias("start"), (F.col("p") - F.col("o_min") + DEPTH).alias("stop"))
    spans = materialise(spans, "equal-runs")

    groups = runs.groupBy("h").agg(F.count("*").alias("members"), F.sum((F.col("n") == 1).cast("int")).alias("open"))
    groups = materialise(groups.where("members > 1 and open > 0"), "groups")
    open_ = runs.join(groups, "h").select(
        F.col("one.dk").alias(KEY), F.struct(F.col("one.p").alias("p"), "o_min", "o_max", "h", (F.col("n") == 1).alias("wanted")).alias("r"),
    )
    by_document = materialise(open_.groupBy(KEY).agg(F.collect_list("r").alias("runs")), "open-runs")
    some = narrowed(texts, document_filter(by_document), True)
    level = materialise(some.join(by_document, KEY).mapInArrow(_context_rows, CONTEXTS), "contexts")

    size = None
    for finer in (*RANGES, None):
        key = ["g1", "g2", "low"]
        counts = materialise(level.groupBy(*key).agg(F.count("*").alias("members")), "digits").where("members > 1")
        if finer is None:  # equal windows of these groups are the repeated windows
            window = F.expr(f"substring(ctx, o_max - low + 1, {DEPTH})").alias("window")
            single = level.join(counts, key, "left_semi").select(*key, window, KEY, "p", "wanted")
            single = materialise(single, "windows")
            equal = single.groupBy(*key, "window").agg(F.count("*").alias("members")).where("members > 1")
            equal = materialise(equal.drop("members"), "equal-windows")
            alike = single.where("wanted").join(equal, [*key, "window"], "left_semi")
            start = (F.col("p") - F.col("low")).alias("start")
            return spans.unionByName(alike.select(KEY, start, (F.col("p") - F.col("low") + DEPTH).alias("stop")))
        fit = level.join(counts.where(F.col("members") <= MEMBERS), key, "left_semi")
        fit = fit.select(*key, KEY, "p", "o_min", "o_max", "wanted", "ctx")
        fit = fit.repartition(*key).sortWithinPartitions(*key, KEY, "p")
        spans = spans.unionByName(materialise(fit.mapInArrow(_refine(size), SPANS), "refined"))
        many = counts.where(F.col("members") > MEMBERS)
        if many.isEmpty():
            return spans
        rest = level.join(many, key, "left_semi").select(*level.columns)
        level = materialise(rest.mapInArrow(_deal(finer, size), CONTEXTS), "contexts")
        size = finer
    return spans


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches in order; those that overlap or touch become one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and out[-1][1] >= start:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        spans = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * batch.num_rows
        for key, text, found in zip(batch.column(0).to_pylist(), batch.column(1), spans):
            data = text.as_py()
            gone = merged([(s["start"], s["stop"]) for s in found or []])
            kept, at = hashlib.sha256(), 0
            for start, stop in gone:
                kept.update(data[at:start])
                at = stop
            kept.update(data[at:])
            rows.append((key, len(data), sum(b - a for a, b in gone), len(gone), kept.hexdigest(), [a for a, _ in gone], [b for _, b in gone]))
        numbers = pa.list_(pa.int64())
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), numbers, numbers]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
            names=["dk", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "stops"],
        )


REMOVED = "dk long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<long>, stops array<long>"


def removals(docs: DataFrame) -> DataFrame:
    """For each document: dk, doc_id, n_bytes, the removed stretches [start, stop) in order, their bytes
    and number, and the digest of what is left."""
    rows = keyed(docs)
    texts = rows.select(KEY, F.coalesce(F.col("row.text").cast("string"), F.lit("")).cast("binary").alias("text"))
    spans = repeated_spans(texts).groupBy(KEY).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    spans = materialise(spans, "spans")
    words = document_filter(spans)
    whole = narrowed(texts, words, False).mapInArrow(_removed, REMOVED)  # needs no shuffle
    cut = narrowed(texts, words, True).join(spans, KEY, "left").mapInArrow(_removed, REMOVED)
    found = whole.unionByName(cut)
    return found.join(rows.select(KEY, F.col("row.doc_id").alias("doc_id")), KEY)


def without_repeats(text: bytes, starts: list[int], stops: list[int]) -> bytes:
    """What is left of a text when stretches are removed."""
    at, kept = 0, []
    for start, stop in zip(starts, stops):
        kept.append(text[at:start])
        at = stop
    return b"".join([*kept, text[at:]])
