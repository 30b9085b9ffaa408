"""Benchmark decontamination with a generalised suffix automaton of the test items.

Words are runs of digits, letters a-z after lower-casing A-Z, and characters beyond ASCII.  A
window is ``WINDOW`` consecutive words of an item; an item of fewer words is one window as a whole.
The automaton of all items reads a document word by word and knows the longest
suffix that occurs in an item, so one pass finds every word inside any occurrence of a window.
Stretches of words that no item has are skipped before the automaton sees them.

The automaton is built on the driver from at most ``WORDS_AT_ONCE`` words of items and broadcast.  A
larger benchmark is dealt into as many automata as it needs, by item and words, so that rows with one id
spread as well.  Each is read against all documents; what it finds is written without the texts, and
the findings of a document are put together by its key.  Very long items are cut into overlapping
pieces, which have the same windows.

Defined results.  A null or empty text has no words, no hits and is not contaminated; an item without
words has no window; items with a null id count as one item with the empty id, rows with the same
id as one item.  An empty benchmark hits nothing.  Every row of documents is a document of
its own, whatever its doc_id.  Other columns are carried along untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edupipe.llm.common import KEY, keyed, small_batches
from edupipe.session import materialise

WINDOW = 13
WORDS_AT_ONCE = 400_000   # words of one automaton: about 200 MB in a worker
PIECE_WORDS = 50_000      # an item longer than this is cut
SEGMENT = 1 << 20         # bytes of a text that are split into words at a time
MIN_SHARE = 20            # contaminated: hit words times this reach the words

words_of = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
gap = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")

FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("starts", T.ArrayType(T.LongType())),
    T.StructField("ends", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType())),
]


class Automaton:
    """The suffix automaton of several word sequences, with the windows that its states stand for."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        read = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for name, words in items if words]
        for _, ids in read:
            self._add(ids)
        self.names = sorted({name for name, _ in read})
        number = {name: i for i, name in enumerate(self.names)}
        #: state of a whole window -> items; state of a short item -> (its length, item)
        self.of_window: dict[int, set[int]] = {}
        self.of_short: dict[int, list[tuple[int, int]]] = {}
        for name, ids in read:
            state = 0
            for at, word in enumerate(ids):
                state = self.next[state][word]
                if at + 1 >= window:
                    self.of_window.setdefault(self._ancestor(state), set()).add(number[name])
            if len(ids) < window:
                self.of_short.setdefault(state, []).append((len(ids), number[name]))
        self.least = min([window, *(len(ids) for _, ids in read)])
        # for every state: the state of the window that its longest string ends with, and
        # the short items that it ends with
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        self.window_state = [-1] * len(order)
        self.shorts: list[tuple[tuple[int, int], ...]] = [()] * len(order)
        for state in order[1:]:
            above = self.link[state]
            if self.length[state] >= window:
                self.window_state[state] = state if self.length[above] < window else self.window_state[above]
            self.shorts[state] = (*self.of_short.get(state, ()), *self.shorts[above])

    def _ancestor(self, state: int) -> int:
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, state: int, word: int) -> int:
        """The target of ``word`` that is exactly one word longer than ``state``; cloned if there is none."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        clone = self._state(self.length[state] + 1)
        self.next[clone] = dict(self.next[target])
        self.link[clone], self.link[target] = self.link[target], clone
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def _add(self, ids: list[int]) -> None:
        last = 0
        for word in ids:
            if word in self.next[last]:  # an earlier item has this string
                last = self._split(last, word)
                continue
            made, state = self._state(self.length[last] + 1), last
            while state >= 0 and word not in self.next[state]:
                self.next[state][word] = made
                state = self.link[state]
            self.link[made] = 0 if state < 0 else self._split(state, word)
            last = made

    def ids(self, text: bytes) -> np.ndarray:
        """The words of a text as numbers; -1 for words that no item has."""
        text, parts, at = text.lower(), [], 0
        while at < len(text):
            cut = gap.search(text, at + SEGMENT)
            end = cut.start() if cut else len(text)
            words = words_of.findall(text, at, end)
            parts.append(np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int32, len(words)))
            at = end
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def read(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], set[int]]:
        """The spans of words inside occurrences of windows, and the items these belong to."""
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (ids >= 0).view(np.int8), [0]])))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= self.least
        following, link, length = self.next, self.link, self.length
        for start, end in zip(starts[long].tolist(), ends[long].tolist()):
            state = matched = 0
            for at, word in enumerate(ids[start:end].tolist(), start):
                while state and word not in following[state]:
                    state = link[state]
                    matched = length[state]
                if word not in following[state]:
                    matched = 0
                    continue
                state = following[state][word]
                matched += 1
                longest = 0
                if matched >= self.window:
                    longest = self.window
                    found |= self.of_window[self.window_state[state]]
                for size, item in self.shorts[state]:
                    if size <= matched:
                        found.add(item)
                        longest = max(longest, size)
                if longest:
                    begin = at + 1 - longest
                    while spans and spans[-1][1] >= begin:  # spans that touch become one
                        begin = min(begin, spans.pop()[0])
                    spans.append((begin, at + 1))
        return spans, found


def _pieces(window: int):
    """Items as words, very long ones in pieces that overlap by all but one word of a window."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of.findall(text.lower())
                step = max(PIECE_WORDS, window)
                for at in range(0, max(1, len(words) - window + 1), step):
                    piece = words[at : at + step + window - 1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name], pa.string()), pa.array([len(piece)], pa.int64()), pa.array([b" ".join(piece)], pa.binary())],
                        names=["item", "n", "words"],
                    )

    return cut


def _automata(benchmark: DataFrame, item: str, window: int) -> Iterator[Automaton]:
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    named = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), text.alias("text"))
    pieces = named.mapInArrow(_pieces(window), "item string, n long, words binary").where("n > 0").distinct()
    total = pieces.agg(F.sum("n")).first()[0] or 0
    shares = max(1, -(-2 * total // WORDS_AT_ONCE)) if total > WORDS_AT_ONCE else 1
    pieces = materialise(pieces.withColumn("share", F.pmod(F.xxhash64("item", "words"), F.lit(shares))), "benchmark") if shares > 1 else pieces.withColumn("share", F.lit(0))
    for i in range(shares):
        rows = pieces.where(F.col("share") == i).orderBy("item", "words").collect()  # about WORDS_AT_ONCE / 2 words
        yield Automaton([(r["item"], bytes(r["words"]).split(b" ")) for r in rows], window)


def read_windows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, item: str = "item_id") -> DataFrame:
    """Each row of ``docs`` as (row, n_words, starts, ends, items): the spans of hit words
    [start, end) in order, and the ids of the items with windows there, sorted."""
    context = docs.sparkSession.sparkContext
    automata = _automata(benchmark, item, window)
    first = context.broadcast(vars(next(automata)))  # plain data: executors need not know the class
    following = next(automata, None)
    kind = T.StructType([T.StructField("row", docs.schema), *FOUND])
    if following is None:
        return small_batches(docs).select(F.struct("*").alias("row")).mapInArrow(_reader(first), kind)
    keyed_kind = T.StructType([T.StructField(KEY, T.LongType()), *FOUND])
    rows = keyed(docs)
    texts = rows.select(KEY, F.struct(F.col("row.text").alias("text")).alias("row"))
    found = materialise(texts.mapInArrow(_reader(first), keyed_kind), "windows")
    while following is not None:  # one automaton in a worker at a time
        more = texts.mapInArrow(_reader(context.broadcast(vars(following))), keyed_kind).where(F.size("starts") > 0)
        found = found.unionByName(materialise(more, "windows"))
        following = next(automata, None)
    together = found.groupBy(KEY).agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    spans = F.aggregate(F.array_sort("spans"), F.array().cast("array<struct<starts:bigint,ends:bigint>>"), _with_span)
    together = together.withColumn("spans", spans).select(KEY, "n_words", F.col("spans.starts").alias("starts"), F.col("spans.ends").alias("ends"), "items")
    return rows.join(together, KEY).select("row", *(f.name for f in FOUND))


def _with_span(done: Column, span: Column) -> Column:
    """Spans in order with one more: those that touch become one."""
    last = F.try_element_at(done, F.lit(-1))
    joined = F.struct(last["starts"].alias("starts"), F.greatest(last["ends"], span["ends"]).alias("ends"))
    touches = F.coalesce(last["ends"] >= span["starts"], F.lit(False))
    return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(span)))


def _reader(shared: Broadcast[dict]):
    """What an automaton finds: each row with the columns ``FOUND`` after its own, without the text when it has a key."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton.__new__(Automaton)
        automaton.__dict__.update(shared.value)
        numbers, strings = pa.list_(pa.int64()), pa.list_(pa.string())
        for batch in batches:
            row = batch.column("row")
            n_words, starts, ends, items = [], [], [], []
            for text in row.field(row.type.get_field_index("text")):
                ids = automaton.ids((text.as_py() or "").encode())
                spans, found = automaton.read(ids)
                n_words.append(len(ids))
                starts.append([a for a, _ in spans])
                ends.append([b for _, b in spans])
                items.append(sorted(automaton.names[i] for i in found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(starts, numbers), pa.array(ends, numbers), pa.array(items, strings)],
                names=[batch.schema.names[0], "n_words", "starts", "ends", "items"],
            )

    return read


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``read_windows`` with n_hit, the words in spans, and contaminated: some words are hit
    and ``MIN_SHARE`` times as many reach all words of the document."""
    read = read_windows(docs, benchmark, window)
    n_hit = F.aggregate(F.arrays_zip("starts", "ends"), F.lit(0).cast("long"), lambda n, s: n + s.ends - s.starts)
    read = read.withColumn("n_hit", n_hit)
    return read.withColumn("contaminated", (F.col("n_hit") > 0) & (MIN_SHARE * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, longest: int | None = None, window: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated documents; with ``longest``, spans of more words than that
    are cut out of the documents that stay.  A text without such spans is left as it is."""
    read = contamination(docs, benchmark, window).where("not contaminated")
    if longest is None:
        return read.select("row.*")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row")
            at = row.type.get_field_index("text")
            texts = []
            for text, starts, ends in zip(row.field(at).to_pylist(), batch.column("starts").to_pylist(), batch.column("ends").to_pylist()):
                spans = [(a, b) for a, b in zip(starts, ends) if b - a > longest]
                texts.append(without_spans(text.encode(), spans).decode() if spans else text)
            fields = [row.field(i) for i in range(row.type.num_fields)]
            fields[at] = pa.array(texts, row.type.field(at).type)
            yield pa.RecordBatch.from_arrays(fields, names=[f.name for f in row.type])

    return read.select("row", "starts", "ends").mapInArrow(cut, docs.schema)


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    kept, at = [], 0
    spots = [m.span() for m in words_of.finditer(text.lower())]
    for a, b in spans:
        kept.append(text[at : spots[a][0]])
        at = spots[b - 1][1]
    return b"".join([*kept, text[at:]])
