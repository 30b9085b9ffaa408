"""Alignment of two tokenizations of the same text by coalescing intervals.

A is a byte-level BPE over space + text, B a sentencepiece model over text (it adds the space
itself).  Every token is an interval of bytes.  The tokens of both sides are sorted by start
(lexsort), the running maximum of their ends is taken (maximum.accumulate), and a group breaks where a
start reaches it.  Inside a group the overlaps are expanded into pairs of an A and a B token; a
pair whose two ranges end together is a link.

How often an id pair is linked in the whole corpus is counted in each task first and summed after one
shuffle.  The ``FREQUENT`` most frequent pairs are broadcast, which bounds the broadcast; the links of
the others, none of which is a hot key then, meet their counts in a join.  Texts are read and
encoded once: a document keeps its linked pairs as byte planes of their differences.

Defined results.  A text that is null, empty, or that one of the tokenizers does not give back byte
for byte has no tokens: all counts are 0, ``groups_sha256`` is the empty string.  Each row gives one row,
also when rows repeat or doc_id is null (see ``common.keyed``).  An empty table gives an
empty result.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from edupipe.llm.common import KEY, keyed, whole_text, worker_state
from edupipe.llm.pretokens import BYTE_LEVEL_PATTERN, is_steady
from edupipe.session import materialise

CHUNK_TOKENS = 200_000    # tokens that are aligned in one pass
HELD_PAIRS = 1_000_000    # different pairs that a task counts before it hands them on
FREQUENT = 524_288        # pairs in the broadcast table
SPACE = "▁"          # how B writes a space
long_run = re.compile(r"\S{2000}|\s{2000}").search

A_IDS, B_IDS = "a_ids array<int>", "b_ids array<int>"
GROUPS = f"dk long, {A_IDS}, {B_IDS}, a_cuts array<int>, b_cuts array<int>, byte_cuts array<long>"


def _byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable ones as they are, the rest from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class _SideA:
    """A byte-level BPE; no string of a text is special.

    Where ids are in the order of the merges, they are ranks, and a rank-based encoder gives the same tokens
    faster.  Text with characters whose class has changed between Unicode versions, or with runs that are long
    without or of white space, goes through the tokenizer itself.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = _byte_letters()
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.pieces = [bytes(letters[c] for c in t) if set(t) <= letters.keys() else None for t in tokens]
        self.lengths = np.array([len(p or b"") for p in self.pieces], np.int64)
        self.by_rank = self._by_rank(json.loads(self.tokenizer.to_str()))

    def _by_rank(self, scheme: dict[str, Any]) -> tiktoken.Encoding | None:
        split, merges = scheme["pre_tokenizer"] or {}, scheme["model"].get("merges") or []
        vocabulary = scheme["model"]["vocab"]
        first = len(vocabulary) - len(merges) - sum(t["content"] in vocabulary for t in scheme["added_tokens"])
        joined = ("".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges)
        plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        if not plain or scheme["normalizer"] is not None or first != 256 or any(vocabulary.get(t) != 256 + i for i, t in enumerate(joined)):
            return None
        ranks = {self.pieces[i]: i for i in range(256 + len(merges))}
        return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        """The ids of space + text."""
        text = " " + text
        if self.by_rank is not None and (text.isascii() or is_steady(text)) and not long_run(text):
            return np.array(self.by_rank.encode_ordinary(text), np.uint32)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


class _SideB:
    """A sentencepiece model that puts a space before the text."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: list[bytes | None] = []
        for i in range(self.model.get_piece_size()):
            name = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.pieces.append(bytes([int(name[3:5], 16)]))
            elif self.model.is_control(i) or self.model.is_unknown(i):
                self.pieces.append(None)
            else:
                self.pieces.append(name.replace(SPACE, " ").encode())
        self.lengths = np.array([len(p or b"") for p in self.pieces], np.int64)

    def ids(self, text: str) -> np.ndarray:
        """The ids of text, to which the model adds a space."""
        return np.array(self.model.encode(text, num_threads=1), np.uint32)


def _gives_back(pieces: list[bytes | None], ids: np.ndarray, whole: bytes) -> bool:
    parts = list(map(pieces.__getitem__, ids.tolist()))
    return None not in parts and b"".join(parts) == whole


class _Pair:
    """Both sides, and what depends on the two vocabularies."""

    def __init__(self, a: str, b: str) -> None:
        self.a, self.b = _SideA(a), _SideB(b)
        self.bits = np.uint64(max(1, (len(self.b.pieces) - 1).bit_length()))
        self._marks: list[str] = []

    def codes(self, a_ids: np.ndarray, b_ids: np.ndarray) -> np.ndarray:
        return (a_ids.astype(np.uint64) << self.bits) | b_ids.astype(np.uint64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        none = np.zeros(0, np.uint32)
        if not text:
            return none, none
        a, b, whole = self.a.ids(text), self.b.ids(text), (" " + text).encode()
        # ranks cover every byte, so lengths tell on that side
        same = int(self.a.lengths[a].sum()) == len(whole) if self.a.by_rank else _gives_back(self.a.pieces, a, whole)
        same = same and _gives_back(self.b.pieces, b, whole)
        return (a, b) if same else (none, none)

    def marks(self) -> tuple[list[str], int]:
        """Every id as text followed by a comma, by a bar and by a semicolon; the number of ids."""
        n = max(len(self.a.pieces), len(self.b.pieces))
        if not self._marks:
            self._marks = [f"{i}{mark}" for mark in ",|;" for i in range(n)]
        return self._marks, n


def _pair(a: str, b: str) -> _Pair:
    state = worker_state("cross_tokenizer")
    if (a, b) not in state:
        state[a, b] = _Pair(a, b)
    return state[a, b]


def coalesce(a_ends: np.ndarray, b_ends: np.ndarray, a_starts: np.ndarray, b_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the group of each A and each B interval: groups are the maximal runs that overlap."""
    starts = np.concatenate([a_starts, b_starts])
    ends = np.concatenate([a_ends, b_ends])
    side = np.zeros(len(starts), np.int8)
    side[len(a_starts):] = 1
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.zeros(len(order), np.int64)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks)
    return group[: len(a_starts)], group[len(a_starts):]


def overlaps(a_starts: np.ndarray, a_ends: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (A, B) of all intervals that overlap; each side is in order and without overlaps of its own."""
    first = np.searchsorted(b_ends, a_starts, "right")
    counts = np.searchsorted(b_starts, a_ends, "left") - first
    i = np.repeat(np.arange(len(a_starts)), counts)
    before = np.cumsum(counts) - counts
    j = np.arange(len(i)) - np.repeat(before - first, counts)
    return i, j


class Aligned:
    """The alignment of several documents, whose bytes lie one after the other."""

    def __init__(self, pair: _Pair, texts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.a = np.concatenate([a for a, _ in texts])
        self.b = np.concatenate([b for _, b in texts])
        self.a_at = np.cumsum([0, *(len(a) for a, _ in texts)])  # where the tokens of each document begin
        self.b_at = np.cumsum([0, *(len(b) for _, b in texts)])
        a_long, b_long = pair.a.lengths[self.a], pair.b.lengths[self.b]
        self.a_ends, self.b_ends = np.cumsum(a_long), np.cumsum(b_long)
        a_starts, b_starts = self.a_ends - a_long, self.b_ends - b_long
        self.a_group, self.b_group = coalesce(self.a_ends, self.b_ends, a_starts, b_starts)
        self.n_groups = int(self.a_group[-1]) + 1 if len(self.a) else 0
        self.a_of, self.b_of = (np.bincount(g, minlength=self.n_groups) for g in (self.a_group, self.b_group))
        i, j = overlaps(a_starts, self.a_ends, b_starts, self.b_ends)
        linked = self.a_ends[i] == self.b_ends[j]
        self.i, self.j = i[linked], j[linked]

    def written(self, pair: _Pair) -> list[str]:
        """Each document's groups as ``a1,a2|b1;a3|b2,b3``."""
        marks, n = pair.marks()
        a_last, b_last = (np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in (self.a_group, self.b_group))
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        a_before, b_before = np.cumsum(self.a_of), np.cumsum(self.b_of) - self.b_of
        if self.n_groups:
            codes[np.arange(len(self.a)) + b_before[self.a_group]] = self.a + n * a_last
            codes[np.arange(len(self.b)) + a_before[self.b_group]] = self.b + 2 * n * b_last
        at = self.a_at + self.b_at
        words = list(map(marks.__getitem__, codes.tolist()))
        return ["".join(words[x:y])[:-1] for x, y in zip(at.tolist(), at[1:].tolist())]

    def bounds(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the documents begin and end among rows that are ordered like ``values``."""
        return np.searchsorted(values, at)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as planes: first all lowest bytes, and so on; the planes without a set bit are left out."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + planes[:width].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    full = np.zeros((planes.shape[1], 8), np.uint8)
    full[:, :width] = planes.T
    return full.reshape(-1).view("<u8")


class _Counts:
    """How often each pair was linked in a task."""

    def __init__(self) -> None:
        self.codes, self.times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, codes: np.ndarray) -> None:
        self.held.append(codes)
        self.n_held += len(codes)

    def fold(self) -> None:
        codes, times = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.held]), return_counts=True)
        self.held, self.n_held = [], 0
        both, back = np.unique(np.concatenate([self.codes, codes]), return_inverse=True)
        total = np.zeros(len(both), np.int64)
        np.add.at(total, back, np.concatenate([self.times, times]))
        self.codes, self.times = both, total

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self.fold()
        found = self.codes, self.times
        self.codes, self.times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return found


DOCUMENT = (
    ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
)
DESCRIBED = "dk long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, times binary, pair long, n long"


def _chunks(pair: _Pair, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], Aligned]]:
    """Documents (dk, text) in chunks of bounded size, aligned."""
    keys: list[int] = []
    texts: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            keys.append(key)
            texts.append(pair.encode(text.as_py()))
            size += len(texts[-1][0]) + len(texts[-1][1])
            if size >= CHUNK_TOKENS:
                yield keys, Aligned(pair, texts)
                keys, texts, size = [], [], 0
    if keys:
        yield keys, Aligned(pair, texts)


def _described(a: str, b: str):
    """A row for every document, and rows (pair, n) of what the task has counted."""
    schema = pa.schema([("dk", pa.int64()), *DOCUMENT, ("codes", pa.binary()), ("times", pa.binary()), ("pair", pa.int64()), ("n", pa.int64())])

    def counted(counts: _Counts) -> pa.RecordBatch:
        codes, times = counts.take()
        none = [pa.nulls(len(codes), f.type) for f in list(schema)[:-2]]
        return pa.RecordBatch.from_arrays([*none, pa.array(codes.view(np.int64)), pa.array(times)], schema=schema)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, counts = _pair(a, b), _Counts()
        for keys, found in _chunks(pair, batches):
            codes = pair.codes(found.a[found.i], found.b[found.j])
            counts.add(codes)
            links = found.bounds(found.i, found.a_at).tolist()
            groups = np.append(found.a_group, found.n_groups)[found.a_at]
            n_groups = np.diff(groups)
            rows = []
            for k, text in enumerate(found.written(pair)):
                own, times = np.unique(codes[links[k] : links[k + 1]], return_counts=True)
                rows.append((
                    keys[k], int(found.a_at[k + 1] - found.a_at[k]), int(found.b_at[k + 1] - found.b_at[k]), int(n_groups[k]),
                    links[k + 1] - links[k], hashlib.sha256(text.encode()).hexdigest() if text else "",
                    packed(np.diff(own, prepend=np.uint64(0))), packed(times), None, None,
                ))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            if counts.n_held >= HELD_PAIRS:
                counts.fold()
                if len(counts.codes) >= HELD_PAIRS:
                    yield counted(counts)
        yield counted(counts)

    return describe


def _scored(table):
    """Sums over the frequent pairs of each document, and a row for each of its other pairs."""
    schema = pa.schema([
        ("dk", pa.int64()), *DOCUMENT, ("n_best", pa.int64()), ("count_sum", pa.int64()), ("pair", pa.int64()), ("times", pa.int64()),
    ])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = table.value
        for batch in batches:
            sums, rest = [], []
            for key, codes, times in zip(batch.column("dk").to_pylist(), batch.column("codes"), batch.column("times")):
                own, times = np.cumsum(unpacked(codes.as_py())), unpacked(times.as_py()).astype(np.int64)
                at = np.minimum(np.searchsorted(known, own), max(0, len(known) - 1))
                is_known = known[at] == own if len(known) else np.zeros(len(own), bool)
                hit, n = at[is_known], times[is_known]
                sums.append((int(n[best[hit]].sum()), int((n * counts[hit]).sum())))
                rest.append((key, own[~is_known], times[~is_known]))
            n_rest = [len(own) for _, own, _ in rest]
            columns = [batch.column(c) for c in ("dk", *(name for name, _ in DOCUMENT))]
            none = pa.nulls(len(sums), pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(c, pa.int64()) for c in zip(*sums)), none, none], schema=schema)
            if sum(n_rest):
                keys = np.repeat(np.array([key for key, _, _ in rest], np.int64), n_rest)
                none = [pa.nulls(len(keys), f.type) for f in list(schema)[1:-2]]
                others = [np.concatenate([own for _, own, _ in rest]).view(np.int64), np.concatenate([n for _, _, n in rest])]
                yield pa.RecordBatch.from_arrays([pa.array(keys), *none, *map(pa.array, others)], schema=schema)

    return score


def _texts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = keyed(docs)
    return rows.select(KEY, F.col("row.doc_id").alias("doc_id")), rows.select(KEY, whole_text().alias("text"))


def aligned_groups(docs: DataFrame, a: str, b: str) -> DataFrame:
    """For each document: doc_id, a_ids, b_ids, and where each group ends: a_cuts and b_cuts (tokens before
    it and in it), byte_cuts (bytes of space + text)."""
    schema = pa.schema([
        ("dk", pa.int64()), ("a_ids", pa.list_(pa.int32())), ("b_ids", pa.list_(pa.int32())), ("a_cuts", pa.list_(pa.int32())),
        ("b_cuts", pa.list_(pa.int32())), ("byte_cuts", pa.list_(pa.int64())),
    ])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a, b)
        for keys, found in _chunks(pair, batches):
            groups = np.append(found.a_group, found.n_groups)[found.a_at]
            a_cuts, b_cuts = np.cumsum(found.a_of), np.cumsum(found.b_of)
            rows: list[tuple[Any, ...]] = []
            for k, key in enumerate(keys):
                x, y = found.a_at[k : k + 2]
                u, v = found.b_at[k : k + 2]
                own = slice(groups[k], groups[k + 1])
                ends = found.a_ends[a_cuts[own] - 1] - (found.a_ends[x - 1] if x else 0)
                rows.append((key, found.a[x:y].tolist(), found.b[u:v].tolist(), (a_cuts[own] - x).tolist(), (b_cuts[own] - u).tolist(), ends.tolist()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    ids, texts = _texts(docs)
    return ids.join(texts.mapInArrow(align, GROUPS), KEY).drop(KEY)


def _pair_counts(described: DataFrame) -> DataFrame:
    """(pair, n, best): how often each pair is linked, and whether no pair of its B id is linked more often."""
    counts = materialise(described.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    return counts


def _with_best(counts: DataFrame, bits: int) -> DataFrame:
    of_b = F.col("pair").bitwiseAND(F.lit((1 << bits) - 1)).alias("b_id")
    most = counts.groupBy(of_b).agg(F.max("n").alias("most"))
    return counts.withColumn("b_id", of_b).join(most, "b_id").select("pair", "b_id", "n", (F.col("n") == F.col("most")).alias("best"))


def id_pairs(docs: DataFrame, a: str, b: str) -> DataFrame:
    """(a_id, b_id, n, best) of every pair of ids that is linked anywhere."""
    bits = int(_Pair(a, b).bits)
    _, texts = _texts(docs)
    described = materialise(texts.mapInArrow(_described(a, b), DESCRIBED), "aligned")
    found = _with_best(_pair_counts(described), bits)
    return found.select(F.shiftright("pair", bits).alias("a_id"), "b_id", "n", "best")


def alignment(docs: DataFrame, a: str, b: str) -> DataFrame:
    """For each document: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is the most frequent
    of its B id, ties included), count_sum (counts of the pairs, over links), groups_sha256.

    ``a`` is the path of a byte-level BPE file, ``b`` that of a sentencepiece model, readable on every executor.
    """
    context = docs.sparkSession.sparkContext
    bits = int(_Pair(a, b).bits)
    ids, texts = _texts(docs)
    described = materialise(texts.mapInArrow(_described(a, b), DESCRIBED), "aligned")
    pairs = materialise(_with_best(_pair_counts(described), bits).drop("b_id"), "best")
    top = pairs.orderBy(F.desc("n"), "pair").limit(FREQUENT).toArrow()  # at most FREQUENT rows
    known = top.column("pair").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(known)
    table = context.broadcast((known[order], top.column("n").to_numpy()[order], top.column("best").to_numpy()[order]))

    shape = "dk long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, pair long, times long"
    documents = described.where("dk is not null").drop("pair", "n")
    scored = materialise(documents.mapInArrow(_scored(table), shape), "scored")
    rest = scored.where("pair is not null").select(KEY, "pair", "times").join(pairs, "pair")
    rest = rest.groupBy(KEY).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rest_best"),
        F.sum(F.col("times") * F.col("n")).alias("rest_sum"),
    )
    found = scored.where("pair is null").drop("pair", "times").join(rest, KEY, "left").join(ids, KEY)
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("rest_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rest_sum", F.lit(0))).alias("count_sum"), "groups_sha256",
    )
