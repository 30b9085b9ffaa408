"""Token counts by a map-side lookup in two tiers.

A byte-level BPE never merges across pre-tokens, so a text has as many tokens as its
pre-tokens have together.  First tier: a table of the lengths of the corpus's most
frequent pre-tokens, of bounded size, broadcast.  Second tier: every worker process keeps the
lengths of the pre-tokens that it met besides, and encodes only what neither has.
No pre-token is shuffled but the few that tasks propose as frequent.

Frequent pre-tokens are found over the whole corpus: each task counts its pre-tokens with a
bounded number of counters (lossy counting: a full table drops the rarer half)
and proposes its most frequent ones.  They decide what is fast, never what is counted.

Texts are split with the pattern of the byte-level scheme.  Texts with characters beyond
those whose class has been the same in all Unicode versions in use are split by the
tokenizer itself, texts that hold the string of an added token are encoded whole.

Defined results.  Null is empty and has 0 bytes and 0 tokens.  Each row gives one row, also
when rows repeat or doc_id is null.  An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from itertools import compress, repeat
from operator import not_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from edupipe.llm.common import whole_text, worker_state
from edupipe.llm.pretokens import byte_level, is_steady
from edupipe.llm.token_files import _portions

FREQUENT = 65_536   # rows of the broadcast table, which bounds its size
PROPOSED = 2_048    # pre-tokens that one task proposes
COUNTERS = 32_768   # counters that one task keeps
LONGEST = 48        # characters of a pre-token in a table; longer ones are encoded when met
CACHED = 400_000    # pre-tokens that one worker keeps
PIECES_AT_ONCE = 200  # pre-tokens that are encoded as one text
LIMIT = 512
COLUMNS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class _Counter:
    """Lengths of texts in tokens, with the two tiers."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)  # of each id; the scheme writes a byte as a character
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)
        self.cache: dict[str, int] = {}

    def pieces(self, text: str) -> list[str]:
        if text.isascii() or is_steady(text):
            return byte_level(text)
        spans = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return [text[a:b] for _, (a, b) in spans]

    def special(self, text: str) -> bool:
        return self.added is not None and self.added.search(text) is not None

    def encode(self, pieces: list[str]) -> list[int]:
        """The lengths of pieces.  One that begins with a space ends where the next such begins, so many of them are
        encoded as one text, and the bytes of the tokens say where each ends."""
        lengths: dict[str, int] = {}
        spaced = [p for p in pieces if len(p) > 1 and p[0] == " " and not p[1].isspace()]
        groups = [spaced[at : at + PIECES_AT_ONCE] for at in range(0, len(spaced), PIECES_AT_ONCE)]
        texts = ["".join(g) for g in groups]
        for group, text, found in zip(groups, texts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ends = np.cumsum(self.bytes[found.ids])
            stops = np.cumsum([len(p.encode()) for p in group])
            if len(ends) and ends[-1] == stops[-1] and not self.special(text):
                last = np.searchsorted(ends, stops)
                if (ends[last] == stops).all():
                    lengths.update(zip(group, np.diff(last, prepend=-1).tolist()))
        rest = [p for p in pieces if p not in lengths]
        lengths.update((p, len(e)) for p, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)))
        return [lengths[p] for p in pieces]

    def counts(self, texts: list[str], frequent: dict[str, int]) -> list[int]:
        """The lengths of some texts, whose new pieces are encoded together."""
        cache, totals, rests = self.cache, [], []
        for text in texts:
            if self.special(text):
                totals.append(len(self.tokenizer.encode(text, add_special_tokens=False)))
                rests.append([])
                continue
            pieces = self.pieces(text)
            first = list(map(frequent.get, pieces, repeat(0)))  # no piece has 0 tokens
            totals.append(sum(first))
            rests.append(list(compress(pieces, map(not_, first))))
        new = set().union(*rests).difference(cache)
        if new and len(cache) > CACHED:
            cache.clear()
            new = set().union(*rests)
        cache.update(zip(new, self.encode(list(new))))
        totals = [total + sum(map(cache.__getitem__, rest)) for total, rest in zip(totals, rests)]
        for piece in new:
            if len(piece) > LONGEST:  # rare, and not worth its room
                del cache[piece]
        return totals


def _counter(path: str) -> _Counter:
    state = worker_state("token_counts")
    if path not in state:
        state[path] = _Counter(path)
    return state[path]


def frequent_lengths(docs: DataFrame, tokenizer: str) -> dict[str, int]:
    """The lengths of at most FREQUENT pre-tokens, those most frequent in all of ``docs``."""
    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(counter.pieces(text.as_py()))
                if len(seen) > COUNTERS:
                    bar = sorted(seen.values())[-COUNTERS // 2]
                    seen = Counter({p: n for p, n in seen.items() if n > bar})
        top = [(p, n) for p, n in seen.most_common(PROPOSED) if len(p) <= LONGEST]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"]
        )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in batches:
            pieces = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counter.encode(pieces), pa.int64())], names=["piece", "n"])

    proposed = docs.select(whole_text("text")).mapInArrow(propose, "piece string, n long")
    summed = proposed.groupBy("piece").agg(F.sum("n").alias("n"))
    top = summed.orderBy(F.desc("n"), "piece").limit(FREQUENT).select("piece")
    return {r["piece"]: r["n"] for r in top.mapInArrow(measure, "piece string, n long").collect()}


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """For each row: doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens).

    ``tokenizer`` is the path of a byte-level BPE file, readable on every executor.
    """
    scheme = json.loads(Tokenizer.from_file(tokenizer).to_str())
    if scheme["normalizer"] is not None or scheme["pre_tokenizer"]["type"] != "ByteLevel":
        raise ValueError("token_counts needs a byte-level tokenizer without normalizer")
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, tokenizer))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, frequent = _counter(tokenizer), table.value
        for batch in batches:
            texts = batch.column(2)
            lengths = [n for some in _portions(texts) for n in counter.counts(texts.slice(some.start, len(some)).to_pylist(), frequent)]
            tokens = pa.array(lengths, pa.int64())
            over = pa.array([n > limit for n in lengths], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), tokens, over], names=["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    text = whole_text("text")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    ).mapInArrow(count, COLUMNS)
