"""Token ids in binary files of fixed-width packed blocks.

A file holds the ids of some documents, one after another, ``width`` bits each, where
``width`` is the least that the vocabulary needs.  Ids are packed in blocks of ``IDS_PER_BLOCK``;
every block starts on a byte, so numpy unpacks one without reading the rest:

    magic | block 0 | block 1 | ... | index | trailer
    index:   doc_id int64[n], doc_id is null uint8[n], end of its ids uint64[n], block offset uint64[blocks + 1]
    trailer: width, ids per block, documents, ids, blocks, offset of the index, crc32 of the index, magic

Documents are laid out in ascending order of doc_id by a range shuffle of the texts; each
task tokenizes its range and streams one file to the shared folder.  A file's name is new for
every attempt and only the files that Spark's committed table of parts names count, so
tasks may fail, run again or run twice.

Defined results.  Null is the empty text; with an end id, a document has that id at least.  A null doc_id
comes first.  Rows that repeat a doc_id stay rows of their own, ordered by a hash of the
text, then by the text.  An empty table gives no parts and no rows.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from edupipe.llm.common import small_batches, whole_text, worker_state
from edupipe.llm.pretokens import is_steady, word_end
from edupipe.session import fresh_path, materialise

MAGIC = b"TOKBLK01"
IDS_PER_BLOCK = 4096
CACHED = 400_000        # words that one worker keeps the ids of, and as many from before
WORDS_AT_ONCE = 200     # words that are encoded as one text
PORTION = 500_000       # bytes of texts whose words are looked up together
WORD_END = "</w>"       # fixed value: how the scheme marks the last token of a word
LONGEST = 48            # characters of a word that is kept
READ_IDS = 1 << 20      # ids that a reader unpacks at a time
TRAILER = "<IIQQQQI8s"
TRAILER_BYTES = struct.calcsize(TRAILER)
PARTS = "part int, file string, n_docs long, n_ids long"


def bit_width(vocabulary: int) -> int:
    """The least number of bits that holds every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as a little-endian bit string, filled up with zero bits to a whole byte.

    Eight ids take ``width`` bytes exactly, so the ids of one place among eight are
    shifted and stored together.
    """
    size = -(-len(ids) * width // 8)
    groups = -(-len(ids) // 8)
    padded = np.zeros(groups * 8, np.uint64)
    padded[: len(ids)] = ids
    out = np.zeros((groups, width + 8), np.uint8)
    for place in range(8):
        at, shift = divmod(place * width, 8)
        value = padded[place::8] << np.uint64(shift)
        for byte in range(-(-(width + shift) // 8)):
            out[:, at + byte] |= ((value >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.uint8)
    return out[:, :width].tobytes()[:size]


def unpack(data: bytes, count: int, width: int) -> np.ndarray:
    """The first ``count`` ids of what ``pack`` made."""
    groups = -(-count // 8)
    raw = np.zeros(groups * width, np.uint8)
    raw[: len(data)] = np.frombuffer(data, np.uint8)[: groups * width]
    rows = np.zeros((groups, width + 8), np.uint64)
    rows[:, :width] = raw.reshape(groups, width)
    out = np.empty((groups, 8), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for place in range(8):
        at, shift = divmod(place * width, 8)
        value = np.zeros(groups, np.uint64)
        for byte in range(-(-(width + shift) // 8)):
            value |= rows[:, at + byte] << np.uint64(8 * byte)
        out[:, place] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[:count]


def filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system that a folder of the cluster is on, and the folder's path there."""
    if path.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return pa.fs.FileSystem.from_uri(path)
    return pa.fs.LocalFileSystem(), path


class Writer:
    """Streams documents into one file; holds a few blocks and the index in memory."""

    def __init__(self, stream: Any, width: int) -> None:
        self.stream, self.width = stream, width
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.doc_ids: list[int] = []
        self.nulls: list[bool] = []
        self.ends: list[int] = []
        self.offsets = [len(MAGIC)]
        stream.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.n_ids += len(ids)
        self.doc_ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.ends.append(self.n_ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= 64 * IDS_PER_BLOCK:
            self._write_blocks(self.n_held - self.n_held % IDS_PER_BLOCK)

    def _write_blocks(self, count: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        for at in range(0, count, IDS_PER_BLOCK):
            data = pack(ids[at : min(at + IDS_PER_BLOCK, count)], self.width)
            self.stream.write(data)
            self.offsets.append(self.offsets[-1] + len(data))
        self.held, self.n_held = [ids[count:]], len(ids) - count

    def close(self) -> None:
        self._write_blocks(self.n_held)
        index = b"".join([
            np.array(self.doc_ids, "<i8").tobytes(), np.array(self.nulls, np.uint8).tobytes(),
            np.array(self.ends, "<u8").tobytes(), np.array(self.offsets, "<u8").tobytes(),
        ])
        self.stream.write(index)
        self.stream.write(struct.pack(
            TRAILER, self.width, IDS_PER_BLOCK, len(self.ends), self.n_ids, len(self.offsets) - 1,
            self.offsets[-1], zlib.crc32(index), MAGIC,
        ))


class Reader:
    """Random access to one file: the index is read at once, blocks when asked for."""

    def __init__(self, file: Any) -> None:
        self.file, size = file, file.size()
        trailer = file.read_at(TRAILER_BYTES, size - TRAILER_BYTES)
        self.width, self.per_block, self.n_docs, self.n_ids, self.n_blocks, at, crc, magic = struct.unpack(TRAILER, trailer)
        index = file.read_at(size - TRAILER_BYTES - at, at)
        if magic != MAGIC or zlib.crc32(index) != crc:
            raise ValueError("not a whole token file")
        n = self.n_docs
        self.doc_ids = np.frombuffer(index, "<i8", n)
        self.nulls = np.frombuffer(index, np.uint8, n, 8 * n)
        self.ends = np.frombuffer(index, "<u8", n, 9 * n).astype(np.int64)
        self.offsets = np.frombuffer(index, "<u8", self.n_blocks + 1, 17 * n).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` up to ``stop``, reading only the blocks that hold them."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.per_block, (stop - 1) // self.per_block
        low = int(self.offsets[first])
        data = self.file.read_at(int(self.offsets[last + 1]) - low, low)
        out = []
        for block in range(first, last + 1):
            count = min(self.per_block, self.n_ids - block * self.per_block)
            out.append(unpack(data[self.offsets[block] - low : self.offsets[block + 1] - low], count, self.width))
        base = first * self.per_block
        return np.concatenate(out)[start - base : stop - base]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))


class _Encoder:
    """Ids of texts as little-endian 32-bit bytes; the ids of a word are kept for the next time."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # which ids end a word
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith(WORD_END)
        self.cache: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}  # the cache before this one, until that is full

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words, many of them encoded as one text; the last token of each says so."""
        made: dict[str, bytes] = {}
        groups = [words[at : at + WORDS_AT_ONCE] for at in range(0, len(words), WORDS_AT_ONCE)]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(group) and stops[-1] == len(ids):
                data, edges = ids.tobytes(), [0, *(4 * stops).tolist()]
                made.update((w, data[a:b]) for w, a, b in zip(group, edges, edges[1:]))
            else:  # some piece was split or joined with its neighbour
                alone = self.tokenizer.encode_batch_fast(group, add_special_tokens=False)
                made.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(group, alone))
        return made

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each of some texts, which are looked up together."""
        split: list[list[str] | None] = []
        for text in texts:
            plain = (text.isascii() or is_steady(text)) and not (self.added and self.added.search(text))
            split.append(word_end(unicodedata.normalize("NFC", text).lower()) if plain else None)
        new = set().union(*(words for words in split if words)).difference(self.cache)
        if len(self.cache) + len(new) > CACHED:
            self.cache, self.before = {}, self.cache
            new = set().union(*(words for words in split if words))
        known = {w: self.before[w] for w in new if w in self.before}
        known.update(self._learn([w for w in new if w not in known]))
        self.cache.update(known)
        look = self.cache.__getitem__
        done = [
            np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() if words is None else b"".join(map(look, words))
            for text, words in zip(texts, split)
        ]
        for word in known:
            if len(word) > LONGEST:  # rare, and not worth its room
                del self.cache[word]
        return done


def _encoder(path: str) -> _Encoder:
    state = worker_state("token_files")
    if path not in state:
        state[path] = _Encoder(path)
    return state[path]


def _portions(texts: pa.Array) -> Iterator[range]:
    """Neighbouring rows of about ``PORTION`` bytes together."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        before = sizes[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sizes, before + PORTION, "right")))
        yield range(first, last)
        first = last


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int | None, folder: str | None = None) -> DataFrame:
    """Write the ids of all texts in ascending order of doc_id; the table of parts:
    part, file, n_docs, n_ids and start (ids in all parts before).

    ``tokenizer`` is the path of a file with a lower-casing scheme with word ends.
    """
    spark = docs.sparkSession
    target = folder or fresh_path(spark, "tokens")
    width = bit_width(Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True))
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer, encoder = TaskContext.get().partitionId(), None, _encoder(tokenizer)
        system, path = filesystem(target)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.tok"
        for batch in batches:
            for some in _portions(batch.column(1)):
                if writer is None:
                    system.create_dir(path, recursive=True)
                    stream = system.open_output_stream(f"{path}/{name}")
                    writer = Writer(stream, width)
                doc_ids = batch.column(0).slice(some.start, len(some)).to_pylist()
                for doc_id, ids in zip(doc_ids, encoder.encode(batch.column(1).slice(some.start, len(some)).to_pylist())):
                    writer.add(doc_id, np.frombuffer(ids + end, "<u4"))
        if writer is not None:
            writer.close()
            stream.close()
            made = {"part": [part], "file": [name], "n_docs": [len(writer.ends)], "n_ids": [writer.n_ids]}
            yield pa.RecordBatch.from_pydict(
                made, pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
            )

    texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), whole_text("text").alias("text"))
    texts = texts.withColumn("tie", F.xxhash64("text"))
    ordered = texts.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    parts = materialise(ordered.select("doc_id", "text").mapInArrow(write, PARTS), "token-parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    start = F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start")
    return parts.select("part", F.concat(F.lit(f"{target}/"), "file").alias("file"), "n_docs", "n_ids", start)


def read_token_files(spark: SparkSession, parts: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before) and its ids
    as little-endian unsigned 32-bit integers."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, path = filesystem(file)
                with system.open_input_file(path) as opened:
                    reader, first = Reader(opened), 0
                    begins = np.concatenate([[0], reader.ends[:-1]]).astype(np.int64)
                    while first < reader.n_docs:
                        bound = np.searchsorted(reader.ends, begins[first] + READ_IDS, "right")
                        last = max(first + 1, int(bound))
                        ids = reader.ids(int(begins[first]), int(reader.ends[last - 1]))
                        data, at = ids.astype("<u4").tobytes(), begins[first]
                        rows = range(first, last)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([None if reader.nulls[i] else int(reader.doc_ids[i]) for i in rows], pa.int64()),
                                pa.array([start + int(begins[i]) for i in rows], pa.int64()),
                                pa.array([data[4 * (begins[i] - at) : 4 * (reader.ends[i] - at)] for i in rows], pa.binary()),
                            ],
                            names=["doc_id", "start", "ids"],
                        )
                        first = last

    n_files = max(1, parts.count())
    return parts.select("file", "start").repartition(n_files).mapInArrow(read, "doc_id long, start long, ids binary")
