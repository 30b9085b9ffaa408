"""Time-to-live suppression: at most one fresh result per key and time span.

The first event of a key passes; a later one passes when at least ``ttl`` whole
seconds have gone by since the last that passed.  Click times are given in whole
seconds and so is the time to live, so events are compared by their second.

Events without a time are left out: nothing can be said about their span.  A null
key is a key like any other.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from edupipe import fixed_values as fv

SLOTS = 1024  # groups of keys whose state is read and written together
HELD_ROWS = 65_536  # rows that wait in a task until those of one second are made one
NEVER = -(1 << 62)


def _seconds(ts: str):
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def passing(seconds: np.ndarray, last: int | None, ttl: int) -> list[int]:
    """Positions of ascending seconds that pass, given the last second that did.

    Goes from one that passes straight to the next one, however many lie between.
    """
    out = []
    at = 0 if last is None else int(np.searchsorted(seconds, last + ttl))
    while at < len(seconds):
        out.append(at)
        at = max(at + 1, int(np.searchsorted(seconds, seconds[at] + ttl)))
    return out


def _new_key(columns: list[pa.Array], before: list[pa.Scalar] | None) -> np.ndarray:
    """Which rows have another key than the row above; nulls equal each other."""
    new = np.zeros(len(columns[0]), bool)
    new[0] = before is None
    for i, column in enumerate(columns):
        above = column.slice(0, len(column) - 1)
        if before is not None:
            above = pa.concat_arrays([pa.array([before[i].as_py()], column.type), above])
        here = column if before is not None else column.slice(1)
        differs = pc.if_else(pc.or_(pc.is_null(here), pc.is_null(above)), pc.xor(pc.is_null(here), pc.is_null(above)), pc.not_equal(here, above))
        new[len(new) - len(here):] |= differs.to_numpy(zero_copy_only=False).astype(bool)
    return new


def first_per_ttl(
    events: DataFrame, keys: Sequence[str], ts: str, tie: str, ttl: int = fv.CACHE_TTL_SECONDS
) -> DataFrame:
    """Batch form: (keys…, second, tie) of the events that pass.

    Events of one key and second count once (the least ``tie``); that reduction
    runs before the shuffle, so however many events a key has, at most one row
    per second of the covered time reaches the scan of its key.  The scan goes
    through sorted Arrow batches in steps from one event that passes to the next.
    """
    timed = events.withColumn("second", _seconds(ts)).where("second is not null")
    per_second = timed.groupBy(*keys, "second").agg(F.min(tie).alias(tie))
    ordered = per_second.repartition(*keys).sortWithinPartitions(*keys, "second")
    width = len(keys)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = batch.columns[:width]
            new = _new_key(columns, before)
            seconds = batch.column("second").to_numpy()
            starts = np.flatnonzero(new)
            bounds = np.concatenate([[] if new[0] else [0], starts, [len(seconds)]]).astype(int)
            keep = new.copy()
            # the first event of a key passes; a key whose events span less has no other one
            spans = seconds[bounds[1:] - 1] - seconds[bounds[:-1]]
            for run in np.flatnonzero((spans >= ttl) | ~new[bounds[:-1]]):
                low, high = bounds[run], bounds[run + 1]
                known = None if new[low] else last
                keep[low + np.array(passing(seconds[low:high], known, ttl), int)] = True
            passed = seconds[bounds[-2]:][keep[bounds[-2]:]]
            last = int(passed[-1]) if len(passed) else last
            before = [c[len(seconds) - 1] for c in columns]
            yield batch.filter(pa.array(keep))

    return ordered.mapInArrow(scan, ordered.schema)


def _first_of_second(rows: pa.Table, keys: Sequence[str], tie: str) -> pa.Table:
    """One row for each key and second, with the least ``tie``."""
    least = rows.group_by([*keys, "second"], use_threads=False).aggregate([(tie, "min")])
    return least.rename_columns({f"{tie}_min": tie}).select([*keys, "second", tie])


def _numbered(keys: Sequence[pa.ChunkedArray]) -> np.ndarray:
    """A number for each row's key; nulls equal each other."""
    number = np.zeros(len(keys[0]), np.int64)
    for column in keys:
        found = column.combine_chunks().dictionary_encode(null_encoding="encode")
        number = number * max(1, len(found.dictionary)) + found.indices.to_numpy()
        number = np.unique(number, return_inverse=True)[1]
    return number


def passing_keys(key: np.ndarray, seconds: np.ndarray, last: np.ndarray, ttl: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, last): the rows, sorted by key and second, that pass, and each key's last second that did.

    ``last`` has an entry for each key, which is ``NEVER`` where none passed before.  A step goes from one that passes to the next one,
    for all keys at once.
    """
    low = int(seconds.min())
    span = int(seconds.max()) - low + 2
    places = key * span + (seconds - low)
    now = np.unique(key)
    ends = np.searchsorted(key, now, "right")
    last, passed = last.copy(), []
    while len(now):
        wanted = np.where(last[now] == NEVER, 0, np.clip(last[now] + ttl - low, 0, span - 1))
        at = np.searchsorted(places, now * span + wanted)
        there = at < ends
        now, ends, at = now[there], ends[there], at[there]
        passed.append(at)
        last[now] = seconds[at]
    return np.sort(np.concatenate(passed)), last


class _LastPassed(StatefulProcessor):
    """Keeps the last second that passed, per key, until its time to live is over.

    The keys of a slot are one entry of state, an Arrow table: a call from the worker to the state costs more than a key.
    """

    def __init__(self, keys: Sequence[str], tie: str, ttl: int) -> None:
        self.keys, self.tie, self.ttl = list(keys), tie, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        fields = [T.StructField("until", T.LongType()), T.StructField("held", T.BinaryType())]
        self.state = handle.getValueState("last", T.StructType(fields))

    def _come(self, chunks: Iterator[pd.DataFrame]) -> pa.Table:
        come, more, waiting = None, [], 0
        for chunk in chunks:
            texts = {name: pa.array(chunk[name], pa.string(), from_pandas=True) for name in self.keys}
            more.append(pa.table({**texts, "second": pa.array(chunk["second"], pa.int64()), self.tie: pa.array(chunk[self.tie])}))
            waiting += len(chunk)
            if waiting > max(HELD_ROWS, come.num_rows if come is not None else 0):
                come = _first_of_second(pa.concat_tables([come, *more] if come is not None else more), self.keys, self.tie)
                more, waiting = [], 0
        return _first_of_second(pa.concat_tables([come, *more] if come is not None else more), self.keys, self.tie) if more else come

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        come = self._come(rows)
        until, held = None, pa.table({**{name: pa.array([], pa.string()) for name in self.keys}, "second": pa.array([], pa.int64())})
        if self.state.exists():
            until, data = self.state.get()
            held = pa.ipc.open_stream(pa.py_buffer(bytes(data))).read_all()
        every = pa.concat_tables([held, come.select(held.column_names)])
        numbers = _numbered([every.column(name) for name in self.keys])
        old, new = numbers[: held.num_rows], numbers[held.num_rows :]
        last = np.full(numbers.max() + 1, NEVER, np.int64)
        last[old] = held.column("second").to_numpy()
        order = np.lexsort((come.column("second").to_numpy(), new))
        come = come.take(pa.array(order))
        at, last = passing_keys(new[order], come.column("second").to_numpy(), last, self.ttl)
        if not len(at):
            return
        one = np.unique(numbers, return_index=True)[1]  # a row of each key
        alive = (last != NEVER) & ((last + self.ttl) * 1000 > timerValues.getCurrentWatermarkInMs())
        kept = every.take(pa.array(one[alive])).set_column(len(self.keys), "second", pa.array(last[alive]))
        end = int(last.max()) + self.ttl
        if until is not None and until != end:
            self.handle.deleteTimer(until * 1000)
        if until != end:
            self.handle.registerTimer(end * 1000)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, kept.schema) as writer:
            writer.write_table(kept)
        self.state.update((end, sink.getvalue().to_pybytes()))
        passed = come.take(pa.array(at))
        columns = {name: pd.Series(passed.column(name).to_pylist(), dtype=object) for name in self.keys}
        yield pd.DataFrame({**columns, "second": passed.column("second").to_numpy(), self.tie: passed.column(self.tie).to_pandas()})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()  # what comes now is later than the watermark, so it passes with or without state
        yield from ()

    def close(self) -> None:
        pass


STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_first_per_ttl(
    events: DataFrame, keys: Sequence[str], ts: str, tie: str, ttl: int = fv.CACHE_TTL_SECONDS, late: str = "1 hour", slots: int = SLOTS
) -> DataFrame:
    """Streaming form with keyed state; same rows as the batch form when events arrive
    in order of time.

    Events later than ``late`` behind the newest are dropped.  A key's state goes when the watermark
    is past its time to live, so state does not grow with the keys ever seen.
    The query must run with ``spark.sql.streaming.stateStore.providerClass`` set to
    ``STATE_STORE``.  Of a key's rows in a micro batch only one per second is held.  ``tie`` must not be null.  Keys are
    dealt to ``slots`` by their hash, whose state is read and written together, and a task holds one slot at a time.  More
    keys want more slots; their number stays with the checkpoint.
    """
    moment = F.col(ts).cast("timestamp")
    # As text: pandas would turn whole numbers beside nulls into floats, and join keys beyond 2^53.
    texts = [F.col(k).cast("string").alias(k) for k in keys]
    timed = events.select(*texts, moment.alias("__moment"), _seconds(ts).alias("second"), tie)
    timed = timed.where(F.col("second").isNotNull() & F.col(tie).isNotNull()).withWatermark("__moment", late)
    dealt = timed.withColumn("__slot", F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int"))
    passed = dealt.groupBy("__slot").transformWithStateInPandas(
        statefulProcessor=_LastPassed(keys, tie, ttl),
        outputStructType=timed.drop("__moment").schema,
        outputMode="append",
        timeMode="eventTime",
    )
    types = dict(events.dtypes)
    return passed.select(*[F.col(k).cast(types[k]).alias(k) for k in keys], "second", tie)
