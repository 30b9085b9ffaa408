"""Recommendations and click feedback as running streams.

Each function takes streaming DataFrames and gives one; the caller starts it with a
checkpoint, stops it and starts it again, and it goes on where it was.  State is bounded: by the
watermark where events have times, by a number of rows and a time to live where answers are kept.

Streams with state of their own (``transformWithStateInPandas``) must run with
``spark.sql.streaming.stateStore.providerClass`` set to ``ttl.STATE_STORE``.
"""

from __future__ import annotations

import contextlib
import itertools
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from edupipe import fixed_values as fv
from edupipe.streaming import ttl

SPREAD = 16  # tasks that share the saves of one item in a micro batch
SLOTS = 1024  # groups of keys whose state is read and written together


def mark_clicked(
    recs: DataFrame, clicked: DataFrame, row: Sequence[str], within: str = "7 days", late: str = "1 hour"
) -> DataFrame:
    """Set ``clicked`` on every recommendation that its user clicks within a time, as both streams arrive.

    recs(user_id, item_id, timestamp, clicked, …) and clicked(user_id, item_id, timestamp).  ``row`` names
    the columns that tell recommendations apart.  A recommendation comes out once: with its first
    click, or when the watermark says that no click can come any more.  Both sides leave the
    state then.  One that was marked before stays marked.  Rows without a time, and rows
    later than ``late`` behind the newest, are left out.  A message that only moves the time on must have
    a user and an item: clicks without them are skipped before their time is looked at.
    """
    shown = recs.where("timestamp is not null").withWatermark("timestamp", late)
    seen = clicked.where("timestamp is not null").select(
        F.col("user_id").alias("__user"), F.col("item_id").alias("__item"), F.col("timestamp").alias("__at")
    ).withWatermark("__at", late)
    matches = F.expr(
        f"user_id = __user AND item_id = __item AND __at >= timestamp AND __at <= timestamp + INTERVAL {within}"
    )
    marked = shown.join(seen, matches, "left_outer").withColumn("clicked", F.coalesce("clicked", F.lit(False)) | F.col("__at").isNotNull())
    # a row per click so far; the first one counts
    return marked.select(*recs.columns).dropDuplicatesWithinWatermark(list(row))


def spread_join(rows: DataFrame, table: DataFrame, key: str, spread: int = SPREAD) -> DataFrame:
    """``rows`` with the one row of ``table`` that has their key.

    A micro batch with state is not planned anew while it runs, so nothing would split a hot key:
    its rows are dealt over ``spread`` places, and the table, one row per key, is copied to each.
    A table that Spark broadcasts by its measured size is joined as it is.
    """
    others = [c for c in rows.columns if c != key]
    dealt = rows.withColumn("__place", F.pmod(F.xxhash64(*others), F.lit(spread)).cast("int"))
    copied = table.withColumn("__place", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return dealt.join(copied, [key, "__place"]).drop("__place")


def recommend_fresh(
    saves: DataFrame, neighbours: DataFrame, tie: str, ttl_seconds: int = fv.CACHE_TTL_SECONDS, late: str = "1 hour",
    spread: int = SPREAD,
) -> DataFrame:
    """Recommendations for the saves that no earlier answer still covers: look up, keep to the time to live, answer.

    saves(user_id, item_id, timestamp, tie) is a stream; neighbours(item_id, neighbours: array of (recommended_id,
    score)) a table.  Only a save that has an answer starts a time to live.  The same rows as
    ``plans.clickstream.fresh_recommendations`` over all saves, also over several runs with one checkpoint.
    """
    answered = neighbours.where(F.size("neighbours") > 0)
    wanted = saves.select("user_id", "item_id", "timestamp", tie)
    able = spread_join(wanted, answered.select("item_id"), "item_id", spread)
    passed = ttl.stream_first_per_ttl(able, ["user_id", "item_id"], "timestamp", tie, ttl_seconds, late)
    timed = passed.withColumn("timestamp", F.timestamp_seconds("second"))
    hits = spread_join(timed, answered, "item_id", spread).withColumn("hit", F.explode("neighbours"))
    return hits.select(
        "user_id", F.col("item_id").alias("source_id"), F.col("hit.recommended_id").alias("recommended_id"),
        F.col("hit.score").alias("score"), "timestamp", F.lit(False).alias("clicked"),
    )


_ROW = "at long, score double, recommended_id long"
_RANKED = T.StructType([T.StructField("at", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("recommended_id", T.LongType())])


class _TopRows(StatefulProcessor):
    """Keeps the first ``n`` rows of a key, newest first, then by score and id; forgets them after a time to live.

    Equal rows are one.  ``partial`` gives the rows that have come in, for a next step; otherwise the whole
    answer is given whenever it changes, and its version is the time of the micro batch.  ``within`` names text
    columns that tell apart the keys that share a group and its state, so that a call to the state
    serves all of them; each key has its own rows, and a time to live from its own last change.
    """

    def __init__(self, keys: Sequence[str], n: int, ttl_ms: int, partial: bool, within: Sequence[str] = ()) -> None:
        self.keys, self.n, self.ttl_ms, self.partial, self.within = list(keys), n, ttl_ms, partial, list(within)

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = [*_RANKED.fields, T.StructField("changed", T.LongType()), *(T.StructField(name, T.StringType()) for name in self.within)]
        if self.within:  # the rows of all keys are one entry, a list for each column: the store writes entry by entry
            fields = [T.StructField(f.name, T.ArrayType(f.dataType)) for f in fields]
        self.rows = handle.getListState("rows", T.StructType(fields), ttlDurationMs=self.ttl_ms)

    def _held(self) -> Iterator[tuple]:
        entries = self.rows.get() if self.rows.exists() else ()
        return itertools.chain.from_iterable(zip(*entry, strict=True) if self.within else [entry] for entry in entries)

    def _hold(self, rows: list[tuple]) -> None:
        self.rows.put([tuple(map(list, zip(*rows, strict=True)))] if self.within else rows)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()  # of the micro batch, also when that runs again
        before: dict[tuple, list[tuple]] = {}
        changed: dict[tuple, int] = {}
        for row in self._held():
            if row[3] + self.ttl_ms > now:
                before.setdefault(row[4:], []).append(row[:3])
                changed[row[4:]] = row[3]
        best = dict(before)
        for chunk in rows:  # n rows of a key are held, however many come
            come: dict[tuple, list[tuple]] = {}
            for row in zip(*(chunk[name].tolist() for name in (*_RANKED.names, *self.within)), strict=True):
                come.setdefault(row[3:], []).append(row[:3])
            for name, some in come.items():
                best[name] = sorted({*best.get(name, ()), *some}, key=lambda r: (-r[0], -r[1], r[2]))[: self.n]
        other = [name for name, first in best.items() if first != before.get(name)]
        if not other:
            return
        changed |= dict.fromkeys(other, now)
        self._hold([(*row, changed[name], *name) for name, first in best.items() for row in first])
        given = [(*name, *row, place) for name in other for place, row in enumerate(best[name], 1) if not self.partial or row not in before.get(name, ())]
        out = pd.DataFrame(given, columns=[*self.within, *_RANKED.names, "place"]).assign(**dict(zip(self.keys, key, strict=True)))
        if len(out):
            yield out.drop(columns="place") if self.partial else out.assign(version=now)

    def close(self) -> None:
        pass


@contextlib.contextmanager
def without_empty_batches(spark: SparkSession) -> Iterator[None]:
    """Start a stream that looks at the wall clock and yet ends: it would ask for one more empty micro batch for ever."""
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def top_answers(
    rows: DataFrame, n: int = fv.TOP_ITEMS, ttl_seconds: int = fv.CACHE_TTL_SECONDS, spread: int = SPREAD, slots: int = SLOTS
) -> DataFrame:
    """The newest ``n`` rows of every key, kept by the stream: (cache_key, place, recommended_id, score, at, version).

    rows(cache_key, recommended_id, timestamp, score).  State holds at most ``n`` rows a key, for the time to live
    (of the wall clock) after their last change; no history is gathered.  A hot key is dealt over ``spread`` places, whose best
    rows meet in a second step.  Keys are dealt to ``slots`` by their hash: a call from the worker to its state costs more than
    the few rows of a key, so the keys of a slot are read and written together, and a task holds one slot at a time.  More
    keys want more slots; their number stays with the checkpoint.  Each change of an answer gives the whole answer with a later
    version; ``latest_answers`` reads the last one.  Start it ``without_empty_batches`` where it is to end
    with what is available.
    """
    place = F.pmod(F.xxhash64("recommended_id", "timestamp", "score"), F.lit(spread))
    ranked = rows.select(
        F.pmod(F.xxhash64("cache_key", place), F.lit(slots)).cast("int").alias("slot"), "cache_key",
        F.unix_micros(F.col("timestamp").cast("timestamp")).alias("at"), F.col("score").cast("double").alias("score"),
        F.col("recommended_id").cast("long").alias("recommended_id"),
    ).where("at is not null and score is not null and recommended_id is not null")
    mode = {"outputMode": "append", "timeMode": "processingTime"}
    some = ranked.groupBy("slot").transformWithStateInPandas(
        statefulProcessor=_TopRows(["slot"], n, ttl_seconds * 1000, True, ["cache_key"]),
        outputStructType=f"slot int, cache_key string, {_ROW}", **mode,
    )
    whole = some.withColumn("slot", F.pmod(F.xxhash64("cache_key"), F.lit(slots)).cast("int"))
    return whole.groupBy("slot").transformWithStateInPandas(
        statefulProcessor=_TopRows(["slot"], n, ttl_seconds * 1000, False, ["cache_key"]),
        outputStructType=f"slot int, cache_key string, {_ROW}, place int, version long", **mode,
    ).drop("slot")


def latest_answers(versions: DataFrame) -> DataFrame:
    """The last version of every answer that ``top_answers`` gave."""
    last = versions.groupBy("cache_key").agg(F.max("version").alias("version"))
    return versions.join(last, ["cache_key", "version"]).drop("version")


def once(events: DataFrame, keys: Sequence[str], ts: str, late: str = "1 hour") -> DataFrame:
    """Events that are sent again come out once.

    Keys are remembered until the watermark is ``late`` past their event; what is sent again after that is
    late itself and dropped.  Events without a time are left out.
    """
    return events.where(F.col(ts).isNotNull()).withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def write_batches(df: DataFrame, path: str, checkpoint: str) -> None:
    """Process all that is available; every micro batch is a folder of its own, named by its number.

    A batch that comes again after a failure overwrites its folder, so that nothing is written twice.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    writer.trigger(availableNow=True).start().awaitTermination()


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All that ``write_batches`` wrote."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)
