"""Streams that are stopped and started again, against batch answers and plain walks; what their state holds."""

import datetime

import pytest
from pyspark.sql import functions as F

from edupipe.plans import clickstream
from edupipe.session import fresh_path
from edupipe.streaming import clicks, feedback, ttl
from helpers import tuples

EVENT = "kind string, user_id string, item_id string, id long, timestamp timestamp"
START = datetime.datetime(2024, 1, 1)


def at(hours):
    return START + datetime.timedelta(hours=hours)


@pytest.fixture
def feed(spark):
    """A folder that grows, a stream that reads it, and runs of it with one checkpoint."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ttl.STATE_STORE)
    out = fresh_path(spark, "feed")

    class Feed:
        progress: list = []

        def send(self, rows, schema=EVENT):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{out}/in")

        def run(self, build, schema=EVENT):
            df = build(spark.readStream.schema(schema).parquet(f"{out}/in"))
            writer = df.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint").outputMode("append")
            query = writer.trigger(availableNow=True).start(f"{out}/rows")
            query.awaitTermination()
            self.progress = query.recentProgress
            return spark.read.schema(df.schema).parquet(f"{out}/rows")

        def state_rows(self, operator=0):
            return self.progress[-1].stateOperators[operator].numRowsTotal

    yield Feed()
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def _marks(stream):
    recs = stream.where("kind in ('rec', 'end')").select("user_id", "item_id", "id", "timestamp", F.lit(False).alias("clicked"))
    return feedback.mark_clicked(recs, stream.where("kind in ('click', 'end')"), ["id"], "2 hours", "10 minutes")


def test_clicks_meet_recommendations_and_state_falls(feed):
    feed.send([("rec", "u", "i", 1, at(0)), ("rec", "u", "j", 2, at(0)), ("rec", "v", "i", 3, at(1)), ("click", "u", "i", 0, at(1)), ("rec", None, "i", 4, at(0))])
    feed.run(_marks)
    held = sum(feed.progress[-1].stateOperators[i].numRowsTotal for i in range(2))
    # the second click of a recommendation, one that is too late for it, one before it
    feed.send([("click", "u", "i", 0, at(1.5)), ("click", "v", "i", 0, at(4)), ("click", "u", "j", 0, at(1.9)), ("rec", "u", "i", 5, at(1.8)), ("rec", "w", "i", 6, None)])
    feed.run(_marks)
    feed.send([("end", "", "", None, at(100))])
    rows = feed.run(_marks).where("id is not null")
    assert tuples(rows, "id", "clicked") == [(1, True), (2, True), (3, False), (4, False), (5, False)]
    # only the row of the end itself is left
    assert held > 5 and sum(s.numRowsTotal for s in feed.progress[-1].stateOperators) < held


def test_a_mark_that_was_set_stays(feed):
    def build(stream):
        recs = stream.select("user_id", "item_id", "id", "timestamp", (F.col("kind") == "rec").alias("clicked"))
        return feedback.mark_clicked(recs, stream.where("kind = 'end'"), ["id"])

    feed.send([("rec", "u", "i", 1, at(0)), ("end", "v", "i", 2, at(400))])
    assert tuples(feed.run(build), "id", "clicked") == [(1, True), (2, True)]


NEIGHBOURS = "item_id string, neighbours array<struct<recommended_id: string, score: double>>"


@pytest.mark.parametrize("restart", [False, True])
def test_fresh_answers_over_a_restart(spark, feed, restart):
    lists = spark.createDataFrame([("i", [("a", 0.9), ("b", 0.8)]), ("j", [("a", 0.7)]), ("none", [])], NEIGHBOURS)
    rows = [("save", u, i, n, at(n / 2)) for n, (u, i) in enumerate([
        ("u", "none"), ("u", "i"), ("u", "i"), ("v", "i"), ("u", "j"), ("u", "i"), ("u", "i"), ("u", "unknown"), ("u", "i"), ("v", "i"), ("u", None)])]
    build = lambda stream: feedback.recommend_fresh(stream, lists, "id", 2 * 3600, "10 minutes", 4)
    if restart:
        feed.send(rows[:5])
        feed.run(build)
    feed.send(rows[5:] if restart else rows)
    found = feed.run(build)
    whole = spark.createDataFrame(rows, EVENT).select("user_id", "item_id", "timestamp", "id")
    expected = clickstream.fresh_recommendations(whole, lists, "id", 2 * 3600)
    columns = ["user_id", "source_id", "recommended_id", "score", "timestamp"]
    assert tuples(found, *columns) == tuples(expected, *columns) and found.count() > 4


def test_a_hot_item_is_dealt_out(spark):
    """Half of all saves are of one item: no task of the join gets them all."""
    saves = spark.range(20_000).select(F.col("id").cast("string").alias("user_id"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("item_id"))
    table = spark.range(20_000).select(F.col("id").cast("string").alias("item_id"), F.lit("x").alias("answer")).union(spark.sql("SELECT 'hot', 'y'"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(before, ("-1", "false")):  # as in a micro batch with state, with a table too large to broadcast
            spark.conf.set(k, v)
        joined = feedback.spread_join(saves, table, "item_id")
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert joined.count() == 20_000 and joined.where("answer = 'y'").count() == 10_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 6_000


ANSWER = "cache_key string, recommended_id long, timestamp timestamp, score double"


def test_answers_hold_five_rows_a_key(spark, feed):
    build = lambda stream: feedback.top_answers(stream, n=3, spread=2)
    rows = [("k", n, at(n % 7), float(n % 3)) for n in range(40)] + [("m", 1, at(0), 0.5), ("m", 1, at(0), 0.5), ("m", None, at(0), 0.5)]
    for low, high in ((0, 10), (10, 30), (30, 43)):
        feed.send(rows[low:high], ANSWER)
        with feedback.without_empty_batches(spark):
            versions = feed.run(build, ANSWER)
    best = sorted(((t, s, i) for k, i, t, s in rows if k == "k"), key=lambda r: (-r[0].timestamp(), -r[1], r[2]))[:3]
    expected = [("k", p, i, s) for p, (_, s, i) in enumerate(best, 1)] + [("m", 1, 1, 0.5)]
    assert tuples(feedback.latest_answers(versions), "cache_key", "place", "recommended_id", "score") == expected
    assert len(feed.progress[-1].stateOperators) == 2


def test_answers_in_state_are_at_most_n(spark):
    """The state's own list after many rows of one key."""
    held = {}

    class Handle:
        def getListState(self, name, schema, ttlDurationMs=None):
            assert ttlDurationMs == 7000

            class Rows:
                exists = staticmethod(lambda: "k" in held)
                get = staticmethod(lambda: iter(held["k"]))
                put = staticmethod(lambda rows: held.update(k=list(rows)))

            return Rows()

    class Now:
        getCurrentProcessingTimeInMs = staticmethod(lambda: 12)

    import pandas as pd

    top = feedback._TopRows(["cache_key"], 5, 7000, False)
    top.init(Handle())
    for n in range(50):
        chunk = pd.DataFrame({"at": [n * 3 % 50, n], "score": [0.5, 0.1], "recommended_id": [n, n + 100]})
        list(top.handleInputRows(("k",), iter([chunk]), Now()))
        assert len(held["k"]) <= 5
    assert [r[0] for r in held["k"]] == [49, 49, 48, 48, 47]


@pytest.mark.parametrize("spread", [1, 4])
def test_keys_of_a_slot_share_their_state(spark, feed, spread):
    """The state has an entry for each slot, not for each row of each key."""
    build = lambda stream: feedback.top_answers(stream, n=2, spread=spread, slots=4)
    rows = [(None if k == 7 else f"k{k}", 1000 * n + k, at((k * 7 + n * 5) % 11), float((k + n) % 3)) for k in range(150) for n in range(4)]
    for part in (rows[::2], rows[1::2], [(None, 1, at(99), 0.5)]):
        feed.send(part, ANSWER)
        with feedback.without_empty_batches(spark):
            versions = feed.run(build, ANSWER)
        held = [s.numRowsTotal for s in feed.progress[-1].stateOperators]
    assert all(0 < n <= 8 for n in held)
    rows.append((None, 1, at(99), 0.5))
    expected = []
    for key in {r[0] for r in rows}:
        best = sorted(((t, s, i) for k, i, t, s in rows if k == key), key=lambda r: (-r[0].timestamp(), -r[1], r[2]))[:2]
        expected += [(key, p, i, s) for p, (_, s, i) in enumerate(best, 1) if key is not None]
    found = feedback.latest_answers(versions)  # joins by key, so it has no null one
    assert tuples(found, "cache_key", "place", "recommended_id", "score") == sorted(expected)
    nulls = versions.where("cache_key is null").orderBy(F.desc("version"), "place").limit(2)
    assert [(r["place"], r["recommended_id"]) for r in nulls.collect()] == [(1, 1), (2, 1007)]


def test_each_key_of_a_slot_has_its_own_time_to_live():
    held = []

    class Handle:
        def getListState(self, name, schema, ttlDurationMs=None):
            class Rows:
                exists = staticmethod(lambda: bool(held))
                get = staticmethod(lambda: iter(held[-1]))
                put = staticmethod(lambda rows: held.append(list(rows)))

            return Rows()

    import pandas as pd

    top = feedback._TopRows(["slot"], 2, 7000, False, ["cache_key"])
    top.init(Handle())

    def give(now, *rows):
        class Now:
            getCurrentProcessingTimeInMs = staticmethod(lambda: now)

        chunk = pd.DataFrame(rows, columns=["cache_key", "at", "score", "recommended_id"])
        out = [tuple(r) for df in top.handleInputRows((3,), iter([chunk]), Now()) for r in df[["slot", "cache_key", "place", "recommended_id", "version"]].to_numpy().tolist()]
        return sorted(out)

    assert give(0, ("a", 9, 0.5, 1), ("b", 9, 0.5, 2)) == [(3, "a", 1, 1, 0), (3, "b", 1, 2, 0)]
    assert give(5000, ("a", 8, 0.5, 3)) == [(3, "a", 1, 1, 5000), (3, "a", 2, 3, 5000)]  # b is not given again
    assert give(6000, ("a", 8, 0.5, 3), ("b", 9, 0.5, 2)) == [] and len(held) == 2  # nothing new, nothing written
    # b was changed 8 seconds ago and is forgotten, a 3 seconds ago and is not
    assert give(8000, ("b", 1, 0.5, 4), ("a", 1, 0.5, 5)) == [(3, "b", 1, 4, 8000)]
    assert len(held) == 3 and all(len(rows) == 1 for rows in held)


def test_replayed_events_come_out_once(spark, feed):
    rows = [("click", "u", "i", n, at(n / 10)) for n in range(50)] + [("click", "u", "i", 99, None)]
    build = lambda stream: feedback.once(stream, ["id"], "timestamp", "1 hour")
    feed.send(rows[:30])
    feed.run(build)
    feed.send(rows)  # from the beginning again
    feed.run(build)
    feed.send(rows)
    assert sorted(r["id"] for r in feed.run(build).collect()) == list(range(50))


def test_a_batch_that_comes_again_changes_nothing(spark):
    out = fresh_path(spark, "again")
    rows = spark.createDataFrame([("click", "u", "i", n, at(n)) for n in range(5)], EVENT)
    rows.write.parquet(f"{out}/in")
    stream = spark.readStream.schema(EVENT).parquet(f"{out}/in")
    feedback.write_batches(stream, f"{out}/rows", f"{out}/checkpoint")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert fs.delete(path(f"{out}/checkpoint/commits/0"), False)  # as if the driver was lost before it noted the end
    feedback.write_batches(stream, f"{out}/rows", f"{out}/checkpoint")
    assert tuples(feedback.read_batches(spark, f"{out}/rows", rows.schema), "id") == [(n,) for n in range(5)]


def test_pending_files_are_read_once(spark):
    out = fresh_path(spark, "pending")

    def day(name, *ids):
        rows = [(name, n, 7, "2024-01-01 10:00:00", " /FAQ ", "El", "Pa" if n else None, 0.5, "Here") for n in ids]
        names = "day string, id int, user_id int, timestamp string, page string, clicked_element string, clicked_parameter string, duration double, location string"
        spark.createDataFrame(rows, names).coalesce(1).write.mode("append").partitionBy("day").option("header", True).csv(f"{out}/source")

    def clean():
        return clickstream.clean_pending_stream(spark, f"{out}/source", f"{out}/clean", f"{out}/checkpoint")

    day("2024-01-01", 0, 1)
    day("2024-01-02", 2)
    assert clean() == 3
    day("2024-01-02", 3, 4)  # a day that was done gets another file
    assert clean() == 2 and clean() == 0
    rows = spark.read.parquet(f"{out}/clean").select("id", F.col("date_folder").cast("string"), "page")
    assert tuples(rows) == [(1, "2024-01-01", "/faq"), (2, "2024-01-02", "/faq"), (3, "2024-01-02", "/faq"), (4, "2024-01-02", "/faq")]


def test_write_stream_goes_on_after_a_stop(spark):
    out = fresh_path(spark, "stop")
    for n in range(3):
        spark.createDataFrame([("click", "u", "i", n, at(n))], EVENT).write.mode("append").parquet(f"{out}/in")
        clicks.write_stream(spark.readStream.schema(EVENT).parquet(f"{out}/in"), f"{out}/rows", f"{out}/checkpoint")
    assert tuples(spark.read.parquet(f"{out}/rows"), "id") == [(0,), (1,), (2,)]
