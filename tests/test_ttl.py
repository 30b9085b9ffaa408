import datetime
import random

from pyspark.sql import functions as F

from edupipe.session import fresh_path
from edupipe.streaming import ttl

START = datetime.datetime(2024, 1, 1)


def _events(spark, rows):
    """rows: (user, seconds after the start, event id)"""
    data = [(user, START + datetime.timedelta(seconds=s), event) for user, s, event in rows]
    return spark.createDataFrame(data, "user string, ts timestamp, event long")


def _brute(rows, span):
    out, last = [], {}
    for user, s, event in sorted(rows, key=lambda r: (r[0], int(r[1] // 1), r[2])):
        second = int(s // 1)
        if user not in last or second - last[user] >= span:
            last[user] = second
            out.append((user, second, event))
    return sorted(out)


def _got(df):
    base = int(START.replace(tzinfo=datetime.timezone.utc).timestamp())
    return sorted((r["user"], r["second"] - base, r["event"]) for r in df.collect())


def test_edges_of_the_time_to_live(spark):
    rows = [("a", 0, 1), ("a", 3599, 2), ("a", 3600, 3), ("a", 7199.9, 4), ("b", 3599, 5)]
    got = _got(ttl.first_per_ttl(_events(spark, rows), ["user"], "ts", "event"))
    assert got == [("a", 0, 1), ("a", 3600, 3), ("b", 3599, 5)]


def test_against_brute_force_with_one_heavy_key(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.5 else f"u{rng.randrange(40)}", rng.uniform(0, 200_000), i) for i in range(4000)]
    got = _got(ttl.first_per_ttl(_events(spark, rows), ["user"], "ts", "event"))
    assert got == _brute(rows, 3600)


def test_stream_equals_batch(spark):
    rng = random.Random(2)
    rows = sorted(((f"u{rng.randrange(5)}", rng.uniform(0, 90_000), i) for i in range(300)), key=lambda r: r[1])
    source, out = fresh_path(spark, "source"), fresh_path(spark, "out")
    for part in range(3):  # three files in order of time: three micro batches
        _events(spark, rows[part * 100:(part + 1) * 100]).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("user string, ts timestamp, event long").option("maxFilesPerTrigger", 1).parquet(source)
    kept = ttl.stream_first_per_ttl(stream, ["user"], "ts", "event")
    query = (
        kept.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint").outputMode("append")
        .trigger(availableNow=True).start(f"{out}/rows")
    )
    query.awaitTermination()
    assert _got(spark.read.parquet(f"{out}/rows")) == _brute(rows, 3600)


def test_null_keys_null_times_and_large_keys(spark):
    big = 9007199254740993
    more = [(big + u, s, 100 * u + s) for u in range(2, 30) for s in (0, 5000)]
    rows = more + [(None, 0, 1), (None, 10, 2), (None, 20, 3), (None, 4000, 4), (big, None, 5), (big, 0, 6), (big, 4000, 7), (big - 1, 1, 8), (big, 4001, 9)]
    data = [(u, None if s is None else START + datetime.timedelta(seconds=s), e) for u, s, e in rows]
    events = spark.createDataFrame(data, "user long, ts timestamp, event long")
    expected = more + [(None, 0, 1), (None, 4000, 4), (big - 1, 1, 8), (big, 0, 6), (big, 4000, 7)]
    got = _plain(ttl.first_per_ttl(events, ["user"], "ts", "event"))
    assert got == sorted(expected, key=repr)
    source = fresh_path(spark, "source")
    events.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(events.schema).parquet(source)
    assert _plain(_run(spark, ttl.stream_first_per_ttl(stream, ["user"], "ts", "event"))) == sorted(expected, key=repr)
    assert ttl.first_per_ttl(events.limit(0), ["user"], "ts", "event").collect() == []


def _plain(df):
    base = int(START.replace(tzinfo=datetime.timezone.utc).timestamp())
    return sorted(((r["user"], r["second"] - base, r["event"]) for r in df.collect()), key=repr)


def _run(spark, kept):
    out = fresh_path(spark, "out")
    query = (
        kept.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint").outputMode("append")
        .trigger(availableNow=True).start(f"{out}/rows")
    )
    query.awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def test_state_goes_when_its_time_is_over(spark):
    source, out = fresh_path(spark, "source"), fresh_path(spark, "out")
    for part in range(4):  # other users in every file, three hours apart
        rows = [(f"u{part}-{i}", part * 10_800 + i, i) for i in range(20)]
        _events(spark, rows).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("user string, ts timestamp, event long").option("maxFilesPerTrigger", 1).parquet(source)
    kept = ttl.stream_first_per_ttl(stream, ["user"], "ts", "event")
    query = (
        kept.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint").outputMode("append")
        .trigger(availableNow=True).start(f"{out}/rows")
    )
    query.awaitTermination()
    assert spark.read.parquet(f"{out}/rows").count() == 80
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < 80 * 2


def test_many_batches_of_one_key(spark):
    rows = [("hot", i * 7, i) for i in range(5000)] + [("z", i * 1800, i) for i in range(9)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        assert _got(ttl.first_per_ttl(_events(spark, rows), ["user"], "ts", "event")) == _brute(rows, 3600)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_seconds_are_counted_once_before_the_shuffle(spark):
    rows = [("a", i / 1000, i) for i in range(5000)]
    df = ttl.first_per_ttl(_events(spark, rows), ["user"], "ts", "event")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    assert df.select(F.col("event")).collect()[0][0] == 0


def test_keys_of_a_slot_share_their_state(spark):
    """Thousands of keys are at most as many entries as there are slots, and each has its own time to live."""
    rng = random.Random(3)
    rows = sorted(((f"u{rng.randrange(5000)}", rng.uniform(0, 9000), i) for i in range(16_000)), key=lambda r: r[1])
    source, out = fresh_path(spark, "source"), fresh_path(spark, "out")
    for part in range(2):
        _events(spark, rows[part * 8000:(part + 1) * 8000]).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("user string, ts timestamp, event long").option("maxFilesPerTrigger", 1).parquet(source)
    query = (
        ttl.stream_first_per_ttl(stream, ["user"], "ts", "event", 3600).writeStream.format("parquet")
        .option("checkpointLocation", f"{out}/checkpoint").outputMode("append").trigger(availableNow=True).start(f"{out}/rows")
    )
    query.awaitTermination()
    assert _got(spark.read.parquet(f"{out}/rows")) == _brute(rows, 3600)
    # an entry and the two of its timer for each slot
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 3 * 1024
