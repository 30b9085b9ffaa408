"""Recommendations and click feedback as running streams, stopped and started again half way."""

import contextlib

from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.catalog.registry import query
from edupipe.catalog.streams import FRESH_SQL, KEYED_SQL
from edupipe.functions.text import composite_key
from edupipe.operators import vectors
from edupipe.plans import clickstream, shapes
from edupipe.session import fresh_path, materialise
from edupipe.sources import readers
from edupipe.streaming import clicks, feedback, ttl

_ITEM = "json_extract_string(props, '$.k')"


@contextlib.contextmanager
def _keyed_state(spark):
    """The state store that streams with state of their own need."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, ttl.STATE_STORE)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _halves(rows, ts):
    """The rows before and after the middle of their time: what arrives before a restart and after it."""
    second = F.unix_seconds(F.col(ts).cast("timestamp"))
    middle = rows.agg((F.min(second) + F.max(second)) / 2).scalar()
    return rows.where(second < middle), rows.where(second >= middle)


def _arriving(t, parts, build, write):
    """Let the parts arrive one after the other, each met by a new start of the same stream; gives the folder written."""
    out = fresh_path(t.spark, "arrivals")
    for part in parts:
        part.write.mode("append").parquet(f"{out}/in")
        stream = t.spark.readStream.schema(parts[0].schema).parquet(f"{out}/in")
        with _keyed_state(t.spark):
            write(build(stream), f"{out}/rows", f"{out}/checkpoint")
    return f"{out}/rows"


@query(
    "stream_mark_clicked",
    f"""SELECT r.event_id AS recommended_id, r.user_id, r.event_type = 'signup' OR EXISTS (
          SELECT 1 FROM events c WHERE c.event_type = 'click' AND c.user_id = r.user_id
            AND json_extract_string(c.props, '$.k') = json_extract_string(r.props, '$.k') AND c.ts >= r.ts AND c.ts <= r.ts + INTERVAL 7 DAY) AS clicked
        FROM events r""",
)
def stream_mark_clicked(t):
    """Every event recommends its item to its user; a click on it counts for seven days."""
    rows = t.events.select(
        "event_id", "user_id", F.get_json_object("props", "$.k").alias("item_id"), "event_type", F.col("ts").cast("timestamp").alias("timestamp")
    )
    # a message long after the last event says that nothing else comes
    end = rows.agg((F.max("timestamp") + F.expr("INTERVAL 30 DAYS")).alias("timestamp")).select(
        F.lit(None).cast(dict(rows.dtypes)["event_id"]).alias("event_id"), F.lit(-1).cast(dict(rows.dtypes)["user_id"]).alias("user_id"),
        F.lit("").alias("item_id"), F.lit("click").alias("event_type"), "timestamp",
    )

    def build(stream):
        recs = stream.select("event_id", "user_id", "item_id", "timestamp", (F.col("event_type") == "signup").alias("clicked"))
        return feedback.mark_clicked(recs, stream.where("event_type = 'click'"), ["event_id"])

    path = _arriving(t, [*_halves(rows, "timestamp"), end], build, clicks.write_stream)
    marked = t.spark.read.parquet(path).where("event_id is not null")
    return marked.select(F.col("event_id").alias("recommended_id"), "user_id", "clicked")


@query("stream_recommend_fresh", FRESH_SQL)
def stream_recommend_fresh(t):
    """Look-up, time to live and answer in one stream, stopped half way and started again."""
    open_items = t.embeddings.where("label % 2 = 0")
    table = vectors.knn_table(open_items, "vec_id", "embedding", fv.TOP_ITEMS, queries=t.embeddings)
    lists = vectors.neighbour_lists(table.withColumn("vec_id", F.col("vec_id").cast("string")), "vec_id")
    lists = materialise(lists, "neighbours")  # every micro batch reads it
    saves = t.events.where("event_type IN ('purchase', 'click')").select(
        F.col("user_id").cast("string").alias("user_id"), F.get_json_object("props", "$.k").alias("item_id"),
        F.col("ts").cast("timestamp").alias("timestamp"), "event_id",
    )
    path = _arriving(
        t, _halves(saves, "timestamp"), lambda stream: feedback.recommend_fresh(stream, lists, "event_id", 864_000), clicks.write_stream
    )
    return t.spark.read.parquet(path).select(
        "user_id", "source_id", "recommended_id", F.round("score", 6).alias("score"), F.unix_seconds("timestamp").alias("second")
    )


@query(
    "stream_answers",
    f"""SELECT cache_key, CAST(n AS INTEGER) AS place, rec AS recommended_id, score FROM (
          SELECT *, row_number() OVER (PARTITION BY cache_key ORDER BY ts DESC, score DESC, rec) AS n FROM ({KEYED_SQL}) WHERE event_type = 'purchase')
        WHERE n <= 5""",
)
def stream_answers(t):
    """The newest five answers of each user and item, and of each item, kept in the stream's state."""
    recs = shapes.recommendations(t.events.where("event_type = 'purchase'"))
    keys = [composite_key(fv.CACHE_PREFIX, user, F.col("source_id")) for user in (F.col("user_id"), F.lit(fv.GENERAL_USER))]
    rows = recs.select(F.explode(F.array(*keys)).alias("cache_key"), "recommended_id", F.col("timestamp").cast("timestamp").alias("timestamp"), "score")
    with feedback.without_empty_batches(t.spark):
        path = _arriving(t, _halves(rows, "timestamp"), feedback.top_answers, clicks.write_stream)
    return feedback.latest_answers(t.spark.read.parquet(path)).select("cache_key", "place", "recommended_id", "score")


@query("stream_once", "SELECT event_id, user_id, event_type FROM events")
def stream_once(t):
    """After the first half everything is sent again from the beginning, twice."""
    rows = t.events.select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("timestamp"))
    first, _ = _halves(rows, "timestamp")
    path = _arriving(t, [first, rows, rows], lambda stream: feedback.once(stream, ["event_id"], "timestamp"), feedback.write_batches)
    return feedback.read_batches(t.spark, path, rows.schema).drop("timestamp")


@query(
    "stream_pending_days",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS date_folder, CASE WHEN user_id % 5 = 0 THEN 'home' ELSE event_type END AS page FROM events""",
)
def stream_pending_days(t):
    """Days come in two lots, some days in both; each run cleans only the files that are new."""
    out = fresh_path(t.spark, "pending")
    page = F.when(F.col("user_id") % 5 == 0, " Home ").otherwise(F.upper("event_type"))
    rows = t.events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("event_id").cast("int").alias("id"), F.col("user_id").cast("int").alias("user_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), page.alias("page"), F.lit("Link").alias("clicked_element"),
        F.lit("none").alias("clicked_parameter"), F.col("value").alias("duration"), F.lit("here").alias("location"), "ts",
    )
    for part in _halves(rows, "ts"):
        files = part.drop("ts").hint("rebalance", F.col("day"))
        files.write.mode("append").partitionBy("day").option("header", True).csv(f"{out}/source")
        clickstream.clean_pending_stream(t.spark, f"{out}/source", f"{out}/clean", f"{out}/checkpoint")
    clean = readers.read_parquet(t.spark, f"{out}/clean")
    return clean.select(F.col("id").cast("long").alias("event_id"), F.col("date_folder").cast("string").alias("date_folder"), "page")
