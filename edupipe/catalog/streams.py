"""Click stream and recommendations on the test events."""

from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.catalog.registry import query
from edupipe.functions.text import composite_key
from edupipe.operators import recommend, vectors
from edupipe.operators.dedupe import best_per_key
from edupipe.plans import clickstream, shapes
from edupipe.session import fresh_path, materialise
from edupipe.sources import writers
from edupipe.streaming import clicks, ttl

_TOPIC = """CASE event_type WHEN 'view' THEN 'search_events' WHEN 'signup' THEN 'filter_events'
    WHEN 'error' THEN 'faq_events' ELSE 'details_events' END"""
_ITEM = "json_extract_string(props, '$.k')"
_FIELDS = ["Timestamp", "User_ID", "Session_ID", "Page", "Duration", "Location", "Clicked_Element", "Clicked_Parameter"]


def _messages(events):
    return writers.keyed_messages(shapes.clicks(events), "topic", "User_ID", _FIELDS)


def _streamed(t):
    """The events table as a stream of messages."""
    return _messages(t.stream("events"))


@query(
    "stream_encode",
    f"""SELECT {_TOPIC} AS topic, CAST(user_id AS VARCHAR) AS key, CAST(event_id AS VARCHAR) AS session_id, value AS duration FROM events""",
)
def stream_encode(t):
    sent = _messages(t.events)
    value = F.decode("value", "UTF-8")
    return sent.select(
        "topic", F.decode("key", "UTF-8").alias("key"), F.get_json_object(value, "$.Session_ID").alias("session_id"),
        F.get_json_object(value, "$.Duration").cast("double").alias("duration"),
    )


@query(
    "stream_decode",
    f"""SELECT {_TOPIC} AS topic, CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS session_id,
               strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at, '/' || event_type AS page, value AS duration,
               CASE WHEN event_type IN ('click', 'purchase') THEN 'Scholarship ID: ' || {_ITEM} ELSE 'Search Input: ' || props END AS clicked_parameter
        FROM events""",
)
def stream_decode(t):
    events = clicks.decode(_messages(t.events))
    at = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at")
    return events.select("topic", "user_id", "session_id", at, "page", "duration", "clicked_parameter")


@query(
    "stream_route_counts",
    f"""SELECT replace({_TOPIC}, '_events', '_table') AS table_name, count(*) AS n_events, count(DISTINCT user_id) AS n_users,
               strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS newest FROM events GROUP BY 1""",
)
def stream_route_counts(t):
    """A real stream: read, decode, route, append by table, then read the tables."""
    out = fresh_path(t.spark, "clicks")
    routed = clicks.route(clicks.decode(_streamed(t)))
    clicks.write_stream(routed, f"{out}/tables", f"{out}/checkpoint", ["table_name"])
    return t.spark.read.parquet(f"{out}/tables").groupBy("table_name").agg(
        F.count("*").alias("n_events"), F.count_distinct("user_id").alias("n_users"),
        F.date_format(F.max("timestamp"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("newest"),
    )


@query(
    "stream_save_clicks",
    f"SELECT CAST(user_id AS VARCHAR) AS user_id, {_ITEM} AS item_id, CAST(event_id AS VARCHAR) AS session_id FROM events WHERE event_type = 'purchase'",
)
def stream_save_clicks(t):
    out = fresh_path(t.spark, "saves")
    saves = clicks.save_clicks(clicks.decode(_streamed(t))).select("user_id", "item_id", "session_id")
    clicks.write_stream(saves, f"{out}/saves", f"{out}/checkpoint")
    return t.spark.read.parquet(f"{out}/saves")


@query(
    "stream_recommend",
    f"""WITH knn AS (SELECT * FROM (
          SELECT q.vec_id AS item, v.vec_id AS rec, list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS score
          FROM embeddings q JOIN embeddings v ON v.vec_id <> q.vec_id WHERE v.label % 2 = 0)
          QUALIFY row_number() OVER (PARTITION BY item ORDER BY round(score, 12) DESC, rec) <= 5)
        SELECT CAST(user_id AS VARCHAR) AS user_id, {_ITEM} AS source_id, CAST(rec AS VARCHAR) AS recommended_id, round(score, 6) AS score,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS at
        FROM events JOIN knn ON item = CAST({_ITEM} AS BIGINT) WHERE event_type = 'purchase'""",
)
def stream_recommend(t):
    """A real stream joined with the table of open neighbours."""
    open_items = t.embeddings.where("label % 2 = 0")
    table = vectors.knn_table(open_items, "vec_id", "embedding", fv.TOP_ITEMS, queries=t.embeddings)
    table = table.withColumns({"vec_id": F.col("vec_id").cast("string"), "recommended_id": F.col("recommended_id").cast("string")})
    out = fresh_path(t.spark, "recommendations")
    lists = materialise(vectors.neighbour_lists(table, "vec_id"), "neighbours")  # every micro batch reads it
    hits = clicks.recommend(clicks.save_clicks(clicks.decode(_streamed(t))), lists)
    clicks.write_stream(hits, f"{out}/rows", f"{out}/checkpoint")
    rows = t.spark.read.parquet(f"{out}/rows")
    return rows.select(
        "user_id", "source_id", "recommended_id", F.round("score", 6).alias("score"),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("at"),
    )


# Some users and some times are null: a null user is a key like any other, an event without a time passes nothing.
_TTL_SQL = """WITH RECURSIVE e AS (
      SELECT nullif(user_id, 7) + 9007199254740993 AS user_id, CAST(floor(epoch_us(nullif(ts, CASE WHEN event_id % 10 = 3 THEN ts END)) / 1000000) AS BIGINT) AS second,
             min(event_id) AS event_id FROM events GROUP BY 1, 2),
    timed AS (SELECT * FROM e WHERE second IS NOT NULL),
    chain AS (
      SELECT user_id, min(second) AS second FROM timed GROUP BY 1
      UNION ALL
      SELECT c.user_id, min(t.second) FROM chain c JOIN timed t ON t.user_id IS NOT DISTINCT FROM c.user_id AND t.second >= c.second + 3600 GROUP BY 1)
    SELECT t.user_id, t.second, t.event_id FROM timed t JOIN chain c ON t.user_id IS NOT DISTINCT FROM c.user_id AND t.second = c.second"""


def _with_nulls(events):
    some = F.nullif(F.col("ts"), F.when(F.col("event_id") % 10 == 3, F.col("ts")))
    return events.withColumn("user_id", F.nullif(F.col("user_id"), F.lit(7)) + 9007199254740993).withColumn("ts", some)


@query("stream_ttl_first", _TTL_SQL)
def stream_ttl_first(t):
    return ttl.first_per_ttl(_with_nulls(t.events), ["user_id"], "ts", "event_id")


@query("stream_ttl_state", _TTL_SQL)
def stream_ttl_state(t):
    """The same as a real stream with keyed state."""
    out, setting = fresh_path(t.spark, "ttl"), "spark.sql.streaming.stateStore.providerClass"
    before = t.spark.conf.get(setting)
    t.spark.conf.set(setting, ttl.STATE_STORE)
    try:
        kept = ttl.stream_first_per_ttl(_with_nulls(t.stream("events")), ["user_id"], "ts", "event_id")
        clicks.write_stream(kept, f"{out}/rows", f"{out}/checkpoint")
    finally:
        t.spark.conf.set(setting, before)
    return t.spark.read.parquet(f"{out}/rows")


FRESH_SQL = f"""WITH RECURSIVE knn AS (SELECT * FROM (
          SELECT q.vec_id AS item, v.vec_id AS rec, list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS score
          FROM embeddings q JOIN embeddings v ON v.vec_id <> q.vec_id WHERE v.label % 2 = 0)
          QUALIFY row_number() OVER (PARTITION BY item ORDER BY round(score, 12) DESC, rec) <= 5),
        e AS (SELECT DISTINCT user_id, CAST({_ITEM} AS BIGINT) AS item, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS second
              FROM events WHERE event_type IN ('purchase', 'click')),
        chain AS (
          SELECT user_id, item, min(second) AS second FROM e GROUP BY 1, 2
          UNION ALL
          SELECT c.user_id, c.item, min(e.second) FROM chain c JOIN e ON e.user_id = c.user_id AND e.item = c.item AND e.second >= c.second + 864000
          GROUP BY 1, 2)
        SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(item AS VARCHAR) AS source_id, rec AS recommended_id, round(score, 6) AS score, second
        FROM chain JOIN knn USING (item)"""


@query("recommend_fresh", FRESH_SQL)
def recommend_fresh(t):
    """Saves and detail clicks, at most one answer per user and item in ten days."""
    open_items = t.embeddings.where("label % 2 = 0")
    table = vectors.knn_table(open_items, "vec_id", "embedding", fv.TOP_ITEMS, queries=t.embeddings)
    lists = materialise(vectors.neighbour_lists(table.withColumn("vec_id", F.col("vec_id").cast("string")), "vec_id"), "neighbours")
    saves = t.events.where("event_type IN ('purchase', 'click')").select(
        F.col("user_id").cast("string").alias("user_id"), F.get_json_object("props", "$.k").alias("item_id"),
        F.col("ts").cast("timestamp").alias("timestamp"), "event_id",
    )
    fresh = clickstream.fresh_recommendations(saves, lists, "event_id", 864_000)
    return fresh.select(
        "user_id", "source_id", "recommended_id", F.round("score", 6).alias("score"), F.unix_seconds("timestamp").alias("second")
    )


@query(
    "latest_per_source",
    f"""SELECT CAST({_ITEM} AS INT) AS source_id, event_id AS recommended_id, value AS score FROM events WHERE user_id = 7
        QUALIFY row_number() OVER (PARTITION BY {_ITEM} ORDER BY ts DESC, value DESC, event_id) = 1 ORDER BY 1 LIMIT 5""",
)
def latest_per_source(t):
    return recommend.latest_per_source(shapes.recommendations(t.events), 7).select("source_id", "recommended_id", "score")


@query(
    "recs_for_item",
    f"""SELECT user_id, event_id AS recommended_id, value AS score FROM events WHERE CAST({_ITEM} AS INT) = 42
        ORDER BY ts DESC, value DESC, event_id, user_id LIMIT 5""",
)
def recs_for_item(t):
    return recommend.newest_for_item(shapes.recommendations(t.events), 42).select("user_id", "recommended_id", "score")


@query(
    "recs_with_metadata",
    """SELECT event_id AS recommended_id, coalesce(lang, '-') AS lang, coalesce(n_chars, -1) AS n_chars
       FROM events LEFT JOIN documents ON doc_id = event_id""",
)
def recs_with_metadata(t):
    rows = recommend.recommendation_rows(
        shapes.recommendations(t.events), t.documents.select("doc_id", "lang", "n_chars"), "doc_id"
    )
    return rows.select("recommended_id", F.coalesce("lang", F.lit("-")).alias("lang"), F.coalesce("n_chars", F.lit(-1)).alias("n_chars"))


_AS_OF = "2024-01-20 12:00:00"


@query(
    "recs_served",
    f"""SELECT cache_key, count(*) AS n_rows, epoch_us(TIMESTAMP '{_AS_OF}') - max(epoch_us(ts)) < 86400000000 AS is_cached FROM (
          SELECT 'recommendations:' || user_id || ':' || {_ITEM} AS cache_key, ts FROM events
          UNION ALL SELECT 'recommendations:general:' || {_ITEM}, ts FROM events) GROUP BY 1""",
)
def recs_served(t):
    recs = shapes.recommendations(t.events).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return recommend.served(recs, F.lit(_AS_OF).cast("timestamp"), ttl_seconds=86_400)


KEYED_SQL = f"""SELECT 'recommendations:' || u || ':' || item AS cache_key, event_id AS rec, value AS score, ts, event_type
    FROM (SELECT *, unnest([CAST(user_id AS VARCHAR), 'general']) AS u, {_ITEM} AS item FROM events)"""


@query(
    "recs_served_rows",
    f"""WITH r AS ({KEYED_SQL}),
          stored AS (SELECT *, row_number() OVER (PARTITION BY cache_key ORDER BY ts DESC, score DESC, rec) AS n, max(ts) OVER (PARTITION BY cache_key) AS kept_at
                     FROM r WHERE event_type = 'purchase'),
          alive AS (SELECT * FROM stored WHERE epoch_us(TIMESTAMP '{_AS_OF}') - epoch_us(kept_at) < 86400000000),
          newest AS (SELECT *, row_number() OVER (PARTITION BY cache_key ORDER BY ts DESC, score DESC, rec) AS n FROM r
                     WHERE cache_key NOT IN (SELECT cache_key FROM alive))
        SELECT cache_key, CAST(n AS INTEGER) AS place, rec AS recommended_id, score, is_cached, coalesce(label, -1) AS label FROM (
          SELECT cache_key, n, rec, score, true AS is_cached FROM alive WHERE n <= 5
          UNION ALL SELECT cache_key, n, rec, score, false FROM newest WHERE n <= 5) LEFT JOIN embeddings ON vec_id = rec""",
)
def recs_served_rows(t):
    """Answers are cached when something is bought."""
    recs = shapes.recommendations(t.events).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    bought = t.events.where("event_type = 'purchase'")
    kept = shapes.recommendations(bought).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    keys = [composite_key(fv.CACHE_PREFIX, user, F.col("source_id")) for user in (F.col("user_id"), F.lit(fv.GENERAL_USER))]
    row = F.struct((-F.unix_micros("timestamp")).alias("t"), (-F.col("score")).alias("s"), "recommended_id", "score")
    newest = [F.desc("timestamp"), F.desc("score"), F.asc("recommended_id")]
    first = best_per_key(kept.withColumn("cache_key", F.explode(F.array(*keys))), ["cache_key"], newest, fv.TOP_ITEMS)
    entries = first.groupBy("cache_key").agg(
        F.max("timestamp").alias("stored_at"), F.array_sort(F.collect_list(row)).alias("rows")
    )
    answer = F.transform("rows", lambda x: F.struct(x["recommended_id"].alias("recommended_id"), x["score"].alias("score")))
    found = recommend.served_rows(
        recs, entries.withColumn("answer", answer), t.embeddings.select("vec_id", "label"), "vec_id",
        F.lit(_AS_OF).cast("timestamp"), ttl_seconds=86_400,
    )
    return found.withColumn("label", F.coalesce("label", F.lit(-1)))


@query(
    "cache_audit",
    f"""SELECT * FROM (SELECT cache_key, 86400 - CAST(floor((epoch_us(TIMESTAMP '{_AS_OF}') - stored) / 1000000) AS BIGINT) AS ttl_left, n_recommendations FROM (
          SELECT 'recommendations:' || user_id || ':' || {_ITEM} AS cache_key, max(epoch_us(ts)) AS stored, count(*) AS n_recommendations FROM events GROUP BY 1))
        WHERE ttl_left BETWEEN 1 AND 86400""",
)
def cache_audit(t):
    recs = shapes.recommendations(t.events)
    key = composite_key(fv.CACHE_PREFIX, F.col("user_id"), F.col("source_id")).alias("cache_key")
    entries = recs.groupBy(key).agg(
        F.max(F.col("timestamp").cast("timestamp")).alias("stored_at"), F.count("*").alias("n_recommendations")
    )
    return recommend.cache_audit(entries, F.lit(_AS_OF).cast("timestamp"), ttl_seconds=86_400)


@query(
    "mark_clicked",
    f"""SELECT event_id AS recommended_id, user_id,
               event_type = 'signup' OR (user_id, event_id) IN (SELECT user_id, event_id FROM events WHERE event_type = 'click') AS clicked FROM events""",
)
def mark_clicked(t):
    recs = shapes.recommendations(t.events)
    seen = t.events.where("event_type = 'click'").select("user_id", F.col("event_id").alias("recommended_id"))
    return recommend.mark_clicked(recs, seen.union(seen)).select("recommended_id", "user_id", "clicked")
