"""Sources and sinks: the test tables written to the shared folder and read back."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from edupipe.catalog.registry import query
from edupipe.functions import records
from edupipe.session import fresh_path
from edupipe.sources import readers, writers

_CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
_SUPPLIER = "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"


@query("src_json_typed", _CUSTOMER)
def src_json_typed(t):
    path = fresh_path(t.spark, "json")
    writers.write_json_array(t.customer, path)
    return readers.read_json(t.spark, path, t.customer.schema)


@query("src_json_inferred", "SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier")
def src_json_inferred(t):
    path = fresh_path(t.spark, "json")
    writers.write_json_array(t.supplier, path)
    return readers.read_json(t.spark, path)


_HISTORY = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("page", T.StringType()),
        T.StructField("clicked_parameter", T.StringType()),
        T.StructField("duration", T.DoubleType()),
    ]
)


@query(
    "src_csv_typed",
    """SELECT event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at, event_type AS page, '"Save" ' || props AS clicked_parameter,
              CASE WHEN event_type = 'error' THEN -1 ELSE value END AS duration FROM events""",
)
def src_csv_typed(t):
    """A quoted text with quotes inside, and numbers that are none in some rows."""
    path = fresh_path(t.spark, "csv")
    rows = t.events.select(
        F.col("event_id").alias("id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("event_type").alias("page"),
        F.concat(F.lit('"Save" '), "props").alias("clicked_parameter"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("duration"),
    )
    writers.write_csv(rows, path)
    back = readers.read_csv(t.spark, path, _HISTORY)
    at = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at")
    return back.select("id", at, "page", "clicked_parameter", F.coalesce("duration", F.lit(-1.0)).alias("duration"))


@query("src_csv_delimited", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey, s_acctbal FROM supplier")
def src_csv_delimited(t):
    path = fresh_path(t.spark, "csv")
    writers.write_csv(t.supplier, path, ";")
    return readers.read_csv(t.spark, path, separator=";").withColumn("s_acctbal", F.col("s_acctbal").cast("double"))


@query("src_parquet_projected", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'")
def src_parquet_projected(t):
    wanted = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_orderpriority", T.StringType()),
        ]
    )
    orders = readers.read_parquet(t.spark, t.path("orders"), wanted)
    return orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderpriority")


@query("src_latest_snapshot", "SELECT s_suppkey, s_name || ' new' AS s_name FROM supplier")
def src_latest_snapshot(t):
    folder = fresh_path(t.spark, "snapshots")
    for month, mark in (("2025-04", " old"), ("2025-03", " new")):
        snapshot = t.supplier.select("s_suppkey", F.concat("s_name", F.lit(mark)).alias("s_name"))
        writers.write_parquet(snapshot, f"{folder}/{month}_scholarship_data.parquet")
    writers.write_parquet(t.supplier, f"{folder}/2025-05_other.parquet")
    return readers.read_parquet(t.spark, readers.latest_dataset(t.spark, folder, "scholarship_data"))


@query(
    "src_pending_partitions",
    """SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS dt FROM events
       WHERE strftime(ts, '%Y-%m-%d') NOT IN (SELECT strftime(ts, '%Y-%m-%d') FROM events WHERE event_type = 'error' AND CAST(strftime(ts, '%d') AS INT) % 3 = 1)""",
)
def src_pending_partitions(t):
    days = t.events.withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    done = days.where("event_type = 'error' AND day(ts) % 3 = 1")
    return readers.pending_partitions(days, done, "dt")


@query(
    "src_path_fields",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS date_folder, event_type || '.csv' AS file_name FROM events
       WHERE event_type NOT IN ('view', 'error')""",
)
def src_path_fields(t):
    """All events in folders by day and kind, read back by the paths that Spark gives them; one kind has no day, one is JSON."""
    folder = fresh_path(t.spark, "history")
    day = F.when(F.col("event_type") == "view", "undated").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    rows = t.events.select(F.col("event_id").cast("string").alias("value"), "event_type", day.alias("day"))
    for kinds, ending in ((F.col("event_type") != "error", "csv"), (F.col("event_type") == "error", "json")):
        files = rows.where(kinds).hint("rebalance", F.col("day"), F.col("event_type"))
        files.write.mode("append").partitionBy("day", "event_type").format(ending).save(folder)
    scan = t.spark.read.option("recursiveFileLookup", True).text(folder)
    # Spark writes a folder of parts for each kind: its name stands for that of the file.
    path = F.regexp_replace("_metadata.file_path", r"/event_type=([^/]+)/part-[^/]*(\.\w+)$", "/$1$2")
    named = readers.with_path_fields(scan.withColumn("path", path), F.col("path"))
    return named.select(F.expr("try_cast(value AS BIGINT)").alias("event_id"), "date_folder", "file_name")


@query(
    "coerce_to_schema",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, CASE event_type WHEN 'view' THEN 'not specified' ELSE event_type END AS name,
              CASE event_type WHEN 'click' THEN 't1,t2' ELSE '' END AS tags, CASE event_type WHEN 'purchase' THEN 'b' ELSE '-' END AS extra,
              'not specified' AS absent, '["x"]' AS container FROM events""",
)
def coerce_to_schema(t):
    kind = F.col("event_type")
    json = F.concat(
        F.regexp_replace("props", r"\}$", ""),
        F.lit(', "name": "'), F.when(kind == "view", "").otherwise(kind),
        F.lit('", "tags": '), F.when(kind == "click", '["t1", "t2"]').otherwise('"none"'),
        F.lit(', "extra": '), F.when(kind == "purchase", '{"a": "b"}').otherwise("null"),
        F.lit(', "container": ["x"]}'),
    )
    schema = T.StructType(
        [
            T.StructField("k", T.StringType()),
            T.StructField("name", T.StringType()),
            T.StructField("tags", T.ArrayType(T.StringType())),
            T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
            T.StructField("absent", T.StringType()),
            T.StructField("container", T.StringType()),
        ]
    )
    rows = t.events.select("event_id", records.parse_object(json, schema).alias("object"))
    coerced = rows.select("event_id", *records.coerced_fields(F.col("object"), schema))
    return coerced.withColumns(
        {"tags": F.array_join("tags", ","), "extra": F.coalesce(F.try_element_at("extra", F.lit("a")), F.lit("-"))}
    )


@query("sink_parquet_roundtrip", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def sink_parquet_roundtrip(t):
    path = fresh_path(t.spark, "parquet")
    writers.write_parquet(t.part, path)
    return readers.read_parquet(t.spark, path, t.part.schema)


@query("sink_csv_roundtrip", _SUPPLIER)
def sink_csv_roundtrip(t):
    path = fresh_path(t.spark, "csv")
    writers.write_csv(t.supplier, path)
    return readers.read_csv(t.spark, path, t.supplier.schema)


@query("sink_json_roundtrip", _CUSTOMER)
def sink_json_roundtrip(t):
    path = fresh_path(t.spark, "json")
    writers.write_json(t.customer, path)
    return t.spark.read.schema(t.customer.schema).json(path)


@query(
    "history_partitioned_counts",
    "SELECT event_type, strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n_events, sum(event_id)::BIGINT AS id_sum FROM events GROUP BY 1, 2",
)
def history_partitioned_counts(t):
    path = fresh_path(t.spark, "history")
    writers.write_history(t.events, path, "event_type", "ts")
    days = t.spark.read.parquet(path)
    return (
        days.groupBy("event_type", F.date_format("dt", "yyyy-MM-dd").alias("dt"))
        .agg(F.count("*").alias("n_events"), F.sum("event_id").alias("id_sum"))
    )
