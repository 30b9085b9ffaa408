"""Constraint checks and statistics on the test tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from edupipe import fixed_values as fv
from edupipe.catalog.registry import query
from edupipe.operators import quality
from edupipe.session import fresh_path


@query(
    "dq_accepted_values",
    """SELECT o_orderkey, coalesce(p, '-') AS priority FROM (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS p FROM orders)
       WHERE p IS NULL OR p NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
)
def dq_accepted_values(t):
    given = t.orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    bad = quality.outside_accepted(given, "priority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])
    return bad.select("o_orderkey", F.coalesce("priority", F.lit("-")).alias("priority"))


@query(
    "dq_split_rejected",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'o_orderstatus,o_orderpriority'
              WHEN o_orderstatus = 'P' THEN 'o_orderstatus' ELSE 'o_orderpriority' END AS failing
       FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW'""",
)
def dq_split_rejected(t):
    accepted = {"o_orderstatus": ["O", "F"], "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]}
    rejected = quality.split_accepted(t.orders, accepted)[1]
    return rejected.select("o_orderkey", F.array_join("failing", ",").alias("failing"))


@query("dq_unique", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq_unique(t):
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "dq_foreign_key",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events
       WHERE CAST(json_extract_string(props, '$.k') AS INT) NOT IN (SELECT n_nationkey FROM nation)""",
)
def dq_foreign_key(t):
    keyed = t.events.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    return quality.orphans(keyed, "k", t.nation, "n_nationkey").select("event_id", "k")


@query(
    "dq_array_subset",
    """SELECT p_partkey, p_name FROM part WHERE p_size <= 40
       AND len(list_filter([lpad(CAST(p_size % 11 AS VARCHAR), 2, '0'), lpad(CAST(p_size AS VARCHAR), 2, '0')],
                           lambda x: NOT list_contains(['00','01','02','03','04','05','06','07','08','09','10'], x))) > 0""",
)
def dq_array_subset(t):
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    codes = F.when(F.col("p_size") <= 40, F.array(two(F.col("p_size") % 11), two(F.col("p_size"))))
    given = t.part.select("p_partkey", "p_name", codes.alias("codes"))
    return quality.array_outside(given, "codes", list(fv.FIELDS_OF_STUDY)).select("p_partkey", "p_name")


@query(
    "dq_vector_stats",
    """SELECT count(*) AS n_vectors, CAST(min(len(embedding)) AS INT) AS min_dimension, CAST(max(len(embedding)) AS INT) AS max_dimension FROM embeddings""",
)
def dq_vector_stats(t):
    return quality.vector_stats(t.embeddings, "embedding")


@query("dq_vector_sample", "SELECT vec_id, CAST(len(embedding) AS INT) AS dimension, label FROM embeddings ORDER BY vec_id LIMIT 3")
def dq_vector_sample(t):
    return quality.vector_sample(t.embeddings, "vec_id", "embedding", ["label"])


@query(
    "run_stats",
    """SELECT 'records' AS name, CAST(count(*) AS DOUBLE) AS value FROM documents
       UNION ALL SELECT 'languages', count(DISTINCT lang) FROM documents
       UNION ALL SELECT 'longest', max(n_chars) FROM documents""",
)
def run_stats(t):
    return quality.run_stats(
        t.documents, {"records": F.count("*"), "languages": F.count_distinct("lang"), "longest": F.max("n_chars")}
    )


@query(
    "run_stats_written",
    """SELECT 'records' AS name, CAST(count(*) AS DOUBLE) AS value FROM documents
       UNION ALL SELECT 'characters', sum(n_chars) FROM documents
       UNION ALL SELECT 'longest', max(n_chars) FROM documents
       UNION ALL SELECT 'with_text', count(text) FROM documents""",
)
def run_stats_written(t):
    """The statistics of a run, taken while its rows are written."""
    measures = {"records": F.count(F.lit(1)), "characters": F.sum("n_chars"), "longest": F.max("n_chars"), "with_text": F.count("text")}
    seen = quality.observed_write(t.documents, fresh_path(t.spark, "run"), measures)
    return t.spark.createDataFrame([(n, None if v is None else float(v)) for n, v in seen.items()], "name string, value double")


_PROPS = T.StructType([T.StructField("k", T.IntegerType())])


def _cut(t):
    """Event properties, some cut short or of the wrong type."""
    kind = F.col("event_type")
    broken = F.when(kind == "error", F.regexp_replace("props", r"\}$", "")).when(kind == "signup", '{"k": "x"}').otherwise(F.col("props"))
    return t.events.select("event_id", broken.alias("props"))


@query(
    "quarantine_split",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events WHERE event_type NOT IN ('error', 'signup')""",
)
def quarantine_split(t):
    good, _ = quality.quarantine(_cut(t), "props", _PROPS)
    return quality.fail_if_none_succeeded(good).select("event_id", "k")


@query(
    "quarantine_counts",
    """SELECT CASE WHEN event_type IN ('error', 'signup') THEN 'failed' ELSE 'succeeded' END AS outcome, count(*) AS n_rows
       FROM events GROUP BY 1""",
)
def quarantine_counts(t):
    return quality.outcome_summary(quality.mark_outcome(_cut(t), "props", _PROPS))


@query(
    "quarantine_written",
    """WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE event_type IN ('error', 'signup')) AS bad FROM events)
       SELECT 'input' AS outcome, n AS n_rows, n AS n_stored FROM c UNION ALL SELECT 'failed', bad, bad FROM c UNION ALL SELECT 'succeeded', n - bad, n - bad FROM c""",
)
def quarantine_written(t):
    """Good and bad rows written in one pass that counts them, beside what the folders then hold."""
    path = fresh_path(t.spark, "outcomes")
    marked = quality.mark_outcome(_cut(t), "props", _PROPS).select("event_id", "props", "parsed.k", "outcome")
    seen = quality.write_outcomes(marked, path)
    stored = t.spark.read.schema("event_id long, props string, k int, outcome string").parquet(path)
    counts = t.spark.createDataFrame([(name, int(n)) for name, n in seen.items()], "outcome string, n_rows long")
    held = stored.select(F.explode(F.array(F.lit("input"), "outcome")).alias("outcome")).groupBy("outcome").agg(F.count("*").alias("n_stored"))
    return counts.join(held, "outcome", "left").withColumn("n_stored", F.coalesce("n_stored", F.lit(0)))
