"""Relational split, bridges, joins and upserts on the test tables."""

from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.catalog.registry import query
from edupipe.operators import graph, relational

_COUNTRIES_SQL = "CASE WHEN c_nationkey < 20 THEN ['NATION_' || c_nationkey, ' nation_' || (c_nationkey + 1) || ' ', 'NOWHERE'] ELSE [] END"


def _people_with_countries(t):
    key = F.col("c_nationkey")
    names = F.array(
        F.concat(F.lit("NATION_"), key.cast("string")),
        F.concat(F.lit(" nation_"), (key + 1).cast("string"), F.lit(" ")),
        F.lit("NOWHERE"),
    )
    return t.customer.select("c_custkey", F.when(key < 20, names).otherwise(F.array().cast("array<string>")).alias("countries"))


@query(
    "bridge_country",
    f"""SELECT DISTINCT c_custkey, n_nationkey AS country_id
        FROM (SELECT c_custkey, unnest({_COUNTRIES_SQL}) AS name FROM customer)
        JOIN nation ON lower(trim(name)) = lower(n_name)""",
)
def bridge_country(t):
    bridge = relational.bridge_to_dimension(_people_with_countries(t), "c_custkey", "countries", t.nation, "n_nationkey", "n_name")
    return bridge.withColumnRenamed("n_nationkey", "country_id")


@query(
    "bridge_field",
    """SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS field_code FROM part""",
)
def bridge_field(t):
    return relational.bridge_values(
        t.part.select("p_partkey", F.split("p_name", " ").alias("codes")), "p_partkey", "codes", "field_code"
    )


@query(
    "join_left_metadata",
    """SELECT d.doc_id, d.lang, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic
       FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def join_left_metadata(t):
    labels = t.labels.withColumnRenamed("doc_id", "labelled_id")
    joined = relational.enrich(t.documents.select("doc_id", "lang"), labels, "doc_id", "labelled_id")
    return joined.select("doc_id", "lang", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("quality", "toxic")])


def _finished(t):
    return t.orders.where("o_orderstatus = 'F'")


@query("join_semi", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def join_semi(t):
    return relational.having_any(t.customer.select("c_custkey", "c_name"), "c_custkey", _finished(t), "o_custkey")


@query("join_anti", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def join_anti(t):
    return relational.having_none(t.customer.select("c_custkey", "c_name"), "c_custkey", _finished(t), "o_custkey")


@query(
    "person_status",
    """SELECT c_custkey, coalesce(s, '-') AS scholarship_id, CASE WHEN s IS NULL THEN 'user' ELSE 'alumni' END AS status
       FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS s FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey""",
)
def person_status(t):
    marked = graph.person_status(t.customer.select("c_custkey"), "c_custkey", _finished(t), "o_custkey", "o_orderpriority")
    return marked.select("c_custkey", F.coalesce("scholarship_id", F.lit("-")).alias("scholarship_id"), "status")


def _split(t):
    """Orders as structured scholarships."""
    empty = F.lit(None).cast("string")
    codes = F.array(F.lpad((F.col("o_orderkey") % 11).cast("string"), 2, "0"))
    table = t.orders.select(
        F.col("o_orderkey").alias("scholarship_id"),
        F.col("o_orderpriority").alias("scholarship_name"),
        F.col("o_orderstatus").alias("status"),
        F.lower("o_orderpriority").alias("funding_category"),
        F.lit("master").alias("program_level"),
        F.lit("bachelor").alias("required_level"),
        F.lit(fv.PROGRAM_INTAKE).alias("intake"),
        F.col("o_totalprice").alias("gpa"),
        F.to_date("o_orderdate").alias("deadline"),
        codes.alias("fields_of_study_code"),
        *[empty.alias(c) for c in relational.INFO_COLUMNS if c not in (
            "scholarship_id", "scholarship_name", "gpa", "deadline", "fields_of_study_code")],
    )
    return relational.split_columns(table, relational.FILTER_COLUMNS, relational.INFO_COLUMNS)


@query(
    "split_filter_table",
    """SELECT o_orderkey AS scholarship_id, lower(o_orderpriority) AS funding_category, 'master' AS program_level,
              'bachelor' AS required_level, 'fall' AS intake, o_orderstatus AS status FROM orders""",
)
def split_filter_table(t):
    return _split(t)[0]


@query(
    "split_info_table",
    """SELECT o_orderkey AS scholarship_id, o_orderpriority AS scholarship_name, o_totalprice AS gpa,
              strftime(o_orderdate, '%Y-%m-%d') AS deadline, lpad(CAST(o_orderkey % 11 AS VARCHAR), 2, '0') AS codes FROM orders""",
)
def split_info_table(t):
    info = _split(t)[1]
    return info.select(
        "scholarship_id", "scholarship_name", "gpa", F.date_format("deadline", "yyyy-MM-dd").alias("deadline"),
        F.array_join("fields_of_study_code", ",").alias("codes"),
    )


@query(
    "cascade_delete",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""",
)
def cascade_delete(t):
    left = relational.cascade_delete(t.lineitem, "l_orderkey", t.orders.where("o_orderstatus = 'P'"), "o_orderkey")
    return left.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query(
    "upsert_insert_if_absent",
    """SELECT o_custkey AS person, o_orderkey AS first_order FROM orders WHERE o_orderpriority = '1-URGENT'
         QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1
       UNION ALL
       SELECT o_custkey, min(o_orderkey) FROM orders
       WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') GROUP BY 1""",
)
def upsert_insert_if_absent(t):
    incoming = t.orders.select(F.col("o_custkey").alias("person"), F.col("o_orderkey").alias("first_order"))
    target = (
        t.orders.where("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("person"))
        .agg(F.min("o_orderkey").alias("first_order"))
    )
    return relational.insert_if_absent(target, incoming, "person", [F.col("first_order")])


@query(
    "merge_people",
    """SELECT coalesce(c.c_custkey, s.s_suppkey) AS person, coalesce(s.s_name, c.c_name) AS name,
              CASE WHEN s.s_suppkey IS NOT NULL THEN CASE WHEN s.s_nationkey < 5 THEN -1 ELSE s.s_nationkey END ELSE c.c_nationkey END AS country,
              coalesce(c.c_mktsegment, '-') AS plan, CASE WHEN s.s_suppkey IS NULL THEN '-' ELSE 'alumni' END AS status
       FROM customer c FULL JOIN supplier s ON s.s_suppkey = c.c_custkey""",
)
def merge_people(t):
    users = t.customer.select(
        F.col("c_custkey").alias("person"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("country"),
        F.col("c_mktsegment").alias("plan"),
    )
    alumni = t.supplier.select(
        F.col("s_suppkey").alias("person"), F.col("s_name").alias("name"),
        F.when(F.col("s_nationkey") >= 5, F.col("s_nationkey")).alias("country"), F.lit("alumni").alias("status"),
    )
    merged = relational.merge_records([users, alumni], "person", [[F.col("name")], [F.col("name")]])
    return merged.select(
        "person", "name", F.coalesce("country", F.lit(-1)).alias("country"),
        *[F.coalesce(c, F.lit("-")).alias(c) for c in ("plan", "status")],
    )
