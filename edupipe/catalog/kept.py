"""Tables and indexes that are kept from run to run, on the test tables."""

from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.catalog.registry import query
from edupipe.operators import graph, similar, stored, vector_index
from edupipe.plans import shapes
from edupipe.session import fresh_path
from edupipe.sources import snapshots


@query(
    "graph_merge_nodes",
    """WITH last AS (SELECT o_custkey, max_by(o_orderpriority, (o_orderdate, o_orderkey)) AS priority FROM orders GROUP BY 1)
       SELECT 'Person' AS label, CAST(coalesce(c_custkey, o_custkey) AS VARCHAR) AS key, coalesce(priority, 'none') AS last_order
       FROM customer FULL JOIN last ON c_custkey = o_custkey""",
)
def graph_merge_nodes(t):
    """People from the customers, then what the orders say of them merged into the stored nodes."""
    path = fresh_path(t.spark, "nodes")
    people = t.customer.select(F.col("c_custkey").cast("string").alias("person"), F.lit("none").alias("last_order"))
    first = graph.upsert_nodes(people, "Person", "person", ["last_order"], [F.col("person")])
    stored.merge_rows(first, path, ["label", "key"], version=1)
    ordered = t.orders.select(F.col("o_custkey").cast("string").alias("person"), F.col("o_orderpriority").alias("last_order"), "o_orderdate", "o_orderkey")
    second = graph.upsert_nodes(ordered, "Person", "person", ["last_order"], [F.col("o_orderdate"), F.col("o_orderkey")])
    stored.merge_rows(second, path, ["label", "key"], version=2)
    return stored.read_stored(t.spark, path)


@query(
    "graph_merge_edges",
    """SELECT CAST(o_custkey AS BIGINT) AS src, 'ORDERED' AS type, o_orderpriority AS dst, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS last_key
       FROM orders GROUP BY ALL""",
)
def graph_merge_edges(t):
    """The edges of two runs, the later one merged first: the last writer wins in any order."""
    path = fresh_path(t.spark, "edges")
    rows = t.orders.select(F.col("o_custkey").cast("long").alias("person"), F.col("o_orderpriority").alias("item"), F.col("o_orderkey").alias("last_key"), "o_orderdate")
    day = F.unix_date(F.to_date("o_orderdate"))
    middle = rows.agg((F.min(day) + F.max(day)) / 2).scalar()
    order = [F.col("o_orderdate"), F.col("last_key")]
    for version, part in ((2, rows.where(day >= middle)), (1, rows.where(day < middle))):
        edges = graph.upsert_edges(part, "ORDERED", "person", "item", ["last_key"], order)
        stored.merge_rows(edges, path, ["src", "type", "dst"], version=version)
    return stored.read_stored(t.spark, path)


@query(
    "similar_people_all",
    """WITH e AS (SELECT DISTINCT o_custkey AS src, 'HAS_SKILL' AS type, l_partkey AS dst, 2 AS w FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                  UNION ALL SELECT DISTINCT c_custkey, 'LIVES_IN', c_nationkey, 1 FROM customer),
       norms AS (SELECT src, sum(w * w) AS n FROM e GROUP BY 1),
       dots AS (SELECT x.src, y.src AS other, sum(x.w * y.w) AS dot FROM e x JOIN e y ON y.type = x.type AND y.dst = x.dst AND y.src <> x.src GROUP BY 1, 2),
       scored AS (SELECT d.src, d.other, d.dot / sqrt(CAST(a.n * b.n AS DOUBLE)) AS score FROM dots d JOIN norms a ON a.src = d.src JOIN norms b ON b.src = d.other)
       SELECT CAST(src AS BIGINT) AS src, CAST(other AS BIGINT) AS other, round(score, 9) AS score FROM scored
       QUALIFY row_number() OVER (PARTITION BY src ORDER BY score DESC, other) <= 5""",
)
def similar_people_all(t):
    """The five most similar people of everybody, by what they bought and where they live."""
    rows = shapes.people_edges(t.customer, t.orders, t.lineitem)
    edges = graph.union_edges([graph.upsert_edges(rows[kind], kind, "person", "item") for kind in ("HAS_SKILL", "LIVES_IN")])
    return similar.most_similar(edges, 5).withColumn("score", F.round("score", 9))


@query(
    "vector_index_lookup",
    """WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 7)
       SELECT vec_id, label, round(score, 6) AS score FROM (
         SELECT vec_id, label, list_cosine_similarity(CAST(embedding AS DOUBLE[]), v) AS score FROM embeddings, q WHERE vec_id <> 7)
       ORDER BY round(score, 12) DESC, vec_id LIMIT 5""",
)
def vector_index_lookup(t):
    """A stored index of all vectors, which came in three parts; the five nearest of one."""
    path = fresh_path(t.spark, "index")
    least, most = t.embeddings.agg(F.min("vec_id"), F.max("vec_id")).first()
    third = ((most or 0) - (least or 0)) // 3 + 1
    part = F.floor((F.col("vec_id") - (least or 0)) / third)
    vector_index.create(t.embeddings.where(part == 0), "vec_id", "embedding", path, ["label"])
    for n in (1, 2):
        vector_index.insert(t.embeddings.where(part == n), "vec_id", "embedding", path, ["label"])
    wanted = t.embeddings.where("vec_id = 7").select("embedding").first()
    found, _ = vector_index.nearest(t.spark, path, list(wanted[0]), fv.TOP_ITEMS, without=7)
    return found.select(F.col("key").alias("vec_id"), "label", F.round("score", 6).alias("score"))


@query(
    "snapshot_tables",
    """SELECT 'customer' AS name, count(*) AS n_rows, sum(c_custkey)::BIGINT AS key_sum FROM customer
       UNION ALL SELECT 'orders', count(*), sum(o_orderkey)::BIGINT FROM orders
       UNION ALL SELECT 'part', count(*), sum(p_partkey)::BIGINT FROM part
       UNION ALL SELECT 'supplier', count(*), sum(s_suppkey)::BIGINT FROM supplier""",
)
def snapshot_tables(t):
    """Four tables published together, then a version that was stopped half way: the whole one is read."""
    folder = fresh_path(t.spark, "snapshot")
    keys = {"customer": "c_custkey", "orders": "o_orderkey", "part": "p_partkey", "supplier": "s_suppkey"}
    snapshots.publish(t.spark, {name: getattr(t, name) for name in keys}, folder)
    t.supplier.limit(0).write.parquet(f"{folder}/versions/2/supplier")
    tables = snapshots.read_snapshot(t.spark, folder)
    counted = [
        tables[name].agg(F.lit(name).alias("name"), F.count("*").alias("n_rows"), F.sum(key).cast("long").alias("key_sum"))
        for name, key in keys.items()
    ]
    return counted[0].union(counted[1]).union(counted[2]).union(counted[3])
