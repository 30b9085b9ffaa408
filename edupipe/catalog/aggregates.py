"""Grouping, duplicate removal and best-row-per-key on the test tables."""

from pyspark.sql import functions as F

from edupipe.catalog.registry import query
from edupipe.operators import dedupe, filters

_LINE = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query(
    "group_collapse_to_list",
    f"""SELECT l.l_partkey, l.l_suppkey, l.flags, f.l_linestatus, f.l_quantity
        FROM (SELECT l_partkey, l_suppkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags
              FROM lineitem GROUP BY 1, 2) l
        JOIN (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY {', '.join(_LINE)}) = 1) f
          ON f.l_partkey = l.l_partkey AND f.l_suppkey = l.l_suppkey""",
)
def group_collapse_to_list(t):
    grouped = dedupe.collapse_to_list(
        t.lineitem, ["l_partkey", "l_suppkey"], "l_returnflag", "flags", ["l_linestatus", "l_quantity"], _LINE
    )
    return grouped.withColumn("flags", F.array_join("flags", ","))


@query(
    "collect_snippets",
    "SELECT conv_id, string_agg(text, chr(10) ORDER BY turn, text) AS payload FROM conversations GROUP BY 1",
)
def collect_snippets(t):
    return dedupe.collect_snippets(t.conversations, ["conv_id"], "turn", "text")


@query("dedupe_rows", "SELECT DISTINCT text, lang FROM documents")
def dedupe_rows(t):
    return t.documents.select("text", "lang").distinct()


@query(
    "dedupe_keyed",
    """SELECT user_id, event_type, event_id, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
)
def dedupe_keyed(t):
    first = dedupe.best_per_key(t.events, ["user_id", "event_type"], [F.asc("ts"), F.asc("event_id")])
    return first.select("user_id", "event_type", "event_id", "value")


@query(
    "dedupe_stats",
    """SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS n_groups,
              count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS n_duplicates FROM lineitem""",
)
def dedupe_stats(t):
    return dedupe.group_counts(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "keep_highest_rank",
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
         ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1 ELSE 0 END DESC,
                  o_totalprice DESC, o_orderkey) = 1""",
)
def keep_highest_rank(t):
    ranks = {"3-MEDIUM": 1, "2-HIGH": 2, "1-URGENT": 3}
    best = dedupe.highest_rank(t.orders, ["o_custkey"], "o_orderpriority", ranks, [F.desc("o_totalprice"), F.asc("o_orderkey")])
    return best.select("o_custkey", "o_orderkey", "o_orderpriority")


@query(
    "keep_latest",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
         SELECT *, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS graduated FROM orders)
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY graduated DESC NULLS LAST, o_orderkey) = 1""",
)
def keep_latest(t):
    dated = t.orders.withColumn("graduated", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    return dedupe.latest(dated, ["o_custkey"], "graduated", [F.asc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "keep_longest",
    r"""SELECT p_type, p_name, p_partkey, p_brand FROM part QUALIFY row_number() OVER (PARTITION BY p_type, p_name
          ORDER BY TRY_CAST(nullif(regexp_extract(p_brand, '([0-9.]+)', 1), '') AS DOUBLE) DESC NULLS LAST, p_partkey) = 1""",
)
def keep_longest(t):
    best = dedupe.longest(t.part, ["p_type", "p_name"], "p_brand", [F.asc("p_partkey")])
    return best.select("p_type", "p_name", "p_partkey", "p_brand")


@query("preview_ordered", "SELECT p_partkey, p_name, p_type FROM part ORDER BY p_name, p_partkey LIMIT 5")
def preview_ordered(t):
    return t.part.select("p_partkey", "p_name", "p_type").orderBy("p_name", "p_partkey").limit(5)


@query(
    "group_count_back",
    """SELECT page_id, link, count(link) OVER (PARTITION BY page_id) AS num_subpages
       FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages)""",
)
def group_count_back(t):
    links = t.pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).alias("link"))
    return dedupe.count_back(links, ["page_id"], "link", "num_subpages")


@query("dataset_contract", "SELECT doc_id, lang FROM documents")
def dataset_contract(t):
    documents = filters.require_columns(t.documents, ["doc_id", "text", "lang"])
    return filters.require_rows(documents, "documents").select("doc_id", "lang")
