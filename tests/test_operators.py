import pytest
from helpers import tuples
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edupipe import fixed_values as fv
from edupipe.operators import dedupe, filters, graph, nested, quality, recommend, relational

# --- filters ------------------------------------------------------------------


def test_drop_placeholders_drops_nulls_too(spark):
    df = spark.createDataFrame([("a", "x"), ("N/A", "x"), ("a", None), ("", "x"), ("unknown", "x")], "n string, c string")
    assert tuples(filters.drop_placeholders(df, ["n", "c"])) == [("a", "x"), ("unknown", "x")]


def test_retention_and_recency(spark):
    df = spark.sql("SELECT i, CAST(t AS timestamp) t FROM VALUES (1, '2024-01-02 00:00:00'), (2, '2024-01-01 23:00:00'), (3, '2024-01-01 00:00:00'), (4, NULL) v(i, t)")
    as_of = F.lit("2024-01-02 00:00:00").cast("timestamp")
    assert tuples(filters.recent(df, "t", as_of, "1 hour"), "i") == [(1,), (2,)]
    assert tuples(filters.within_retention(df, "t", as_of, "1 hour"), "i") == [(1,), (2,), (4,)]


def test_expired_folders(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-08",), ("2024-01-09",), ("latest",), (None,)], "f string")
    assert tuples(filters.expired_folders(df, "f", F.lit("2024-01-16").cast("date"), 7)) == [("2024-01-01",), ("2024-01-08",)]


def test_links_with_fragment_go_and_nulls_stay(spark):
    df = spark.createDataFrame([("http://a/#x",), ("http://a",), (None,)], "l string")
    assert tuples(filters.drop_containing(df, "l", "/#")) == [("http://a",), (None,)]


def test_contract(spark):
    df = spark.range(3)
    with pytest.raises(ValueError, match="missing columns: x, y"):
        filters.require_columns(df, ["id", "x", "y"])
    with pytest.raises(ValueError, match="people is empty"):
        filters.require_rows(df.where("id < 0"), "people")
    assert filters.require_rows(df) is df


def test_hash_split_does_not_depend_on_partitions(spark):
    df = spark.range(1000)
    parts = [tuples(filters.split_by_hash(d, "id", 10, 9, ("a", "b"))) for d in (df.repartition(7), df.coalesce(1))]
    assert parts[0] == parts[1]
    assert 850 < sum(p == "a" for _, p in parts[0]) < 950


# --- one row per key ------------------------------------------------------------


def test_best_per_key_with_nulls_and_ties(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", None, 4), (None, 1, 5), (None, 2, 6)], "k string, v int, i int")
    assert tuples(dedupe.latest(df, ["k"], "v", [F.asc("i")]), "k", "i") == sorted([("a", 2), ("b", 4), (None, 6)], key=repr)


def test_highest_rank_puts_unknown_levels_last(spark):
    df = spark.createDataFrame([("a", "odd"), ("a", "beginner"), ("b", None)], "k string, l string")
    assert tuples(dedupe.highest_rank(df, ["k"], "l", fv.LANGUAGE_RANK, [F.asc("l")])) == [("a", "beginner"), ("b", None)]


def test_collapse_to_list(spark):
    df = spark.createDataFrame([("n", "b", "t2"), ("n", "a", "t1"), ("n", "b", "t0"), (None, "c", "t")], "name string, o string, u string")
    got = dedupe.collapse_to_list(df, ["name"], "o", "os", ["u"], ["u"])
    assert {r["name"]: (r["os"], r["u"]) for r in got.collect()} == {"n": (["a", "b"], "t0"), None: (["c"], "t")}


def test_snippets_make_one_payload(spark):
    df = spark.createDataFrame([("p", i, f"t{i}") for i in range(2500)] + [(None, 0, "n")], "k string, i long, t string").repartition(3)
    got = tuples(dedupe.collect_snippets(df, ["k"], "i", "t"), "k", "payload")
    assert sorted(got, key=repr) == sorted([("p", "\n".join(f"t{i}" for i in range(2500))), (None, "n")], key=repr)


def test_counts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("a", "x"), (None, "y")], "k string, v string")
    assert tuples(dedupe.count_back(df, ["k"], "v", "n")) == sorted([("a", "x", 2), ("a", "x", 2), ("a", None, 2), (None, "y", 1)], key=repr)
    assert tuples(dedupe.group_counts(df, ["k"])) == [(4, 2, 2)]
    assert tuples(dedupe.group_counts(df.where("false"), ["k"])) == [(0, 0, 0)]


# --- arrays across rows ---------------------------------------------------------


def test_explode_keeps_people_without_elements(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "i int, a array<string>")
    assert tuples(nested.explode_keep_empty(df, "a", "x")) == sorted([(1, "a"), (1, "b"), (2, None), (3, None)], key=repr)


def test_merge_same_key(spark):
    df = spark.createDataFrame(
        [(None, "b", 1, [("x", 1)]), (None, "a", None, [("x", 3), ("y", None)]), ("e", "c", 2, None)],
        "email string, name string, age int, s array<struct<n:string,v:int>>",
    )
    got = nested.merge_same_key(df, "email", {"s": ("n", ("v",))}, ["name", "age"], [F.col("name")])
    rows = {r["email"]: (r["name"], r["age"], r["s"] and [tuple(x) for x in r["s"]]) for r in got.collect()}
    assert rows == {None: ("a", 1, [("x", 3), ("y", None)]), "e": ("c", 2, None)}


# --- relational -----------------------------------------------------------------


def test_bridge(spark):
    df = spark.createDataFrame([("s", [" Germany", "germany", "Nowhere", None]), ("t", [])], "id string, c array<string>")
    dim = spark.createDataFrame([(1, "Germany"), (2, "Spain")], "country_id int, name string")
    assert tuples(relational.bridge_to_dimension(df, "id", "c", dim, "country_id", "name")) == [("s", 1)]
    assert tuples(relational.bridge_values(df.where("id = 's'"), "id", "c", "x")) == sorted(
        [("s", " Germany"), ("s", "germany"), ("s", "Nowhere"), ("s", None)], key=repr
    )


def test_insert_if_absent(spark):
    schema = "name string, id int"
    target = spark.createDataFrame([("a", 1)], schema)
    incoming = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2)], schema)
    got = relational.insert_if_absent(target, incoming, "name", [F.col("id")])
    assert tuples(got) == [("a", 1), ("b", 2)]
    assert tuples(relational.insert_if_absent(target.where("false"), incoming, "name", [F.col("id")])) == [("a", 9), ("b", 2)]


def test_merge_records_overwrites_only_what_a_source_has(spark):
    users = spark.createDataFrame([("e", "old", 1, "p"), ("e", "new", 2, "q"), ("f", "u", 1, None)], "email string, name string, n int, plan string")
    alumni = spark.createDataFrame([("e", None, 1, "alumni")], "email string, name string, n int, status string")
    got = relational.merge_records([users, alumni], "email", [[F.col("n")], [F.col("n")]])
    assert tuples(got, "email", "name", "plan", "status") == sorted([("e", None, "q", "alumni"), ("f", "u", None, None)], key=repr)


def test_cascade_delete(spark):
    children = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    deleted = spark.createDataFrame([(1,), (1,), (7,)], "k int")
    assert tuples(relational.cascade_delete(children, "k", deleted, "k")) == sorted([(2, "y"), (None, "z")], key=repr)


# --- quality --------------------------------------------------------------------


def test_constraint_checks(spark):
    df = spark.createDataFrame([("a", 1, ["00"]), ("a", None, None), ("b", 9, ["00", "77"]), (None, 2, [])], "k string, p int, c array<string>")
    parents = spark.createDataFrame([(1,), (2,)], "p int")
    assert tuples(quality.duplicate_keys(df, ["k"])) == [("a", 2)]
    assert tuples(quality.orphans(df, "p", parents, "p"), "p") == [(9,)]
    assert tuples(quality.array_outside(df, "c", list(fv.FIELDS_OF_STUDY)), "k") == [("b",)]
    assert tuples(quality.outside_accepted(df, "k", ["a"]), "k") == sorted([("b",), (None,)], key=repr)


def test_quarantine(spark):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, '{"k": "x"}'), (3, '{"k":'), (4, None), (5, "{}")], "i int, j string")
    good, bad = quality.quarantine(df, "j", schema)
    assert tuples(good, "i", "k") == sorted([(1, 5), (5, None)], key=repr)
    assert tuples(bad, "i") == [(2,), (3,), (4,)]
    assert tuples(quality.outcome_summary(quality.mark_outcome(df, "j", schema))) == [("failed", 3), ("succeeded", 2)]
    with pytest.raises(RuntimeError):
        quality.fail_if_none_succeeded(good.where("false"))


# --- graph ----------------------------------------------------------------------


def _edges(spark, rows):
    return spark.createDataFrame(rows, "src string, type string, dst string")


def test_upserts(spark):
    df = spark.createDataFrame([(" a ", "x", 1), ("a", "y", 2), (None, "z", 3)], "k string, p string, n int")
    assert tuples(graph.upsert_nodes(df, "Person", "k", ["p"], [F.col("n")])) == [("Person", "a", "y")]
    rows = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("a", None, 3), (None, "x", 4)], "s string, d string, n int")
    assert tuples(graph.upsert_edges(rows, "T", "s", "d", ["n"], [F.col("n")])) == [("a", "T", "x", 2)]


def test_upserted_nodes_are_unique(spark):
    df = spark.createDataFrame([("a", 1), (" a", 2), ("b", 3)], "k string, n int")
    nodes = graph.upsert_nodes(df, "Skill", "k")
    assert graph.repeated_nodes(nodes).count() == 0
    assert tuples(graph.repeated_nodes(nodes.union(nodes))) == [("Skill", "a", 2), ("Skill", "b", 2)]


def test_common_neighbours(spark):
    edges = _edges(spark, [
        ("t", "HAS_SKILL", "py"), ("t", "SPEAKS", "en"), ("t", "LIVES_IN", "de"),
        ("a", "HAS_SKILL", "py"), ("a", "SPEAKS", "en"), ("a", "LIVES_IN", "de"), ("b", "HAS_HONOR", "py"), ("c", "HAS_SKILL", "py"),
    ])
    holders = _edges(spark, [("a", "HAS_SCHOLARSHIP", "s"), ("b", "HAS_SCHOLARSHIP", "s"), ("c", "HAS_SCHOLARSHIP", "other")])
    assert [tuple(r) for r in graph.common_neighbours(edges, holders, "t", "s").collect()] == [("a", 2), ("b", 0)]
    assert graph.common_neighbours(edges, holders, "c", "s").count() == 0  # the target holds a scholarship


def test_profile_similarity(spark):
    edges = _edges(spark, [("t", "HAS_SKILL", "py"), ("t", "LIVES_IN", "de"), ("a", "HAS_SKILL", "py"), ("b", "LIVES_IN", "de"), ("c", "HAS_SKILL", "go")])
    got = [(r["person"], round(r["score"], 6)) for r in graph.profile_similarity(edges, "t", 6).collect()]
    assert got == [("a", round(4 / (2 * 5**0.5), 6)), ("b", round(1 / 5**0.5, 6))]


def test_person_in_two_countries_counts_in_both(spark):
    lives = _edges(spark, [("a", "LIVES_IN", "de"), ("a", "LIVES_IN", "fr"), ("b", "LIVES_IN", "de")])
    assert [tuple(r) for r in graph.top_targets(lives, 5, "c", "n").collect()] == [("de", 2), ("fr", 1)]
    skills = _edges(spark, [("a", "HAS_SKILL", "py"), ("a", "HAS_SKILL", "go"), ("b", "HAS_SKILL", "go")])
    assert [tuple(r) for r in graph.top_targets_for_item(skills, "py", lives, 5, "c", "n").collect()] == [("de", 1), ("fr", 1)]
    assert [tuple(r) for r in graph.related_items(skills, "py", 5, "s", "n").collect()] == [("go", 1)]


# --- recommendations --------------------------------------------------------------


def _recs(spark):
    return spark.sql("""SELECT u user_id, s source_id, r recommended_id, x score, CAST(t AS timestamp) timestamp, CAST(c AS boolean) clicked FROM VALUES
        ('u', 's1', 'a', 0.5D, '2024-01-01 00:00:00', false), ('u', 's1', 'b', 0.9D, '2024-01-01 00:00:00', false),
        ('u', 's2', 'a', 0.1D, '2024-01-01 01:00:00', NULL), ('w', 's1', 'a', 0.4D, '2024-01-02 00:00:00', true) v(u, s, r, x, t, c)""")


def test_serving(spark):
    recs = _recs(spark)
    assert tuples(recommend.latest_per_source(recs, "u"), "source_id", "recommended_id") == [("s1", "b"), ("s2", "a")]
    assert [r["user_id"] for r in recommend.newest_for_item(recs, "s1").collect()] == ["w", "u", "u"]
    assert tuples(recommend.newest_for_item(recs, "s1", "u"), "recommended_id") == [("a",), ("b",)]
    served = recommend.served(recs, F.lit("2024-01-01 01:30:00").cast("timestamp"))
    assert tuples(served) == [
        ("recommendations:general:s1", 3, True), ("recommendations:general:s2", 1, True),
        ("recommendations:u:s1", 2, False), ("recommendations:u:s2", 1, True), ("recommendations:w:s1", 1, True),
    ]


def test_click_feedback(spark):
    clicks = spark.createDataFrame([("u", "a"), ("u", "a"), ("u", "zzz")], "user_id string, recommended_id string")
    got = tuples(recommend.mark_clicked(_recs(spark), clicks), "user_id", "source_id", "recommended_id", "clicked")
    assert got == [("u", "s1", "a", True), ("u", "s1", "b", False), ("u", "s2", "a", True), ("w", "s1", "a", True)]
