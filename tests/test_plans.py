"""What the physical plans must and must not hold."""

import pytest
from conftest import FOLDER
from helpers import plan_of

from edupipe.catalog import QUERIES

KEEPS_ONE_PER_KEY = ["dedupe_keyed", "keep_highest_rank", "keep_latest", "keep_longest", "latest_per_source"]
STAYS_IN_ITS_ROW = ["nested_dedupe", "nested_keep_highest", "nested_keep_latest", "nested_keep_longest", "nested_transform", "extract_section", "extract_urls", "link_counts"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_row_at_a_time_python(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "SinglePartition, REPARTITION"):
        assert bad not in plan


@pytest.mark.parametrize("name", KEEPS_ONE_PER_KEY)
def test_rows_per_key_are_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan_of(QUERIES[name](spark, FOLDER))


@pytest.mark.parametrize("name", STAYS_IN_ITS_ROW)
def test_array_and_text_work_needs_no_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "Exchange" not in plan



def test_semi_and_anti_joins_read_their_rows_once_and_split_hot_keys(spark):
    """Plain joins: one scan of the rows, and Spark splits a key that holds two fifths of them."""
    from pyspark.sql import functions as F

    from edupipe.operators import relational

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        hot = F.when(F.col("id") % 5 < 2, F.lit(7)).otherwise(F.col("id"))
        rows = spark.range(0, 60_000, 1, 6).select(hot.alias("k"), F.xxhash64("id").alias("x"))
        other = spark.range(0, 50_000, 1, 6).select(F.col("id").alias("o"))
        for joined, n in ((relational.having_any(rows, "k", other, "o"), 54_000), (relational.having_none(rows, "k", other, "o"), 6_000)):
            assert len(joined.collect()) == n
            plan = plan_of(joined)
            assert "skew=true" in plan
            assert plan[: plan.index("== Initial Plan ==")].count("Range (") == 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
