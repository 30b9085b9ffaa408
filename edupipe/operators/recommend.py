"""Reading, serving and updating recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.functions.text import composite_key
from edupipe.operators.dedupe import best_per_key
from edupipe.session import materialise


def latest_per_source(recs: DataFrame, user, n: int = fv.TOP_ITEMS) -> DataFrame:
    """For one user the newest row of every source, the first ``n`` sources."""
    newest = best_per_key(
        recs.where(F.col("user_id") == user),
        ["source_id"],
        [F.desc("timestamp"), F.desc("score"), F.asc("recommended_id")],
    )
    return newest.orderBy("source_id").limit(n)


def newest_for_item(recs: DataFrame, source, user=None, n: int = fv.TOP_ITEMS) -> DataFrame:
    """The newest rows of a source, for one user if given (ties: score, then id)."""
    rows = recs.where(F.col("source_id") == source)
    if user is not None:
        rows = rows.where(F.col("user_id") == user)
    return rows.orderBy(F.desc("timestamp"), F.desc("score"), "recommended_id", "user_id").limit(n)


def recommendation_rows(hits: DataFrame, metadata: DataFrame, item: str) -> DataFrame:
    """Hits with the recommended item's metadata where known."""
    return hits.join(metadata, F.col("recommended_id") == F.col(item), "left").drop(item)


def served(recs: DataFrame, as_of: Column, ttl_seconds: int = fv.CACHE_TTL_SECONDS) -> DataFrame:
    """One row per cached answer: key, size and whether it would still come from the cache.

    A user's answer is keyed by user and source; the answer without a user
    (``general``) by source alone.
    """
    keys = [composite_key(fv.CACHE_PREFIX, user, F.col("source_id")) for user in (F.col("user_id"), F.lit(fv.GENERAL_USER))]
    age = F.unix_micros(as_of) - F.unix_micros(F.max("timestamp"))
    return (
        recs.select(F.explode(F.array(*keys)).alias("cache_key"), "timestamp")
        .groupBy("cache_key")
        .agg(F.count("*").alias("n_rows"), age.alias("age"))
        .select("cache_key", "n_rows", (F.col("age") < ttl_seconds * 1_000_000).alias("is_cached"))
    )


def served_rows(
    recs: DataFrame, entries: DataFrame, metadata: DataFrame, item: str, as_of: Column,
    ttl_seconds: int = fv.CACHE_TTL_SECONDS, n: int = fv.TOP_ITEMS,
) -> DataFrame:
    """The answer to every request key: cache_key, place, recommended_id, score, is_cached and the item's metadata.

    entries(cache_key, stored_at, answer: array of (recommended_id, score) in order) are the
    cached answers.  One that is still alive is served as it is, at most ``n`` rows;
    otherwise the newest ``n`` rows of the key (ties: score, then id).
    """
    age = F.unix_micros(as_of) - F.unix_micros("stored_at")
    alive = entries.where(age < ttl_seconds * 1_000_000)
    cached = alive.select("cache_key", F.posexplode(F.slice("answer", 1, n)).alias("at", "a")).select(
        "cache_key", (F.col("at") + 1).alias("place"), "a.recommended_id", "a.score", F.lit(True).alias("is_cached")
    )
    keys = [composite_key(fv.CACHE_PREFIX, user, F.col("source_id")) for user in (F.col("user_id"), F.lit(fv.GENERAL_USER))]
    keyed = recs.select(F.explode(F.array(*keys)).alias("cache_key"), "timestamp", "score", "recommended_id")
    place = F.row_number().over(
        Window.partitionBy("cache_key").orderBy(F.desc("timestamp"), F.desc("score"), F.asc("recommended_id"))
    )
    newest = keyed.withColumn("place", place).where(F.col("place") <= n).join(alive.select("cache_key"), "cache_key", "left_anti")
    fresh = newest.select("cache_key", "place", "recommended_id", "score", F.lit(False).alias("is_cached"))
    return recommendation_rows(cached.unionByName(fresh), metadata, item)


def cache_audit(entries: DataFrame, as_of: Column, ttl_seconds: int = fv.CACHE_TTL_SECONDS) -> DataFrame:
    """Live entries with their remaining whole seconds and number of recommendations.

    entries(cache_key, stored_at, n_recommendations)
    """
    elapsed = F.floor((F.unix_micros(as_of) - F.unix_micros("stored_at")) / 1_000_000)
    left = F.lit(ttl_seconds) - elapsed
    return entries.select("cache_key", left.cast("long").alias("ttl_left"), "n_recommendations").where(
        (F.col("ttl_left") > 0) & (F.col("ttl_left") <= ttl_seconds)
    )


def mark_clicked(recs: DataFrame, clicks: DataFrame) -> DataFrame:
    """Set ``clicked`` on every row whose (user, recommended item) was clicked.

    Clicks are made distinct and written once, so that the join reads a plain side
    and Spark can split a hot pair; a row marked earlier stays marked.
    """
    seen = materialise(clicks.select("user_id", "recommended_id").distinct(), "clicked").withColumn("__seen", F.lit(True))
    return (
        recs.join(seen, ["user_id", "recommended_id"], "left")
        .withColumn("clicked", F.coalesce("clicked", F.lit(False)) | F.coalesce("__seen", F.lit(False)))
        .drop("__seen")
        .select(*recs.columns)
    )
