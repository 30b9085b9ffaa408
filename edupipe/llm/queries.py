"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edupipe.llm.cross_tokenizer import alignment
from edupipe.llm.decontaminate import contamination
from edupipe.llm.exact_dedup import exact_copies
from edupipe.llm.filter_audit import filter_audit
from edupipe.llm.language_id import identify
from edupipe.llm.line_dedup import line_dedup
from edupipe.llm.main_text import extract
from edupipe.llm.ngram_jaccard import near_duplicates
from edupipe.llm.packing import pack_documents
from edupipe.llm.repeated_bytes import removals
from edupipe.llm.simhash import simhash_duplicates
from edupipe.llm.token_counts import token_counts
from edupipe.llm.token_files import read_token_files, write_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

END_ID = 2


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query("op1_ngram_jaccard")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "class_id")


@query("op2_pack")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op4_exact_dedup", r"""
WITH normal AS (
  SELECT doc_id, coalesce(length(text), 0) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents
), ranked AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY body ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY body) AS group_size
  FROM normal
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies(table(spark, sf_dir, "documents"))


@query("op5_decontaminate")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    read = contamination(docs, table(spark, sf_dir, "benchmark"))
    return read.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("row.doc_id", "held_out", "lang_pred", "score")


@query("op7_main_text")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


@query("op8_token_files")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), END_ID)
    read = read_token_files(spark, parts)
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return read.select("doc_id", "start", n_tokens, F.crc32("ids").alias("ids_crc32"))


@query("op9_repeated_bytes")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = removals(table(spark, sf_dir, "documents"))
    outcome = (F.col("n_bytes") - F.col("n_removed")).alias("n_kept"), (F.col("n_removed") > 0).alias("has_repeats")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *outcome, "starts", "stops")


@query("op10_line_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select(
        "row.doc_id", "n_lines", "n_removed", "n_runs", "n_chunks", F.length("row.text").cast("long").alias("n_chars_left"),
        F.sha2(F.coalesce("row.text", F.lit("")).cast("binary"), 256).alias("left_sha256"),
    )


@query("op11_cross_tokenizer")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment(table(spark, sf_dir, "documents"), *paths)


@query("op12_simhash")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(table(spark, sf_dir, "documents")).drop("dk")


@query("op13_filter_audit", r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), failing AS (
  SELECT doc_id, part, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
         100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body) AS c,
         regexp_matches(body, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false) AS e
  FROM texts
), marks AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), masks AS (
  SELECT part, map {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS fails, a::int + b::int + c::int + d::int + e::int AS n_fails,
         coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM failing LEFT JOIN marks USING (doc_id) GROUP BY ALL
), letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')), orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), outcomes AS (
  SELECT part, filter_order, step, filter_order[step] AS f, fails[filter_order[step]] AS failing,
         len(list_filter(range(1, step), lambda i: fails[filter_order[i]])) > 0 AS gone, n_fails, good, toxic, n
  FROM masks, orders, (SELECT unnest(range(1, 6)) AS step)
), summed AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND failing THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failing AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND failing AND good THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND failing AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM outcomes GROUP BY ALL
)
SELECT part, filter_order, step::int AS step, kept::bigint AS kept, removed::bigint AS removed,
       redundant::bigint AS redundant, unique_fails::bigint AS unique_fails, good_lost::bigint AS good_lost,
       toxic_lost::bigint AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::bigint AS shapley
FROM summed
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
