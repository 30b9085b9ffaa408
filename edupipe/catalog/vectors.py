"""Vector search on the test embeddings; an item is open when its label is even."""

from pyspark.sql import functions as F

from edupipe.catalog.registry import query
from edupipe.operators import vectors

_SCORE = "list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[]))"


def _nearest_sql(condition, k):
    return f"""SELECT v.vec_id, round({_SCORE}, 6) AS score FROM embeddings v JOIN embeddings q ON q.vec_id = 7 AND v.vec_id <> 7
               WHERE {condition} ORDER BY {_SCORE} DESC, v.vec_id LIMIT {k}"""


def _rounded(df):
    return df.withColumn("score", F.round("score", 6))


@query("vector_topk_item", _nearest_sql("v.label % 2 = 0", 5))
def vector_topk_item(t):
    return _rounded(vectors.top_k(t.embeddings, "vec_id", "embedding", 7, 5, F.col("label") % 2 == 0))


@query("vector_topk_same_class", _nearest_sql("v.label < 5", 6))
def vector_topk_same_class(t):
    return _rounded(vectors.top_k(t.embeddings, "vec_id", "embedding", 7, 6, F.col("label") < 5))


@query("vector_topk_conjunctive", _nearest_sql("v.label >= 5 AND v.label % 3 = 0", 6))
def vector_topk_conjunctive(t):
    alumni = (F.col("label") >= 5) & (F.col("label") % 3 == 0)
    return _rounded(vectors.top_k(t.embeddings, "vec_id", "embedding", 7, 6, alumni))


@query("vector_lookup", "SELECT vec_id, label, len(embedding)::INT AS dimension, round(embedding[1]::DOUBLE, 6) AS first FROM embeddings WHERE vec_id = 7")
def vector_lookup(t):
    found = vectors.lookup(t.embeddings, "vec_id", 7)
    return found.select(
        "vec_id", "label", F.size("embedding").alias("dimension"), F.round(F.col("embedding")[0].cast("double"), 6).alias("first")
    )


_KNN_SQL = f"""SELECT vec_id, recommended_id, round(score, 6) AS score FROM (
      SELECT q.vec_id, v.vec_id AS recommended_id, {_SCORE} AS score FROM embeddings q JOIN embeddings v ON v.vec_id <> q.vec_id {{}})
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(score, 12) DESC, recommended_id) <= 5"""


@query("vector_knn_table", _KNN_SQL.format(""))
def vector_knn_table(t):
    return _rounded(vectors.knn_table(t.embeddings, "vec_id", "embedding", 5))


@query("vector_knn_open", _KNN_SQL.format("WHERE v.label % 2 = 0"))
def vector_knn_open(t):
    open_items = t.embeddings.where("label % 2 = 0")
    return _rounded(vectors.knn_table(open_items, "vec_id", "embedding", 5, queries=t.embeddings, block_rows=256))
