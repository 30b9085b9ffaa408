"""Cosine similarity: lookups, top-k for one vector, and the top-k table of all items."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edupipe import fixed_values as fv
from edupipe.operators.dedupe import best_per_key
from edupipe.session import materialise

# --- expressions -------------------------------------------------------------


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def unit(a: Column) -> Column:
    """The vector with length 1; null for a zero vector."""
    length = F.nullif(norm(a), F.lit(0.0))
    return F.when(length.isNotNull(), F.transform(a, lambda x: x.cast("double") / length))


def lookup(vectors: DataFrame, key: str, wanted) -> DataFrame:
    """The row of one id; no row when the id is unknown."""
    return vectors.where(F.col(key) == wanted)


def top_k(
    vectors: DataFrame, key: str, vector: str, wanted, k: int, condition: Column | None = None
) -> DataFrame:
    """The ``k`` nearest other vectors that meet ``condition`` (ties by key).

    The query vector enters as a scalar subquery, so this is one scan with a
    top-k, no join.  The item itself is left out before counting to ``k``.
    """
    query = vectors.where(F.col(key) == wanted).select(unit(F.col(vector)).alias("q")).scalar()
    rows = vectors.where(F.col(key) != wanted)
    if condition is not None:
        rows = rows.where(condition)
    score = F.try_divide(dot(F.col(vector), F.col("__q")), norm(F.col(vector)))
    return (
        rows.select(key, vector, query.alias("__q"))
        .select(F.col(key), score.alias("score"))
        .orderBy(F.desc_nulls_last("score"), key)
        .limit(k)
        .where("score is not null")  # after the limit: nulls sort last, and the score is computed once
    )


# --- top-k table of all items ------------------------------------------------
#
# Exact k-nearest-neighbour join with pivots (after Lu, Shen, Chen and Ooi,
# "Efficient Processing of k Nearest Neighbor Joins using MapReduce", 2012):
# every vector belongs to the cell of its nearest pivot, the triangle inequality
# bounds what a cell's vectors can be near to, and only cell pairs that may hold
# a neighbour meet, block by block.  On the unit sphere |a-b|^2 = 2 - 2 cos(a,b),
# so nearest by distance is nearest by cosine.  Cells are cut into blocks of
# bounded size, and blocks are dealt to tiles.  A task holds the queries of one tile,
# multiplies them with the corpus blocks of another and keeps k rows per query, so a vector is
# sent once per tile of the other side, not once per block.  There are about TILES tiles a
# side until a tile holds TILE_BYTES: so far what is sent grows as the input does.
#
# Copies: of equal vectors only the first k+1 ids can be anyone's neighbour, and
# one search answers for all of them, so a large group of copies costs one row.

BLOCK_ROWS = 2048
MAX_PIVOTS = 256
TILES = 16
TILE_BYTES = 32 << 20
_QUERY_ROWS = 512
_ROUNDED = 1e-11  # more than rounding a score to 12 digits moves it
_SLACK = 1e-5  # distances are computed in floating point


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of unit vectors, each held as the bytes of its doubles."""
    return np.frombuffer(b"".join(column.to_pylist())).reshape(len(column), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def _unit_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, u): vectors at length 1, as the bytes of their doubles; null and zero vectors
    have no direction and drop out."""
    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                m = values.reshape(batch.num_rows, -1)
                length = np.sqrt((m * m).sum(axis=1))
                some = length > 0
                units = pa.array([u.tobytes() for u in m[some] / length[some, None]], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("id").filter(pa.array(some)), units], ["id", "u"])

    id_type = df.schema[key].dataType.simpleString()
    given = df.where(F.size(vector) > 0).select(F.col(key).alias("id"), F.col(vector).alias("v"))
    return given.mapInArrow(scale, f"id {id_type}, u binary")


def _with_cells(units: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the nearest pivot (``cell``) and the distance to it (``radius``)."""
    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = _distances(_matrix(batch.column("u")), pivots)
                cell = d.argmin(axis=1)
                near = pa.array(d[np.arange(len(cell)), cell])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell, pa.int32()), near], [*batch.schema.names, "cell", "radius"]
                )

    if len(pivots) == 1:  # one cell; a computed value, so that joins on it stay equi joins
        return units.withColumns({"cell": F.pmod(F.xxhash64("id"), F.lit(1)).cast("int"), "radius": F.lit(0.0)})
    extra = [T.StructField("cell", T.IntegerType()), T.StructField("radius", T.DoubleType())]
    return units.mapInArrow(nearest, T.StructType([*units.schema.fields, *extra]))


def _cell_pairs(
    pivots: np.ndarray, reach: dict[int, float], outer: dict[int, float], inner: dict[int, float]
) -> list[tuple[int, int]]:
    """Cell pairs (query cell, corpus cell) in which a neighbour can lie.

    reach, outer: largest radius per query / corpus cell
    inner: radius that already holds enough neighbours, for corpus cells large enough
    """
    between = _distances(pivots, pivots)
    pairs = []
    for i, far in reach.items():
        bound = far + min((between[i, j] + r for j, r in inner.items()), default=np.inf)
        pairs += [(i, j) for j, r in outer.items() if between[i, j] - far - r <= bound + _SLACK]
    return pairs


def _cell_stats(cells: DataFrame) -> dict[int, tuple[int, float]]:
    """cell -> (vectors, largest radius); one row per pivot reaches the driver."""
    rows = cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("radius").alias("r")).collect()
    return {row["cell"]: (row["n"], row["r"]) for row in rows}


def _inner_radii(cells: DataFrame, enough: int) -> dict[int, float]:
    """cell -> radius that holds ``enough`` vectors, for cells that have as many."""
    near = best_per_key(cells.select("cell", "radius", "id"), ["cell"], [F.asc("radius"), F.asc("id")], enough)
    rows = near.groupBy("cell").agg(F.count("*").alias("n"), F.max("radius").alias("r")).collect()
    return {row["cell"]: row["r"] for row in rows if row["n"] == enough}


def _blocks(cells: DataFrame, parts: DataFrame, name: str) -> DataFrame:
    """One row per block (cell, part): ids ascending, and their vectors.

    ``parts`` says into how many blocks a cell is cut (at most MAX_PIVOTS rows).
    """
    cut = cells.join(F.broadcast(parts), "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    packed = F.sort_array(F.collect_list(F.struct("id", "u")))
    return (
        cut.groupBy("cell", "part")
        .agg(packed.alias("rows"))
        .select(
            F.col("cell").alias(f"{name}_cell"),
            F.col("part").alias(f"{name}_part"),
            F.col("rows.id").alias(f"{name}_ids"),
            F.col("rows.u").alias(f"{name}_units"),
        )
    )


def _tiles(stats: dict[int, tuple[int, float]], parts: dict[int, int], tile_rows: int) -> list[tuple[int, int, int]]:
    """(cell, part, tile): blocks that follow each other until a tile holds about ``tile_rows`` vectors."""
    out, tile, held = [], 0, 0
    for cell in sorted(stats):
        rows = -(-stats[cell][0] // parts[cell])
        for part in range(parts[cell]):
            if held and held + rows > tile_rows:
                tile, held = tile + 1, 0
            out.append((cell, part, tile))
            held += rows
    return out


class _Queries:
    """Some queries of one cell and their ``k`` best hits so far: of equal scores the lesser ids."""

    def __init__(self, ids: pa.Array, units: np.ndarray, k: int) -> None:
        self.ids, self.units, self.k = ids, units, k
        self.rows, self.scores, self.found = np.zeros(0, np.int64), np.zeros(0), None
        self.least = np.full(len(ids), -np.inf)  # the k-th best score of those that have k

    def meet(self, ids: pa.Array, units: np.ndarray) -> None:
        scores = self.units @ units.T
        least = self.least
        if scores.shape[1] > self.k and np.isneginf(least).any():
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        rows, columns = np.nonzero(scores >= (least - _ROUNDED)[:, None])
        if not len(rows):
            return
        found = ids.take(pa.array(columns))
        rows = np.concatenate([self.rows, rows])
        scores = np.concatenate([self.scores, np.round(scores[rows[len(self.rows):], columns], 12)])
        found = found if self.found is None else pa.concat_arrays([self.found, found])
        rank = np.empty(len(found), np.int64)
        rank[pc.sort_indices(found).to_numpy()] = np.arange(len(found))
        order = np.lexsort((rank, -scores, rows))
        starts = np.flatnonzero(np.diff(rows[order], prepend=-1))
        place = np.arange(len(order)) - np.repeat(starts, np.diff(starts, append=len(order)))
        kth = order[place == self.k - 1]
        self.least[rows[kth]] = scores[kth]
        kept = order[place < self.k]
        self.rows, self.scores, self.found = rows[kept], scores[kept], found.take(pa.array(kept))

    def hits(self) -> pa.RecordBatch | None:
        if self.found is not None:
            return pa.RecordBatch.from_arrays(
                [self.ids.take(pa.array(self.rows)), self.found, pa.array(self.scores)], ["id", "recommended_id", "score"]
            )


def _search(
    corpus: DataFrame, queries: DataFrame, pairs: list[tuple[int, int]],
    corpus_tiles: list[tuple[int, int, int]], query_tiles: list[tuple[int, int, int]], k: int,
) -> DataFrame:
    """(id, recommended_id, score) of the k best corpus rows of every query row.

    corpus, queries: blocks; pairs: the (query cell, corpus cell) to search; tiles: (cell, part, tile) of every
    block.  The blocks of both sides are sent to the pair of their tiles, so a crowded cell is the work of many tasks.  A
    task holds the queries of a tile and takes the corpus blocks one at a time.
    """
    spark, meeting = corpus.sparkSession, set(pairs)

    def sent(blocks: DataFrame, name: str, tiles: list, other: str, other_tiles: list, met: list[tuple[int, int]]) -> DataFrame:
        held: dict[int, set[int]] = {}
        for cell, _, tile in other_tiles:
            held.setdefault(cell, set()).add(tile)
        to: dict[int, set[int]] = {}
        for cell, far in met:
            to.setdefault(cell, set()).update(held[far])
        where = spark.createDataFrame(tiles, f"{name}_cell int, {name}_part long, {name}_tile int")
        others = spark.createDataFrame([(cell, sorted(t)) for cell, t in to.items()], f"{name}_cell int, others array<int>")
        placed = blocks.join(F.broadcast(where), [f"{name}_cell", f"{name}_part"]).join(F.broadcast(others), f"{name}_cell")
        return placed.select(
            f"{name}_tile", F.explode("others").alias(f"{other}_tile"), F.lit(name == "c").alias("corpus"),
            F.col(f"{name}_cell").alias("cell"), F.col(f"{name}_ids").alias("ids"), F.col(f"{name}_units").alias("units"),
        )

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, {}

        def answers() -> Iterator[pa.RecordBatch]:
            for chunks in held.values():
                yield from (h for h in (c.hits() for c in chunks) if h is not None)

        for batch in batches:
            q_tile, c_tile, corpus, cell = (batch.column(c).to_pylist() for c in ("q_tile", "c_tile", "corpus", "cell"))
            for r in range(batch.num_rows):
                if at != (q_tile[r], c_tile[r]):
                    yield from answers()
                    at, held = (q_tile[r], c_tile[r]), {}
                ids, units = batch.column("ids")[r].values, _matrix(batch.column("units")[r].values)
                if corpus[r]:
                    known = np.isfinite(units).all(axis=1)
                    if not known.all():
                        ids, units = ids.filter(pa.array(known)), units[known]
                    for q_cell, chunks in held.items():
                        if (q_cell, cell[r]) in meeting:
                            for chunk in chunks:
                                chunk.meet(ids, units)
                else:
                    ids = pa.concat_arrays([ids])
                    for first in range(0, len(ids), _QUERY_ROWS):
                        chunk = _Queries(ids.slice(first, _QUERY_ROWS), units[first:first + _QUERY_ROWS], k)
                        held.setdefault(cell[r], []).append(chunk)
        yield from answers()

    both = sent(queries, "q", query_tiles, "c", corpus_tiles, pairs).unionByName(
        sent(corpus, "c", corpus_tiles, "q", query_tiles, [(c, q) for q, c in pairs])
    )
    met = both.repartition("q_tile", "c_tile").sortWithinPartitions("q_tile", "c_tile", "corpus")
    id_type = queries.schema["q_ids"].dataType.elementType.simpleString()
    hits = met.mapInArrow(multiply, f"id {id_type}, recommended_id {id_type}, score double")
    return best_per_key(hits, ["id"], [F.desc("score"), F.asc("recommended_id")], k)


def knn_table(
    corpus: DataFrame,
    key: str,
    vector: str,
    k: int = fv.TOP_ITEMS,
    queries: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
    max_pivots: int = MAX_PIVOTS,
) -> DataFrame:
    """(key, recommended_id, score): the ``k`` nearest corpus items of every query item.

    Exact; ties by id.  ``queries`` defaults to the corpus; an item is never its
    own neighbour.  The driver holds the pivots and a few numbers per pivot.
    """
    enough = k + 1  # one of them may be the item itself
    # Written once: statistics, blocks and the answer all read what stands here.
    corpus_units = materialise(_unit_vectors(corpus, key, vector), "corpus-units")
    query_units = corpus_units if queries is None else materialise(_unit_vectors(queries, key, vector), "query-units")
    candidates = materialise(best_per_key(corpus_units, ["u"], [F.asc("id")], enough), "candidates")
    distinct = query_units.groupBy("u").agg(F.min("id").alias("id"))

    rows, width = candidates.agg(F.count("*"), F.coalesce(F.max(F.length("u")), F.lit(8))).first()
    wanted = min(max_pivots, max(1, -(-rows // block_rows)))
    sample = candidates.orderBy(F.xxhash64("id"), "id").limit(wanted)
    pivots = np.array([np.frombuffer(r["u"]) for r in sample.collect()]) if wanted > 1 else np.zeros((1, 1))
    corpus_cells = materialise(_with_cells(candidates, pivots), "corpus-cells")
    query_cells = materialise(_with_cells(distinct, pivots), "query-cells")
    corpus_stats = _cell_stats(corpus_cells)
    query_stats = corpus_stats if queries is None else _cell_stats(query_cells)
    inner = _inner_radii(corpus_cells, enough) if len(pivots) > 1 else {}
    pairs = _cell_pairs(
        pivots, {c: r for c, (_, r) in query_stats.items()}, {c: r for c, (_, r) in corpus_stats.items()}, inner
    )

    def cut(stats: dict[int, tuple[int, float]]) -> dict[int, int]:
        return {cell: -(-rows // block_rows) for cell, (rows, _) in stats.items()}

    def tiled(stats: dict[int, tuple[int, float]], parts: dict[int, int]) -> list[tuple[int, int, int]]:
        rows = sum(n for n, _ in stats.values())
        return _tiles(stats, parts, min(-(-rows // TILES), max(1, TILE_BYTES // width)))

    spark, corpus_parts, query_parts = corpus.sparkSession, cut(corpus_stats), cut(query_stats)
    parts_schema = "cell int, parts long"
    found = _search(
        _blocks(corpus_cells, spark.createDataFrame(list(corpus_parts.items()), parts_schema), "c"),
        _blocks(query_cells, spark.createDataFrame(list(query_parts.items()), parts_schema), "q"),
        pairs, tiled(corpus_stats, corpus_parts), tiled(query_stats, query_parts), enough,
    )

    # One list of k+1 per distinct vector; every item takes it without itself.
    hit = F.struct((-F.col("score")).alias("order"), "recommended_id", "score")
    lists = found.groupBy("id").agg(F.sort_array(F.collect_list(hit)).alias("hits"))
    by_vector = distinct.join(lists, "id").select("u", "hits")
    answered = query_units.join(materialise(by_vector, "lists"), "u")  # both sides plain: Spark splits a common vector
    others = F.filter("hits", lambda h: h["recommended_id"] != F.col("id"))
    top = answered.select("id", F.explode(F.slice(others, 1, k)).alias("h"))
    return top.select(F.col("id").alias(key), "h.recommended_id", "h.score")


def neighbour_lists(table: DataFrame, key: str, item: str = "item_id") -> DataFrame:
    """The top-k table with one row per item and its neighbours as an array of k."""
    hit = F.struct((-F.col("score")).alias("order"), "recommended_id", "score")
    return (
        table.groupBy(F.col(key).alias(item))
        .agg(F.array_sort(F.collect_list(hit)).alias("h"))
        .select(
            item,
            F.transform("h", lambda x: F.struct(x["recommended_id"].alias("recommended_id"), x["score"].alias("score"))).alias(
                "neighbours"
            ),
        )
    )
