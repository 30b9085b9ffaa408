"""A stored index of vectors that takes inserts and answers exactly.

Vectors are kept with length one, by cells around pivots: ``pivots`` (cell, pivot), ``cells`` (a folder per cell with its
vectors and their distance to the pivot), ``radii`` (cell, radius and count of each insert).  Vectors that come
later go into the cell of their nearest pivot; nothing that is stored is written again.

A question reads only cells that can hold an answer.  A cell whose pivot is at distance d has nothing
nearer than d - radius; cells are read in that order, in steps, until the k-th best found is nearer than
all that is left.  Within a cell the distance to the pivot bounds each vector in the same way and reaches the scan
as a filter.  Cells are about as many as the square root of the vectors they were chosen for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edupipe import fixed_values as fv
from edupipe.session import materialise

MOST_CELLS = 65_536   # pivots that are broadcast: 65,536 of 128 numbers are 64 MB
CELLS_AT_ONCE = 2     # cells of the first step; each further one reads twice as many
SLACK = 1e-9          # distances are sums of doubles

VECTORS = "distance double, unit array<double>"


def _unit(vectors: pa.Array, rows: int) -> np.ndarray:
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)
    lengths = np.sqrt((values * values).sum(axis=1))
    return values / np.where(lengths > 0, lengths, 1)[:, None]


def _pivots(spark: SparkSession, path: str) -> tuple[np.ndarray, np.ndarray]:
    rows = spark.read.parquet(f"{path}/pivots").orderBy("cell").toArrow()  # at most MOST_CELLS
    return rows.column("cell").to_numpy(), _unit(rows.column("pivot").combine_chunks(), rows.num_rows)


def create(df: DataFrame, key: str, vector: str, path: str, metadata: Sequence[str] = ()) -> None:
    """Choose pivots for the vectors of ``df`` and store them all.

    Pivots are the vectors with the least hashes of their key, about the square root of how many there are.
    Null vectors are left out; a vector without length is at distance one from everything.
    """
    known = df.where(F.col(vector).isNotNull())
    n = known.count()
    cells = max(1, min(MOST_CELLS, math.isqrt(n)))
    chosen = known.select(F.md5(F.col(key).cast("string")).alias("h"), F.col(vector).cast("array<double>").alias("pivot")).orderBy("h").limit(cells)
    rows = chosen.select("pivot").collect()  # at most MOST_CELLS
    numbered = [(i, r["pivot"]) for i, r in enumerate(rows)]
    pivots = df.sparkSession.createDataFrame(numbered, "cell long, pivot array<double>")
    pivots.coalesce(1).write.mode("errorifexists").parquet(f"{path}/pivots")
    if not n:
        return
    insert(known, key, vector, path, metadata)


def insert(df: DataFrame, key: str, vector: str, path: str, metadata: Sequence[str] = ()) -> None:
    """Put vectors into the cells of their nearest pivots; what is stored stays as it is."""
    spark = df.sparkSession
    cells, units = _pivots(spark, path)
    if not len(cells):
        raise ValueError("the index was made without vectors and has no cells")
    table = spark.sparkContext.broadcast((cells, units))
    kept = df.where(F.col(vector).isNotNull()).select(F.col(key).alias("key"), *metadata, F.col(vector).cast("array<double>").alias("unit"))
    others = [f for f in kept.schema.fields if f.name != "unit"]
    shape = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in others), "cell long", VECTORS])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, pivots = table.value
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(batch.column("unit"), batch.num_rows)
            cosines = unit @ pivots.T
            nearest = cosines.argmax(axis=1)
            distance = np.sqrt(((unit - pivots[nearest]) ** 2).sum(axis=1))
            offsets = pa.array(np.arange(len(unit) + 1, dtype=np.int32) * unit.shape[1])
            columns = [batch.column(f.name) for f in others]
            columns += [pa.array(numbers[nearest]), pa.array(distance), pa.ListArray.from_arrays(offsets, pa.array(unit.reshape(-1)))]
            yield pa.RecordBatch.from_arrays(columns, names=[*(f.name for f in others), "cell", "distance", "unit"])

    placed = materialise(kept.mapInArrow(place, shape), "placed")
    placed.hint("rebalance", F.col("cell")).sortWithinPartitions("cell", "distance").write.mode("append").partitionBy("cell").parquet(f"{path}/cells")
    radii = placed.groupBy("cell").agg(F.max("distance").alias("radius"), F.count("*").alias("n"))
    radii.write.mode("append").parquet(f"{path}/radii")


def _within(spark: SparkSession, path: str, cells: Sequence[int], point: np.ndarray, to_pivot: dict[int, float], reach: float) -> DataFrame:
    """(distance to the point, columns) of the vectors of some cells that can be within reach."""
    schema = spark.read.parquet(f"{path}/cells").schema
    rows = spark.read.schema(schema).parquet(f"{path}/cells").where(F.col("cell").isin(list(cells)))
    if math.isfinite(reach):  # the distance to the pivot differs by no more than the distance to the point
        at = F.create_map(*[F.lit(x) for c in cells for x in (c, float(to_pivot[c]))])[F.col("cell")]
        rows = rows.where((F.col("distance") >= at - (reach + SLACK)) & (F.col("distance") <= at + (reach + SLACK)))
        far = [to_pivot[c] for c in cells]  # the same over all these cells, which reaches the scan
        rows = rows.where(F.col("distance").between(min(far) - (reach + SLACK), max(far) + (reach + SLACK)))
    wanted = F.array(*[F.lit(float(x)) for x in point])
    dot = F.aggregate(F.zip_with("unit", wanted, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return rows.withColumn("score", dot)


def nearest(spark: SparkSession, path: str, vector: Sequence[float], k: int = fv.TOP_ITEMS, without=None) -> tuple[DataFrame, int]:
    """(the ``k`` most similar stored vectors with their columns and score, how many rows were compared).

    Ties go to the lesser key; ``without`` leaves one key out.  Exact, whatever was inserted.
    """
    cells, pivots = _pivots(spark, path)
    radii = spark.read.parquet(f"{path}/radii").groupBy("cell").agg(F.max("radius").alias("radius"), F.sum("n").alias("n"))
    known = {r["cell"]: (r["radius"], r["n"]) for r in radii.collect()}  # a row per cell
    length = math.sqrt(sum(float(x) * float(x) for x in vector))
    point = np.array(vector, np.float64) / (length or 1)
    to_pivot = dict(zip(cells.tolist(), np.sqrt(((pivots - point) ** 2).sum(axis=1)).tolist()))
    order = sorted(known, key=lambda c: (to_pivot[c] - known[c][0], c))
    best: list[tuple] = []
    reach, compared, at, step = math.inf, 0, 0, CELLS_AT_ONCE
    while at < len(order):
        some = [c for c in order[at : at + step] if to_pivot[c] - known[c][0] <= reach + SLACK]
        if not some:
            break
        rows = _within(spark, path, some, point, to_pivot, reach)
        rows = materialise(rows.where(F.lit(True) if without is None else F.col("key") != without).drop("unit"), "compared")
        compared += rows.count()
        top = rows.orderBy(F.round("score", 12).desc(), "key").limit(k).collect()  # k rows
        best = sorted([*best, *top], key=lambda r: (-round(r["score"], 12), r["key"]))[:k]
        if len(best) == k:
            reach = math.sqrt(max(0.0, 2 - 2 * best[-1]["score"])) + 1e-6
        at, step = at + step, step * 2
    schema = [f for f in spark.read.parquet(f"{path}/cells").schema.fields if f.name not in ("unit", "distance", "cell")]
    shape = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in schema), "score double"])
    return spark.createDataFrame([tuple(r[f.name] for f in schema) + (r["score"],) for r in best], shape), compared
