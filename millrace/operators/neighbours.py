"""Exact nearest neighbours by pivot cells.

Some training vectors are pivots; every training row belongs to the cell of its nearest pivot, and a cell knows how
far its rows are from the pivot at most. A query first looks into the cell of its own nearest pivot. The distance of its
k-th row there bounds what can still be found elsewhere: by the triangle inequality only cells whose border is
nearer than that bound can hold a nearer row. The query is joined to those cells alone. Cells are cut into parts of bounded
size, and the queries of a part into blocks, so no task sees more than ``PART`` rows with ``QUERIES`` queries at a time, and
queries never come to the driver. Pivots are at most ``PIVOTS`` vectors. A task holds about ``CELLS`` distances or copied
numbers at once, however many cells a query has to look into and however many rows are equally near.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from millrace.functions.hashing import hash_text
from millrace.session import scratch_folder, shipped

PIVOTS = 256
PIVOT_BYTES = 8 << 20
PART = 20_000
QUERIES = 5_000
CELLS = 2_000_000
"""Distances, or numbers of copied vectors, that a task holds at once."""
SLACK = 1e-9
"""Relative rounding error of distances that a bound allows for."""


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_folder(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), width)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances between two sets of vectors; near ones are recomputed without cancellation."""
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :]
    out = np.maximum(squares - 2 * a @ b.T, 0)
    i, j = np.nonzero(out < 1e-6 * squares)
    if len(i):
        out[i, j] = _squares(a, i, b, j)
    return np.sqrt(out)


def _squares(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Squared distances of the pairs (a[i], b[j]), some pairs at a time."""
    step = max(1, CELLS // max(a.shape[1], 1))
    return np.concatenate([((a[i[s: s + step]] - b[j[s: s + step]]) ** 2).sum(axis=1) for s in range(0, len(i), step)] or [np.zeros(0)])


def _slices(batch: pa.RecordBatch, columns: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces that have at most about ``CELLS`` distances to ``columns`` vectors."""
    step = max(1, CELLS // max(columns, 1))
    for begin in range(0, batch.num_rows, step):
        yield batch.slice(begin, step)


def find_pivots(vectors: DataFrame, key: str, vector: str, width: int, count: int) -> np.ndarray:
    """``count`` distinct training vectors, in the order of a hash of their keys."""
    most = max(1, min(count, PIVOTS, PIVOT_BYTES // (8 * width)))
    rows = vectors.select(F.col(vector).alias("v"), hash_text(key, "pivot").alias("h")).orderBy("h").limit(4 * most).collect()
    distinct = list(dict.fromkeys(tuple(float(x) for x in r["v"]) for r in rows))[:most]
    return np.array(distinct).reshape(-1, width)


def _with_cells(df: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """Add ``cell`` (number of the nearest pivot) and ``far`` (distance to it)."""
    shared = df.sparkSession.sparkContext.broadcast(pivots)
    names = df.columns
    schema = T.StructType([*df.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("far", T.DoubleType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, len(shared.value)):
                d = distances(_matrix(batch.column("v"), width), shared.value)
                cell = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell])], [*names, "cell", "far"])

    return df.mapInArrow(work, schema)


def _searched(train: DataFrame, pairs: DataFrame, parts: dict[int, int], k: int, width: int) -> DataFrame:
    """(query, distance, neighbour, carry): for each (query, cell) pair the k nearest rows of each part of the cell.

    ``parts`` says into how many parts each cell is cut; queries of a cell come in blocks of about ``QUERIES``.
    """
    counts = {r["cell"]: r["n"] for r in pairs.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # at most PIVOTS rows
    blocks = {c: -(-n // QUERIES) for c, n in counts.items()}

    def looked_up(values: dict[int, int], cell: str) -> Column:
        table = [values.get(c, 1) for c in range(max(list(values) or [0]) + 1)]
        return F.get(F.lit(table), F.col(cell))

    # each part meets each block of its cell's queries: rows are repeated per block, queries per part
    left = train.withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce(looked_up(blocks, "cell"), F.lit(0)) - 1))).where(
        F.col("cell").isin(list(blocks))) if blocks else train.withColumn("block", F.lit(0)).where("false")
    block = F.pmod(F.xxhash64(F.col("query").cast("string")), F.coalesce(looked_up(blocks, "cell"), F.lit(1))).cast("int") if blocks else F.lit(0)
    right = pairs.withColumn("block", block).withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce(looked_up(parts, "cell"), F.lit(1)) - 1)))
    key_type, carry_type = train.schema["neighbour"].dataType, train.schema["carry"].dataType
    schema = T.StructType([T.StructField("query", pairs.schema["query"].dataType), T.StructField("distance", T.DoubleType()),
                           T.StructField("neighbour", key_type), T.StructField("carry", carry_type)])

    def work(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return pa.table({n: pa.array([], t) for n, t in (("query", queries.schema.field("query").type), ("distance", pa.float64()),
                                                             ("neighbour", rows.schema.field("neighbour").type), ("carry", rows.schema.field("carry").type))})
        rows = rows.sort_by("neighbour").combine_chunks()
        points = _matrix(rows.column("v").combine_chunks(), width)
        names, picked, found = [], [], []
        vectors = _matrix(queries.column("v").combine_chunks(), width)
        bound = queries.column("bound").to_numpy()
        step = max(1, CELLS // max(len(points), 1))
        for begin in range(0, len(vectors), step):
            d = distances(vectors[begin: begin + step], points)
            limit = bound[begin: begin + step]
            best = np.sort(np.partition(d, k - 1, axis=1)[:, :k], axis=1)[:, -1] if d.shape[1] > k else np.full(len(d), np.inf)
            # rows that are as near as the k-th but for rounding stay; their distances are then taken again, pair by pair
            q, p = np.nonzero(d <= np.minimum(best * (1 + SLACK) + SLACK, limit)[:, None])
            away = np.sqrt(_squares(vectors, begin + q, points, p))
            order = np.lexsort((p, away, q))
            q, p, away = q[order], p[order], away[order]
            keep = np.arange(len(q)) - np.searchsorted(q, q, "left") < k  # any number of rows may be equally near
            names.append(begin + q[keep])
            picked.append(p[keep])
            found.append(away[keep])
        names, picked, found = np.concatenate(names), np.concatenate(picked), np.concatenate(found)
        return pa.table({"query": queries.column("query").take(names), "distance": pa.array(found),
                         "neighbour": rows.column("neighbour").take(picked), "carry": rows.column("carry").take(picked)})

    return left.groupBy("cell", "part", "block").cogroup(right.groupBy("cell", "part", "block")).applyInArrow(work, schema)


def _nearest_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy("distance", "neighbour")
    return found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def pivot_search(train: DataFrame, queries: DataFrame, key: str, vector: str, carry: str, k: int, width: int,
                 pivots: int | None = None) -> tuple[DataFrame, dict[str, int]]:
    """(query, distance, neighbour, carry) and counts: the k nearest training rows of every query, ties by key.

    The counts tell ``pairs``, how many (query, row) pairs there are, and ``compared``, how many were looked at.
    Rows without a vector are left out.
    """
    shipped(train.sparkSession)
    known = F.col(vector).isNotNull()
    rows = train.where(known).select(F.col(key).alias("neighbour"), F.col(vector).cast("array<double>").alias("v"), F.col(carry).alias("carry"))
    asked = queries.where(known).select(F.col(key).alias("query"), F.col(vector).cast("array<double>").alias("v"))
    total = rows.count()
    # a table of one part is compared as a whole: its cells would cost more than they save
    middle = find_pivots(rows, "neighbour", "v", width, pivots or (1 if total <= PART else int(total ** 0.5)))
    if not len(middle):
        middle = np.zeros((1, width))
    placed = _stored(_with_cells(rows, middle, width))
    cells = {r["cell"]: (r["n"], r["far"]) for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()}
    parts = {c: -(-n // PART) for c, (n, _) in cells.items()}
    part = F.pmod(F.xxhash64(F.col("neighbour").cast("string")), F.coalesce(F.get(F.lit([parts.get(c, 1) for c in range(len(middle))]), F.col("cell")), F.lit(1)))
    placed = placed.select("neighbour", "v", "carry", "cell", part.cast("int").alias("part"))
    asked = _stored(_with_cells(asked, middle, width))

    own = asked.select("query", "v", "cell", F.lit(float("inf")).alias("bound"))
    if len(middle) == 1:
        pairs = total * asked.count()
        return _nearest_of(_searched(placed, own, parts, k, width), k), {"pairs": pairs, "compared": pairs}
    first = _stored(_nearest_of(_searched(placed, own, parts, k, width), k)).persist(StorageLevel.MEMORY_AND_DISK)
    reach = first.groupBy("query").agg(F.max("distance").alias("bound"), F.count("*").alias("n")).select(
        "query", F.when(F.col("n") >= k, F.col("bound") * (1 + SLACK)).otherwise(F.lit(float("inf"))).alias("bound"))

    radius = np.array([cells.get(c, (0, -np.inf))[1] for c in range(len(middle))])
    sizes = np.array([cells.get(c, (0, 0.0))[0] for c in range(len(middle))])
    shared = train.sparkSession.sparkContext.broadcast(middle)

    def remaining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in _slices(whole, len(sizes))):
            d = distances(_matrix(batch.column("v"), width), shared.value)
            bound = batch.column("bound").to_numpy()
            open_ = (d - radius[None, :] <= bound[:, None] + SLACK * (1 + d)) & (sizes > 0)[None, :]
            open_[np.arange(len(d)), batch.column("cell").to_numpy()] = False  # searched already
            every, cells_of = np.nonzero(open_)
            step = max(1, CELLS // max(width, 1))
            for begin in range(0, len(every), step):
                q, c = every[begin: begin + step], cells_of[begin: begin + step]
                yield pa.RecordBatch.from_arrays([batch.column("query").take(pa.array(q)), batch.column("v").take(pa.array(q)), pa.array(c, pa.int32()),
                                                  pa.array(bound[q])], ["query", "v", "cell", "bound"])

    kind = asked.schema["query"].dataType.simpleString()
    bounded = asked.join(reach, "query", "left").select("query", "v", "cell", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
    others = _stored(bounded.mapInArrow(remaining, f"query {kind}, v array<double>, cell int, bound double"))
    looked = {r["cell"]: r["n"] for r in own.select("cell").unionByName(others.select("cell")).groupBy("cell").agg(F.count("*").alias("n")).collect()}
    counts = {"pairs": total * asked.count(), "compared": sum(n * int(sizes[c]) for c, n in looked.items())}
    found = _nearest_of(first.unionByName(_searched(placed, others, parts, k, width)), k)
    return found, counts
