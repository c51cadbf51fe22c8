"""Training rows packed into blocks for fits that pass over them many times.

One record is a block: the vectors of its rows in compressed sparse rows, labels, folds and row keys as bytes. A
pass hands few, large records to each task; vectors may be dense, sparse or mixed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import scratch_table, shipped

DENSE_CELLS = 2_000_000
"""Cells of a block that is unfolded to be multiplied; wider rows stay sparse."""
MOST_ROWS = 16_384
DRIVER_BYTES = 64 << 20
"""Sums of all tasks together that are added on the driver; more are added by a second stage."""

PARTS = {"starts": np.int64, "columns": np.int32, "values": np.float64, "label": np.float64, "fold": np.int32, "draw": np.uint64}
_SCHEMA = "batch int, " + ", ".join(f"{name} binary" for name in PARTS)


class Block:
    """Rows of ``width`` columns with labels, folds and keys."""

    def __init__(self, width: int, parts: dict[str, np.ndarray]):
        self.width, self.parts = width, parts
        self.label, self.fold, self.draw = parts["label"], parts["fold"], parts["draw"]
        self._dense: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.label)

    @property
    def owner(self) -> np.ndarray:
        """Row of every stored value."""
        return np.repeat(np.arange(len(self)), np.diff(self.parts["starts"]))

    def dense(self) -> np.ndarray:
        if self._dense is None:
            self._dense = np.zeros((len(self), self.width))
            self._dense[self.owner, self.parts["columns"]] = self.parts["values"]
        return self._dense

    @property
    def small(self) -> bool:
        return len(self) * self.width <= DENSE_CELLS

    def times(self, weights: np.ndarray) -> np.ndarray:
        """Rows times a (width x k) matrix."""
        if self.small:
            return self.dense() @ weights
        out = np.zeros((len(self), weights.shape[1]))
        np.add.at(out, self.owner, self.parts["values"][:, None] * weights[self.parts["columns"]])
        return out

    def gathered(self, errors: np.ndarray) -> np.ndarray:
        """The transposed rows times a (rows x k) matrix."""
        if self.small:
            return self.dense().T @ errors
        out = np.zeros((self.width, errors.shape[1]))
        np.add.at(out, self.parts["columns"], self.parts["values"][:, None] * errors[self.owner])
        return out


def read(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block(width, {n: np.frombuffer(batch.column(n)[i].as_buffer(), t) for n, t in PARTS.items()})


def sparse_rows(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, columns, values) of unwrapped vectors; zeros are left out."""
    dense = vectors.field("type").to_numpy() == 1
    cells, places = vectors.field("values"), vectors.field("indices")
    count = cells.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.cumsum(count) - count
    columns = np.arange(int(count.sum())) - np.repeat(first, count)
    columns[np.repeat(~dense, count)] = places.flatten().to_numpy()
    values = cells.flatten().to_numpy(zero_copy_only=False)
    stored = values != 0
    ends = np.concatenate([[0], np.cumsum(stored)])
    return np.concatenate([ends[first], ends[-1:]]), columns[stored].astype(np.int32), values[stored]


def width_of(df: DataFrame, features: str) -> int:
    found = df.select(F.unwrap_udt(features).alias("v")).select(F.coalesce("v.size", F.size("v.values"))).first()
    return int(found[0]) if found else 0


def pack(df: DataFrame, features: str, label: str, key: str, width: int, fold: Column | None = None, batch: Column | None = None) -> DataFrame:
    """Stored blocks of the rows with a label, kept in memory or on disk; rows of one ``batch`` number share blocks.

    The caller discards them.
    """
    spark = shipped(df.sparkSession)
    fold = F.lit(-1) if fold is None else fold
    rows = df.where(F.col(label).isNotNull() & F.col(features).isNotNull()).select(
        F.xxhash64(F.col(key).cast("string")).alias("draw"), F.col(label).cast("double").alias("label"), fold.cast("int").alias("fold"),
        (F.lit(0) if batch is None else batch).cast("int").alias("batch"), F.unwrap_udt(features).alias("x"))
    cores = spark.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores:
        rows = rows.repartition(cores, "draw")
    if batch is not None:
        rows = rows.sortWithinPartitions("batch")
    most = max(1, min(MOST_ROWS, DENSE_CELLS // max(width, 1)))

    def packed(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        starts, columns, values = sparse_rows(table.column("x").chunk(0))
        arrays = {"starts": starts, "columns": columns, "values": values, **{c: table.column(c).to_numpy() for c in ("label", "fold", "draw")}}
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int32()), *[pa.array([np.ascontiguousarray(arrays[n]).astype(t, copy=False).tobytes()], pa.binary()) for n, t in PARTS.items()]],
            ["batch", *PARTS])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, number = [], 0, None
        for batch in batches:
            numbers = batch.column("batch").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                for begin in range(a, b, most):
                    part = batch.slice(begin, min(most, b - begin))
                    if rows and (numbers[begin] != number or rows + part.num_rows > most):
                        yield packed(number, held)
                        held, rows = [], 0
                    number = int(numbers[begin])
                    held.append(part)
                    rows += part.num_rows
        if rows:
            yield packed(number, held)

    return scratch_table(rows.mapInArrow(work, _SCHEMA)).persist(StorageLevel.MEMORY_AND_DISK)


def summed(blocks: DataFrame, width: int, work: Callable[[Block], Sequence[np.ndarray]], shapes: Sequence[tuple[int, ...]]) -> list[np.ndarray]:
    """Sums of ``work``'s arrays over all blocks, added in the order of partitions."""
    sizes = [int(np.prod(s)) for s in shapes]
    length = sum(sizes)

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for block in read(batches, width):
            if len(block):
                total += np.concatenate([np.asarray(a, float).ravel() for a in work(block)])
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((p, s) for b in batches for p, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        if rows:
            total = np.sum([np.frombuffer(s) for _, s in rows], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([rows[0][0]], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "sums"])

    tasks = max(blocks.rdd.getNumPartitions(), 1)
    sums = blocks.mapInArrow(in_task, "part int, sums binary")
    if tasks * length * 8 > DRIVER_BYTES and tasks > 3:
        sums = sums.repartition(max(2, int(tasks ** 0.5)), "part").mapInArrow(added, "part int, sums binary")
    total = np.zeros(length)
    for _, part in sorted((r["part"], bytes(r["sums"])) for r in sums.collect()):
        total += np.frombuffer(part)
    cuts = np.cumsum([0, *sizes])
    return [total[a:b].reshape(s) for a, b, s in zip(cuts[:-1], cuts[1:], shapes)]
