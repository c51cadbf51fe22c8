"""Extremely randomised trees, grown level by level over all rows.

At every node each column gets one threshold, drawn evenly between the smallest and the largest value that the
node's rows have there, by a hash of (seed, tree, node, column). Of the columns that vary at the node the first
``columns`` in the order of another hash are candidates; the one with the least impurity of its two sides splits
the node. All trees grow together: a level takes two jobs for each block of nodes, one for the extremes and one
for the class counts on the left of each candidate. Both are summed within tasks before the shuffle; at most
``CELLS`` numbers of a block reach the driver, which holds the trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.boosting import _lists, _spread
from millrace.operators.stored_models import StoredModel
from millrace.session import discard, scratch_table, shipped

CELLS = 1_000_000
"""Numbers of one block of nodes that come to the driver."""
LONGEST_PATH = 60


def hash_draws(seed: int, tree: np.ndarray, node: np.ndarray, column: np.ndarray, kind: int) -> np.ndarray:
    """Numbers in [0, 1) for trees, nodes (numbered as in a heap from 1) and columns."""
    x = _spread(np.asarray(tree, np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed % (1 << 31)) * 2 + kind + 1))
    x = _spread(x ^ np.asarray(node, np.uint64))
    return _spread(x ^ (np.asarray(column, np.uint64) + np.uint64(1) << np.uint64(32))) / 2.0 ** 64


def impurity(counts: np.ndarray, kind: str) -> np.ndarray:
    """Impurity times rows, over the last axis of class counts."""
    n = counts.sum(axis=-1)
    share = counts / np.maximum(n, 1)[..., None]
    if kind == "gini":
        return n * (1 - (share * share).sum(axis=-1))
    return -n * np.where(share > 0, share * np.log2(np.maximum(share, 1e-300)), 0).sum(axis=-1)


class _Nodes:
    """One tree: parallel lists; ``feature`` is -1 at a leaf, ``path`` the number in the heap."""

    def __init__(self, feature=None, cut=None, left=None, right=None, counts=None, path=None):
        self.feature, self.cut, self.left, self.right = feature or [-1], cut or [0.0], left or [0], right or [0]
        self.counts, self.path = counts or [None], path or [1]

    def split(self, node: int, feature: int, cut: float, counts: tuple[list, list]) -> tuple[int, int]:
        children = len(self.feature), len(self.feature) + 1
        self.feature[node], self.cut[node] = feature, cut
        self.left[node], self.right[node] = children
        for side, values in enumerate(counts):
            self.feature.append(-1)
            self.cut.append(0.0)
            self.left.append(0)
            self.right.append(0)
            self.counts.append(values)
            self.path.append(2 * self.path[node] + side)
        return children

    def leaves(self, x: np.ndarray) -> np.ndarray:
        feature, cut, left, right = np.array(self.feature), np.array(self.cut), np.array(self.left), np.array(self.right)
        at = np.zeros(len(x), np.int64)
        moving = np.arange(len(x)) if feature[0] >= 0 else np.zeros(0, np.int64)
        while len(moving):
            node = at[moving]
            at[moving] = np.where(x[moving, feature[node]] <= cut[node], left[node], right[node])
            moving = moving[feature[at[moving]] >= 0]
        return at

    def plain(self) -> dict:
        return {"feature": self.feature, "cut": self.cut, "left": self.left, "right": self.right, "counts": self.counts, "path": self.path}


def _fronts(trees: list[_Nodes], block: list[tuple[int, int]], x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows in the order of the block's nodes they are in, and those nodes, tree by tree."""
    for t in sorted({t for t, _ in block}):
        place = np.full(len(trees[t].feature), -1)
        for i, (tree, node) in enumerate(block):
            if tree == t:
                place[node] = i
        front = place[trees[t].leaves(x)]
        rows = np.flatnonzero(front >= 0)
        if len(rows):
            rows = rows[np.argsort(front[rows], kind="stable")]
            yield rows, front[rows]


def _arrays(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    x = _lists(batch.column("x"), width).astype(float)
    if np.isnan(x).any():
        raise ValueError("extra trees take no missing values")
    return x, batch.column("label").to_numpy()


def _extremes(rows: DataFrame, trees: list[_Nodes], block: list[tuple[int, int]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of every column at every node of the block."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full((len(block), width), np.inf), np.full((len(block), width), -np.inf)
        for batch in batches:
            x, _ = _arrays(batch, width)
            for order, front in _fronts(trees, block, x):
                first = np.flatnonzero(np.concatenate([[True], front[1:] != front[:-1]]))
                some = front[first]
                low[some] = np.minimum(low[some], np.minimum.reduceat(x[order], first, axis=0))
                high[some] = np.maximum(high[some], np.maximum.reduceat(x[order], first, axis=0))
        node, column = np.nonzero(np.isfinite(low))
        yield pa.RecordBatch.from_arrays([pa.array(node, pa.int32()), pa.array(column, pa.int32()), pa.array(low[node, column]), pa.array(high[node, column])],
                                         ["node", "feature", "low", "high"])

    found = rows.mapInArrow(work, "node int, feature int, low double, high double").groupBy("node", "feature").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).toArrow()
    low, high = np.zeros((len(block), width)), np.zeros((len(block), width))
    at = found["node"].to_numpy(), found["feature"].to_numpy()
    low[at], high[at] = found["low"].to_numpy(), found["high"].to_numpy()
    return low, high


def _candidates(trees: list[_Nodes], block: list[tuple[int, int]], low: np.ndarray, high: np.ndarray, seed: int, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """(columns, thresholds) of the candidates of every node; -1 where a node has fewer."""
    tree = np.array([t for t, _ in block])[:, None]
    path = np.array([trees[t].path[n] for t, n in block], np.uint64)[:, None]
    every = np.arange(low.shape[1])[None, :]
    order = np.where(high > low, hash_draws(seed, tree, path, every, 0), 2.0)
    chosen = np.argsort(order, axis=1, kind="stable")[:, :columns]
    fits = np.take_along_axis(order, chosen, axis=1) < 2.0
    share = hash_draws(seed, tree, path, chosen, 1)
    a, b = np.take_along_axis(low, chosen, axis=1), np.take_along_axis(high, chosen, axis=1)
    cut = a + share * (b - a)
    # rounding must not put all rows on the left
    return np.where(fits, chosen, -1), np.where(cut < b, cut, a)


def _left_counts(rows: DataFrame, trees: list[_Nodes], block: list[tuple[int, int]], chosen: np.ndarray, cut: np.ndarray, width: int, classes: int) -> np.ndarray:
    """Rows of each class on the left of each candidate; the last candidate counts all rows of the node."""
    slots = chosen.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(block) * classes, slots + 1), np.int64)
        for batch in batches:
            x, label = _arrays(batch, width)
            for order, front in _fronts(trees, block, x):
                cell = front * classes + label[order].astype(np.int64)
                for k in range(slots):
                    column = chosen[front, k]
                    left = (column >= 0) & (x[order, np.maximum(column, 0)] <= cut[front, k])
                    total[:, k] += np.bincount(cell[left], minlength=len(total))
                total[:, slots] += np.bincount(cell, minlength=len(total))
        cell, slot = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(slot, pa.int32()), pa.array(total[cell, slot])], ["cell", "slot", "n"])

    found = rows.mapInArrow(work, "cell bigint, slot int, n bigint").groupBy("cell", "slot").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros((len(block) * classes, slots + 1), np.int64)
    total[found["cell"].to_numpy(), found["slot"].to_numpy()] = found["n"].to_numpy()
    return total.reshape(len(block), classes, slots + 1).transpose(0, 2, 1)


class ExtraTreesClassifier(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Reads a vector column and a label column of class numbers 0 .. k - 1; nulls are an error.

    ``columns`` is the number of candidates at a node (0: the square root of all). Every tree sees all rows.
    """

    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "deepest level", TypeConverters.toInt)
    columns = Param(Params._dummy(), "columns", "candidate columns at a node", TypeConverters.toInt)
    minRows = Param(Params._dummy(), "minRows", "fewest rows of a node to be split", TypeConverters.toInt)
    impurity = Param(Params._dummy(), "impurity", "gini or entropy", TypeConverters.toString)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, trees: int = 10, maxDepth: int = 10, columns: int = 0, minRows: int = 2, impurity: str = "gini", seed: int = 0,
                 featuresCol: str = "features", labelCol: str = "label"):
        super().__init__()
        self._setDefault(trees=10, maxDepth=10, columns=0, minRows=2, impurity="gini", seed=0, featuresCol="features", labelCol="label")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ExtraTreesModel:
        label = F.col(self.getOrDefault(self.labelCol)).cast("double")
        x = dataset.select(vector_to_array(self.getOrDefault(self.featuresCol)).alias("x"), label.alias("label"))
        forest, classes = self.grow(x)
        return ExtraTreesModel({"trees": [t.plain() for t in forest], "classes": classes, "features": self.getOrDefault(self.featuresCol)})

    def grow(self, data: DataFrame) -> tuple[list[_Nodes], int]:
        """The trees over (x array<double>, label double) and the number of classes."""
        shipped(data.sparkSession)
        value = {p.name: self.getOrDefault(p) for p in self.params}
        rows = scratch_table(data.where("label is not null")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            head = rows.agg(F.max("label").alias("k"), F.max(F.size("x")).alias("w")).first()
            classes, width = int(head["k"] if head["k"] is not None else 0) + 1, head["w"] or 0
            trees = [_Nodes() for _ in range(value["trees"])]
            if not width:
                return trees, classes
            columns = min(value["columns"] or max(1, math.isqrt(width)), width)
            fronts = [(t, 0) for t in range(len(trees))]
            size = max(1, CELLS // max(2 * width, (columns + 1) * classes))
            for _ in range(min(value["maxDepth"], LONGEST_PATH)):
                following: list[tuple[int, int]] = []
                for begin in range(0, len(fronts), size):
                    block = fronts[begin: begin + size]
                    following += self._split(rows, trees, block, width, classes, columns, value)
                fronts = following
                if not fronts:
                    break
            return trees, classes
        finally:
            discard(rows)

    @staticmethod
    def _split(rows, trees, block, width, classes, columns, value) -> list[tuple[int, int]]:
        low, high = _extremes(rows, trees, block, width)
        chosen, cut = _candidates(trees, block, low, high, value["seed"], columns)
        counts = _left_counts(rows, trees, block, chosen, cut, width, classes)
        whole, left = counts[:, -1], counts[:, :-1]
        right = whole[:, None, :] - left
        score = np.where(chosen >= 0, impurity(left, value["impurity"]) + impurity(right, value["impurity"]), np.inf)
        following = []
        for i, (t, node) in enumerate(block):
            if trees[t].counts[node] is None:
                trees[t].counts[node] = whole[i].tolist()
            best = int(score[i].argmin())
            if chosen[i, best] < 0 or whole[i].sum() < value["minRows"] or (whole[i] > 0).sum() < 2:
                continue
            sides = left[i, best].tolist(), right[i, best].tolist()
            children = trees[t].split(node, int(chosen[i, best]), float(cut[i, best]), sides)
            following += [(t, c) for c, n in zip(children, sides) if sum(n) >= value["minRows"] and sum(v > 0 for v in n) > 1]
        return following


class ExtraTreesModel(StoredModel):
    """Mean of the class shares in the leaves of all trees."""

    @property
    def featureImportances(self):
        """Falls of the gini impurity by column, summed to 1."""
        from pyspark.ml.linalg import Vectors

        total: dict[int, float] = {}
        for tree in self.content["trees"]:
            counts = np.array([c or [0] for c in tree["counts"]], float)
            for node, feature in enumerate(tree["feature"]):
                if feature >= 0:
                    fall = impurity(counts[node], "gini") - sum(impurity(counts[c], "gini") for c in (tree["left"][node], tree["right"][node]))
                    total[feature] = total.get(feature, 0.0) + float(fall)
        whole = sum(total.values()) or 1.0
        return Vectors.sparse(max(total, default=0) + 1, {f: v / whole for f, v in sorted(total.items())})

    def chances(self, x: Column) -> Column:
        """Array of class probabilities from an array of doubles."""
        forest = [_Nodes(**t) for t in self.content["trees"]]
        classes = self.content["classes"]

        @F.pandas_udf("array<double>")
        def score(values: pd.Series) -> pd.Series:
            if not len(values):
                return pd.Series([], dtype=object)
            matrix = np.stack(values.to_numpy()).astype(float)
            total = np.zeros((len(matrix), classes))
            for tree in forest:
                counts = np.array([c or [0] * classes for c in tree.counts], float)
                total += (counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))[tree.leaves(matrix)]
            return pd.Series(list(total / max(len(forest), 1)))

        return score(x)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Add ``probability`` (a vector) and ``prediction``."""
        shipped(dataset.sparkSession)
        found = dataset.withColumn("_chances", self.chances(vector_to_array(self.content["features"])))
        place = (F.array_position("_chances", F.array_max("_chances")) - 1).cast("double")
        return found.withColumns({"probability": array_to_vector("_chances"), "prediction": place}).drop("_chances")
