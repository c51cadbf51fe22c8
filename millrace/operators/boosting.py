"""Boosted trees from histograms of gradients and curvatures.

Columns are cut into quantile bins once; rows are packed into blocks, one record per block, with one byte per
row and column, the labels, the folds and the margins. Each level of a tree is one job: tasks sum gradients and
curvatures of their rows by (node, column, bin), the sums are added (by a shuffle, or on the driver while they are
few), and the best split of every node comes to the driver. Leaves take Newton steps with an L2 penalty.
Missing values (null, NaN) have a bin of their own and go to the side where they gain more.

Several models grow in lockstep over the same rows: model m leaves out the rows of fold m. Their nodes are
told apart by number, so the jobs per round do not depend on the number of models. Trees are applied to
the rows in passing; every ``REFRESH`` rounds the margins are written anew, so neither plans nor lineage
grow. Sums are whole numbers (gradients times a power of two), so they do not depend on the
order of rows, partitions or retries: a fit that is resumed equals one that was not stopped.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.operators.metrics import roc_auc
from millrace.session import discard, scratch_table, shipped

MISSING = 255
MOST_BINS = 254
REFRESH = 8
CELLS = 2_000_000
"""Sums a task keeps; with more of them they are passed on with every block."""
DRIVER_BYTES = 32 << 20
"""Sums of all tasks together that are added on the driver; more of them are shuffled."""
SCORES = 200_000
"""Distinct scores whose area is found on the driver."""
BLOCK_ROWS, BLOCK_BYTES = 16_384, 4 << 20
SCALE_BITS = 30
TOP_BITS = 61


@dataclass(frozen=True)
class Settings:
    """``objective`` is ``logistic`` (labels 0 and 1) or ``squared``."""

    rounds: int = 100
    depth: int = 6
    step: float = 0.3
    l2: float = 1.0
    least_gain: float = 0.0
    least_weight: float = 1.0
    row_share: float = 1.0
    feature_share: float = 1.0
    bins: int = 64
    objective: str = "logistic"
    seed: int = 0


@dataclass
class Tree:
    """Nodes as parallel lists; ``feature`` is -1 at a leaf, ``cut`` the last bin that goes left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [True])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool, gain: float, values: tuple[float, float]) -> tuple[int, int]:
        children = len(self.feature), len(self.feature) + 1
        self.feature[node], self.cut[node], self.missing_left[node], self.gain[node] = feature, cut, missing_left, gain
        self.left[node], self.right[node] = children
        for value in values:
            for name, blank in (("feature", -1), ("cut", 0), ("missing_left", True), ("left", 0), ("right", 0), ("gain", 0.0)):
                getattr(self, name).append(blank)
            self.value.append(value)
        return children

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """Node where each row ends."""
        feature, cut, missing = np.array(self.feature), np.array(self.cut), np.array(self.missing_left)
        left, right = np.array(self.left), np.array(self.right)
        at = np.zeros(len(bins), np.int64)
        moving = np.arange(len(bins)) if feature[0] >= 0 else np.zeros(0, np.int64)
        while len(moving):
            node = at[moving]
            found = bins[moving, feature[node]]
            goes_left = np.where(found == MISSING, missing[node], found <= cut[node])
            at[moving] = np.where(goes_left, left[node], right[node])
            moving = moving[feature[at[moving]] >= 0]
        return at

    def values(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves(bins)]


def _spread(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def row_draws(keys: np.ndarray, seed: int, number: int) -> np.ndarray:
    """A number in [0, 1) for each row key, seed and tree."""
    salt = _spread(np.array([(seed % (1 << 31)) * 1_000_003 + number + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return _spread(keys.astype(np.uint64) ^ salt) / 2.0 ** 64


def drawn_features(count: int, share: float, seed: int, number: int) -> list[int]:
    """The columns that tree ``number`` may use."""
    if share >= 1.0:
        return list(range(count))
    order = np.argsort(row_draws(np.arange(count, dtype=np.uint64), seed + 7, number), kind="stable")
    return sorted(order[: max(1, round(share * count))].tolist())


def gradients(objective: str, label: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if objective == "squared":
        return margin - label, np.ones(len(label))
    p = 1.0 / (1.0 + np.exp(-margin))
    return p - label, np.maximum(p * (1.0 - p), 1e-16)


def binned(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """One byte per row and column: how many edges lie below the value, or ``MISSING``."""
    out = np.full(values.shape, MISSING, np.uint8)
    for j, cuts in enumerate(edges):
        known = ~np.isnan(values[:, j])
        out[known, j] = np.searchsorted(cuts, values[known, j], "left")
    return out


def find_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """At most ``bins - 1`` quantiles of each column; they decide which splits are looked at."""
    if not 2 <= bins <= MOST_BINS:
        raise ValueError(f"bins must lie in 2 .. {MOST_BINS}")
    shares = [i / bins for i in range(1, bins)]
    known = [F.percentile_approx(_number(c), shares, 100 * bins).alias(f"q{i}") for i, c in enumerate(features)]
    found = df.agg(*known).first()
    return [np.unique(np.array(found[f"q{i}"] or [], float)) for i in range(len(features))]


def _number(name: str) -> Column:
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def _lists(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


PARTS = {"draw": np.uint64, "bins": np.uint8, "label": np.float64, "fold": np.int32, "margins": np.float64}
_ROW = ", ".join(f"{name} binary" for name in PARTS)


def _packed(parts: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(parts[n], t).tobytes()], pa.binary()) for n, t in PARTS.items()], list(PARTS))


@dataclass
class _State:
    """Stored blocks of rows and the rounds that their margins do not hold yet."""

    rows: DataFrame
    models: int
    features: int
    settings: Settings
    pending: list[list[Tree]] = field(default_factory=list)

    def blocks(self, batches: Iterator[pa.RecordBatch], held_only: bool = False) -> Iterator[dict[str, np.ndarray]]:
        """The columns of each block, pending trees added to the margins; of all rows or of those in a fold."""
        for batch in batches:
            for i in range(batch.num_rows):
                block = {n: np.frombuffer(batch.column(n)[i].as_buffer(), t) for n, t in PARTS.items()}
                rows = len(block["label"])
                block["bins"] = block["bins"].reshape(rows, self.features)
                block["margins"] = block["margins"].reshape(rows, self.models)
                if held_only:
                    held = np.flatnonzero(block["fold"] >= 0)
                    block = {n: v[held] for n, v in block.items()}
                margins = block["margins"].copy()
                for trees in self.pending:
                    for m, tree in enumerate(trees):
                        margins[:, m] += tree.values(block["bins"])
                block["margins"] = margins
                yield block


def _light(state: _State) -> _State:
    """The state without its frame, to be sent to tasks."""
    return replace(state, rows=None)


_SUMS = "front int, feature int, sums binary"


def _histograms(state: _State, trees: list[Tree], fronts: list[tuple[int, int]], columns: list[int], number: int, scale: float) -> DataFrame:
    """(front, feature, sums): for every open node and column the sums of gradients and of curvatures by bin."""
    light, settings = _light(state), state.settings
    place = [np.full(len(t.feature), -1) for t in trees]
    for i, (m, node) in enumerate(fronts):
        place[m][node] = i
    width = settings.bins + 1  # the last one for missing values
    size = len(fronts) * width

    def records(feature: int, total: np.ndarray) -> pa.RecordBatch:
        each = total.reshape(2, len(fronts), width).transpose(1, 0, 2)
        some = np.flatnonzero((each != 0).any(axis=(1, 2)))
        return pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(np.full(len(some), feature), pa.int32()), pa.array([each[i].tobytes() for i in some], pa.binary())],
            ["front", "feature", "sums"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = size * len(columns) <= CELLS
        total = np.zeros((len(columns), 2, size), np.int64) if keep else None
        for block in light.blocks(batches):
            drawn = row_draws(block["draw"], settings.seed, number) < settings.row_share
            for m, tree in enumerate(trees):
                rows = np.flatnonzero((block["fold"] != m) & drawn)
                mine = block["bins"][rows]
                front = place[m][tree.leaves(mine)]
                open_ = front >= 0
                rows, mine, front = rows[open_], mine[open_], front[open_]
                if not len(rows):
                    continue
                values = [np.rint(v * scale) for v in gradients(settings.objective, block["label"][rows], block["margins"][rows, m])]
                for k, feature in enumerate(columns):
                    spots = front * width + np.minimum(mine[:, feature], settings.bins)
                    one = np.stack([np.bincount(spots, v, size).astype(np.int64) for v in values])
                    if keep:
                        total[k] += one
                    else:
                        yield records(feature, one)
        if keep:
            for k, feature in enumerate(columns):
                yield records(feature, total[k])

    return state.rows.mapInArrow(work, _SUMS)


def _added(batches: Iterator[pa.RecordBatch] | list[pa.RecordBatch], width: int) -> dict[tuple[int, int], np.ndarray]:
    """Sums of (front, feature) over all records."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for front, feature, sums in zip(*[batch.column(k).to_pylist() for k in range(3)]):
            value = np.frombuffer(sums, np.int64).reshape(2, width)
            known = total.get((front, feature))
            total[front, feature] = value if known is None else known + value
    return total


@dataclass(frozen=True)
class Split:
    """The best cut of a node; ``feature`` is None if none is allowed. Sums of all its rows and of the left ones."""

    g: float
    h: float
    feature: int | None = None
    gain: float = 0.0
    cut: int = 0
    missing_left: bool = True
    gl: float = 0.0
    hl: float = 0.0

    def rank(self) -> tuple[bool, float, int]:
        """Best first; equal gains go to the first column."""
        return self.feature is None, -self.gain, self.feature or 0


def best_split(feature: int, sums: np.ndarray, settings: Settings, scale: float) -> Split:
    """The best cut of one column from its sums by bin; equal gains go to the lowest cut, missing values to the left."""
    whole = sums.sum(axis=1) / scale
    (g, h), l2 = whole, settings.l2
    below, missing = np.cumsum(sums[:, :-1], axis=1) / scale, sums[:, -1:] / scale
    left = np.stack([below + missing, below], axis=2).reshape(2, -1)
    gl, hl = left
    gr, hr = g - gl, h - hl
    least = max(settings.least_weight, 1.0 / scale)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 0.5 * (gl * gl / (hl + l2) + gr * gr / (hr + l2) - g * g / (h + l2)) - settings.least_gain
    gain = np.where((hl >= least) & (hr >= least) & (gain > 0), gain, 0.0)
    k = int(gain.argmax())
    if not gain[k] > 0:
        return Split(float(g), float(h))
    return Split(float(g), float(h), feature, float(gain[k]), k // 2, k % 2 == 0, float(gl[k]), float(hl[k]))


def _best(total: dict[tuple[int, int], np.ndarray], settings: Settings, scale: float) -> dict[int, Split]:
    found: dict[int, Split] = {}
    for (front, feature), sums in sorted(total.items()):
        split = best_split(feature, sums, settings, scale)
        if front not in found or split.rank() < found[front].rank():
            found[front] = split
    return found


def best_splits(parts: DataFrame, tasks: int, fronts: int, columns: int, settings: Settings, scale: float) -> dict[int, Split]:
    """The best split of every node from the sums of all tasks."""
    width = settings.bins + 1
    if tasks * fronts * columns * width * 16 <= DRIVER_BYTES:
        return _best(_added(parts.toArrow().to_batches(), width), settings, scale)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits = _best(_added(batches, width), settings, scale)
        yield pa.RecordBatch.from_arrays([pa.array(list(splits), pa.int32()), pa.array([json.dumps(asdict(s)) for s in splits.values()], pa.string())],
                                         ["front", "split"])

    # one record per partition and node
    found: dict[int, Split] = {}
    for r in parts.repartition("front", "feature").mapInArrow(work, "front int, split string").toLocalIterator():
        split = Split(**json.loads(r["split"]))
        if r["front"] not in found or split.rank() < found[r["front"]].rank():
            found[r["front"]] = split
    return found


def grow(state: _State, number: int, scale: float) -> list[Tree]:
    """One tree for every model, a job per level."""
    settings = state.settings
    columns = drawn_features(state.features, settings.feature_share, settings.seed, number)
    trees = [Tree() for _ in range(state.models)]
    tasks = state.rows.rdd.getNumPartitions()
    leaf = lambda g, h: -settings.step * g / (h + settings.l2) if h + settings.l2 > 0 else 0.0
    fronts = [(m, 0) for m in range(state.models)]
    for level in range(max(settings.depth, 1)):
        parts = _histograms(state, trees, fronts, columns, number, scale)
        following = []
        for i, best in sorted(best_splits(parts, tasks, len(fronts), len(columns), settings, scale).items()):
            m, node = fronts[i]
            if level == 0:
                trees[m].value[0] = leaf(best.g, best.h)
            if best.feature is None or settings.depth < 1:
                continue
            gr, hr = best.g - best.gl, best.h - best.hl
            children = trees[m].split(node, best.feature, best.cut, best.missing_left, best.gain, (leaf(best.gl, best.hl), leaf(gr, hr)))
            # a node lighter than two children cannot be split
            following += [(m, c) for c, h in zip(children, (best.hl, hr)) if h >= 2 * settings.least_weight]
        fronts = following
        if not fronts:
            break
    return trees


def scored(state: _State) -> DataFrame:
    """(model, draw, label, prediction) of the rows each model left out."""
    light, logistic = _light(state), state.settings.objective == "logistic"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in light.blocks(batches, held_only=True):
            fold = block["fold"]
            value = block["margins"][np.arange(len(fold)), fold]
            value = 1.0 / (1.0 + np.exp(-value)) if logistic else value
            yield pa.RecordBatch.from_arrays([pa.array(fold, pa.int32()), pa.array(block["draw"].view(np.int64)), pa.array(block["label"]), pa.array(value)],
                                             ["model", "draw", "label", "prediction"])

    return state.rows.mapInArrow(work, "model int, draw bigint, label double, prediction double")


Metric = Callable[[DataFrame], DataFrame]
"""From (model, draw, label, prediction) to (model, value)."""


def column_metric(aggregate: Callable[[Column, Column], Column]) -> Metric:
    """A metric from an aggregate of the label and prediction columns; all models in one job."""
    return lambda rows: rows.groupBy("model").agg(aggregate(F.col("label"), F.col("prediction")).alias("value"))


def area_metric(rows: DataFrame) -> DataFrame:
    """Exact area under the ROC curve, ties counting half."""
    counts = rows.groupBy("model", "prediction").agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") != 1).alias("n"))
    few = counts.limit(SCORES + 1).toPandas()
    if len(few) > SCORES:
        return roc_auc(rows, "label", "prediction", by=["model"]).withColumnRenamed("auc", "value")
    areas = []
    for model, part in few.sort_values("prediction").groupby("model"):
        p, n = part["p"].to_numpy(float), part["n"].to_numpy(float)
        pairs = p.sum() * n.sum()
        areas.append((int(model), float((p * (np.cumsum(n) - n / 2)).sum() / pairs) if pairs else None))
    return rows.sparkSession.createDataFrame(areas, "model int, value double")


@dataclass
class History:
    """Held-out metric of each model after every round; the models stop together on the mean."""

    scores: list[list[float]] = field(default_factory=list)
    larger: bool = False

    @property
    def means(self) -> list[float]:
        return [sum(s) / len(s) for s in self.scores]

    @property
    def best(self) -> int:
        """Best round, from 1; the first among equals."""
        means = self.means
        return (max if self.larger else min)(range(len(means)), key=means.__getitem__) + 1 if means else 0


@dataclass
class Boosted:
    """A boosted model: ``base`` margin, trees, the bins they were grown on."""

    settings: Settings
    features: list[str]
    edges: list[np.ndarray]
    base: float
    trees: list[Tree] = field(default_factory=list)
    history: History = field(default_factory=History)

    def transform(self, df: DataFrame, rounds: int | None = None) -> DataFrame:
        """Add ``margin`` and ``prediction``; for the logistic objective also ``probability`` (a vector).

        Without ``rounds`` the best ones are used, or all if no metric was followed.
        """
        shipped(df.sparkSession)
        edges, base, trees = self.edges, self.base, self.trees[: rounds or self.history.best or None]

        @F.pandas_udf("double")
        def margin(values: pd.DataFrame) -> pd.Series:
            bins = binned(values.to_numpy(float, na_value=np.nan), edges)
            out = np.full(len(bins), base)
            for tree in trees:
                out += tree.values(bins)
            return pd.Series(out)

        # numbered fields: columns may have any names
        out = df.withColumn("margin", margin(F.struct(*[_number(c).alias(f"f{i}") for i, c in enumerate(self.features)])))
        if self.settings.objective == "squared":
            return out.withColumn("prediction", F.col("margin"))
        p = 1 / (1 + F.exp(-F.col("margin")))
        return out.withColumns({"probability": array_to_vector(F.array(1 - p, p)), "prediction": (F.col("margin") > 0).cast("double")})

    def importances(self, spark: SparkSession) -> DataFrame:
        """(feature, gain, splits), largest first."""
        total: dict[str, list[float]] = {c: [0.0, 0] for c in self.features}
        for tree in self.trees:
            for feature, gain in zip(tree.feature, tree.gain):
                if feature >= 0:
                    total[self.features[feature]][0] += gain
                    total[self.features[feature]][1] += 1
        return spark.createDataFrame([(c, g, n) for c, (g, n) in total.items()], "feature string, gain double, splits int").orderBy(F.desc("gain"), "feature")

    def save(self, spark: SparkSession, folder: str) -> None:
        """As a table of one row per tree and one row of everything else; any file system."""
        head = {"settings": asdict(self.settings), "features": self.features, "edges": [e.tolist() for e in self.edges], "base": self.base,
                "scores": self.history.scores, "larger": self.history.larger}
        rows = [(-1, json.dumps(head))] + [(i, json.dumps(asdict(t))) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows, "tree int, content string").coalesce(1).write.mode("overwrite").parquet(folder)

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Boosted:
        rows = {r["tree"]: json.loads(r["content"]) for r in spark.read.parquet(folder).collect()}
        head = rows.pop(-1)
        return Boosted(Settings(**head["settings"]), head["features"], [np.array(e, float) for e in head["edges"]], head["base"],
                       [Tree(**rows[i]) for i in sorted(rows)], History(head["scores"], head["larger"]))


def _kept(rows: DataFrame) -> DataFrame:
    return scratch_table(rows).persist(StorageLevel.MEMORY_AND_DISK)


def _inputs(df: DataFrame, features: Sequence[str], label: str, key: str, fold: Column) -> DataFrame:
    """(draw, label, fold, x0, x1, ...), stored: read for the bins, the start and the packed form."""
    columns = [_number(c).alias(f"x{i}") for i, c in enumerate(features)]
    rows = df.where(F.col(label).isNotNull()).select(
        F.xxhash64(F.col(key).cast("string")).alias("draw"), F.col(label).cast("double").alias("label"), fold.cast("int").alias("fold"), *columns)
    cores = df.sparkSession.sparkContext.defaultParallelism
    # a small table in a few parts would leave cores idle in every pass
    return scratch_table(rows.repartition(cores, "draw") if rows.rdd.getNumPartitions() < cores else rows)


def _blocks(inputs: DataFrame, edges: list[np.ndarray], bases: list[float]) -> DataFrame:
    """The packed form of the rows."""
    width = len(edges)
    most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (width + 32)))

    def packed(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        column = lambda c: table.column(c).to_numpy()
        x = np.column_stack([column(f"x{i}").astype(float) for i in range(width)]) if width else np.zeros((table.num_rows, 0))
        return _packed({"draw": column("draw").view(np.uint64), "bins": binned(x, edges), "label": column("label"), "fold": column("fold"),
                        "margins": np.tile(bases, (table.num_rows, 1))})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for begin in range(0, batch.num_rows, most):
                part = batch.slice(begin, most)
                if rows + part.num_rows > most:
                    yield packed(held)
                    held, rows = [], 0
                held.append(part)
                rows += part.num_rows
        if rows:
            yield packed(held)

    return inputs.mapInArrow(work, _ROW)


def _refreshed(state: _State) -> None:
    """Write the margins with the pending trees in them."""
    light = _light(state)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in light.blocks(batches):
            yield _packed(block)

    before, state.rows = state.rows, _kept(state.rows.mapInArrow(work, _ROW))
    discard(before)
    state.pending = []


def _bases(inputs: DataFrame, models: int, objective: str) -> tuple[list[float], float, int]:
    """Starting margin of each model, the largest label distance from it, and the number of rows."""
    parts = inputs.groupBy("fold").agg(
        F.sum("label").alias("sum"), F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).collect()
    bases = []
    for m in range(models):
        mine = [r for r in parts if r["fold"] != m]
        mean = sum(r["sum"] for r in sorted(mine, key=lambda r: r["fold"])) / max(sum(r["n"] for r in mine), 1)
        if objective == "logistic":
            mean = min(max(mean, 1e-6), 1 - 1e-6)
            mean = math.log(mean / (1 - mean))
        bases.append(mean)
    far = 1.0 if objective == "logistic" else max([abs(v - b) for r in parts for v in (r["low"], r["high"]) for b in bases] + [1e-300])
    return bases, far, sum(r["n"] for r in parts)


def _boost(df: DataFrame, features: Sequence[str], label: str, key: str, fold: Column, models: int, settings: Settings,
           metric: Metric | None, patience: int | None, larger: bool, start: Boosted | None) -> tuple[list[Boosted], History]:
    shipped(df.sparkSession)
    if settings.objective not in ("logistic", "squared"):
        raise ValueError(f"unknown objective {settings.objective}")
    features = list(features)
    inputs = _inputs(df, features, label, key, fold)
    edges = start.edges if start else find_edges(inputs, [f"x{i}" for i in range(len(features))], settings.bins)
    bases, far, count = _bases(inputs, models, settings.objective)
    if start:
        bases = [start.base]
    state = _State(_kept(_blocks(inputs, edges, [float(b) for b in bases])), models, len(features), settings)
    fitted = [Boosted(settings, features, edges, b) for b in bases]
    history = History(larger=larger)
    if start:
        fitted[0].trees = list(start.trees)
        history.scores = [list(s) for s in start.history.scores]
        state.pending = [[t] for t in start.trees]
        if start.trees:
            _refreshed(state)
    # sums of all rows stay within 64 bits, with room for margins that overshoot
    bits = min(SCALE_BITS - math.log2(far), TOP_BITS - 3 - math.log2(max(far, 1.0)) - math.log2(max(count, 1)))
    scale = 2.0 ** math.floor(bits)
    try:
        for number in range(len(fitted[0].trees), settings.rounds):
            trees = grow(state, number, scale)
            for model, tree in zip(fitted, trees):
                model.trees.append(tree)
            state.pending.append(trees)
            if metric is not None:
                values = {r["model"]: r["value"] for r in metric(scored(state)).collect()}
                history.scores.append([float(values[m]) for m in range(models) if values.get(m) is not None])
                if patience is not None and len(history.scores) - history.best >= patience:
                    break
            if len(state.pending) >= REFRESH:
                _refreshed(state)
    finally:
        discard(state.rows)
        discard(inputs)
    for model in fitted:
        model.history = history
    return fitted, history


def boost(df: DataFrame, features: Sequence[str], label: str, key: str, settings: Settings, held_out: Column | None = None,
          metric: Metric | None = None, patience: int | None = None, larger: bool = False, start: Boosted | None = None) -> Boosted:
    """Grow trees up to ``settings.rounds``; ``metric`` is taken of the held-out rows after each.

    Stops after ``patience`` rounds without gain. ``start`` is a model to be continued: its bins, base and
    trees are taken over and numbering goes on, so the result equals an uninterrupted fit. Rows without a
    label are left out; an empty training set gives the base only.
    """
    fold = F.lit(-1) if held_out is None else F.when(held_out, 0).otherwise(-1)
    return _boost(df, features, label, key, fold, 1, settings, metric if held_out is not None else None, patience, larger, start)[0][0]


def boost_folds(df: DataFrame, features: Sequence[str], label: str, key: str, fold: str, folds: int, settings: Settings,
                metric: Metric, patience: int | None = None, larger: bool = False) -> tuple[list[Boosted], History]:
    """One model per fold, left out of its training, all grown together: a job per level for all folds."""
    return _boost(df, features, label, key, F.col(fold), folds, settings, metric, patience, larger, None)
