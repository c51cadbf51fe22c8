"""Probabilities from scores by isotonic regression, and linear SVMs calibrated by cross validation.

Isotonic steps are found by pooling adjacent violators: scores are counted, cut into ranges, each range is pooled in its
own task, and the steps of the ranges, in order, are pooled again. Pooling a range first changes nothing, so the
result is that of one pass over all scores. Many groups (fold, class) share the jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions.hashing import hash_number
from millrace.operators import blocks as K
from millrace.operators.ordered import split_points, tag_range
from millrace.operators.stored_models import StoredModel
from millrace.session import discard, scratch_table, shipped


def pooled(low: np.ndarray, high: np.ndarray, total: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Steps (low, high, sum, weight) whose means rise, from steps in the order of scores."""
    stack: list[list[float]] = []
    for a, b, s, w in zip(low.tolist(), high.tolist(), total.tolist(), weight.tolist()):
        stack.append([a, b, s, w])
        # equal means are one step, so the steps do not depend on where ranges were cut
        while len(stack) > 1 and stack[-2][2] * stack[-1][3] >= stack[-1][2] * stack[-2][3]:
            _, b, s, w = stack.pop()
            stack[-1][1], stack[-1][2], stack[-1][3] = b, stack[-1][2] + s, stack[-1][3] + w
    return tuple(np.array(stack, float).reshape(-1, 4).T)


def isotonic_steps(df: DataFrame, score: str, label: str, by: Sequence[str] = (), ranges: int | None = None) -> dict[tuple, dict[str, list[float]]]:
    """For each group the scores at both ends of its rising steps and their values, as ``x`` and ``y``.

    ``label`` is 0 or 1 (or a share). Rows without score are left out. Only steps come to the driver.
    """
    by = list(by)
    known = df.where(F.col(score).isNotNull() & ~F.isnan(score)).select(*by, F.col(score).cast("double").alias("_x"), F.col(label).cast("double").alias("_y"))
    points = split_points(known, "_x", ranges)
    counts = tag_range(known.groupBy(*by, "_x").agg(F.sum("_y").alias("s"), F.count("*").cast("double").alias("w")), "_x", points)
    keys = [*by, "_range"]
    schema = T.StructType([*[known.schema[b] for b in by], T.StructField("_range", T.IntegerType()), *[T.StructField(c, T.DoubleType()) for c in ("low", "high", "s", "w")]])

    def pool(table: pa.Table) -> pa.Table:
        table = table.sort_by("_x")
        x = table.column("_x").to_numpy()
        steps = pooled(x, x, table.column("s").to_numpy(), table.column("w").to_numpy())
        first = {k: pa.array([table.column(k)[0].as_py()] * len(steps[0]), table.schema.field(k).type) for k in keys}
        return pa.table({**first, **{c: pa.array(v) for c, v in zip(("low", "high", "s", "w"), steps)}})

    groups: dict[tuple, list] = {}
    for r in counts.groupBy(*keys).applyInArrow(pool, schema).collect():
        groups.setdefault(tuple(r[b] for b in by), []).append((r["low"], r["high"], r["s"], r["w"]))
    out = {}
    for group, steps in groups.items():
        low, high, total, weight = pooled(*np.array(sorted(steps)).T)
        ends = np.column_stack([low, high]).ravel()
        values = np.repeat(total / weight, 2)
        single = np.concatenate([[True], np.diff(ends) > 0])  # a step of one score has one end
        out[group] = {"x": ends[single].tolist(), "y": values[single].tolist()}
    return out


def stepped(steps: dict[str, list[float]] | None, score: np.ndarray) -> np.ndarray:
    """Values between the steps are interpolated, beyond them those of the last step."""
    if not steps or not steps["x"]:
        return np.full(len(score), 0.5)
    return np.interp(score, steps["x"], steps["y"])


class _Linear(StoredModel):
    """Margins of many linear models in one pass over a vector column."""

    def margins(self, work, kind: str, column: Column) -> Column:
        weights, offset = np.array(self.content["weights"], float), np.array(self.content["offsets"], float)

        @F.arrow_udf(kind)
        def score(vectors: pa.Array) -> pa.Array:
            starts, columns, values = K.sparse_rows(vectors)
            n = len(vectors)
            block = K.Block(weights.shape[1], {"starts": starts, "columns": columns, "values": values, "label": np.zeros(n), "fold": np.zeros(n, int),
                                               "draw": np.zeros(n, np.uint64)})
            out = work(block.times(weights.T) + offset)
            return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * out.shape[1], pa.array(out.ravel()))

        return score(F.unwrap_udt(column))


class CrossCalibratedSVM(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Linear SVMs, one per class, each fold's calibrated by isotonic regression on the rows it left out.

    The probability of a class is the mean over folds of its calibrated value over the sum for all classes. Folds are
    drawn by a hash of ``keyCol``.
    """

    classes = Param(Params._dummy(), "classes", "number of classes", TypeConverters.toInt)
    folds = Param(Params._dummy(), "folds", "number of folds", TypeConverters.toInt)
    maxIter = Param(Params._dummy(), "maxIter", "iterations of each fit", TypeConverters.toInt)
    regParam = Param(Params._dummy(), "regParam", "penalty", TypeConverters.toFloat)
    keyCol = Param(Params._dummy(), "keyCol", "row key", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, classes: int = 2, folds: int = 3, maxIter: int = 50, regParam: float = 0.0, keyCol: str = "id", featuresCol: str = "features",
                 labelCol: str = "label"):
        super().__init__()
        self._setDefault(classes=2, folds=3, maxIter=50, regParam=0.0, keyCol="id", featuresCol="features", labelCol="label")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> CrossCalibratedSVMModel:
        from millrace.operators.models import in_parallel

        v = {p.name: self.getOrDefault(p) for p in self.params}
        shipped(dataset.sparkSession)
        fold = (hash_number(v["keyCol"], "calibration") % v["folds"]).cast("int")
        rows = scratch_table(dataset.select(F.col(v["featuresCol"]).alias("features"), F.col(v["labelCol"]).cast("double").alias("label"), fold.alias("fold")))
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        jobs = [(f, k) for f in range(v["folds"]) for k in range(v["classes"])]

        def fit(job):
            learn = rows.where(F.col("fold") != job[0]).select("features", (F.col("label") == job[1]).cast("double").alias("label"))
            # a class that a fold's rows lack (or all have) leaves nothing to separate
            if learn.select("label").distinct().count() < 2:
                return None
            return LinearSVC(maxIter=v["maxIter"], regParam=v["regParam"]).fit(learn)

        try:
            members = in_parallel(fit, jobs)
            width = K.width_of(rows, "features")
            weights = [m.coefficients.toArray().tolist() if m else [0.0] * width for m in members]
            offsets = [float(m.intercept) if m else 0.0 for m in members]
            model = CrossCalibratedSVMModel({"weights": weights, "offsets": offsets, "classes": v["classes"], "folds": v["folds"], "features": v["featuresCol"], "steps": []})
            # a row's own fold: the margins of the models that left it out
            every = model.margins(lambda m: m, "array<double>", F.col("features"))
            own = F.slice(every, F.col("fold") * v["classes"] + 1, v["classes"])
            held = rows.select("fold", "label", F.posexplode(own).alias("class", "score"))
            steps = isotonic_steps(held.withColumn("is_class", (F.col("label") == F.col("class")).cast("double")), "score", "is_class", ["fold", "class"])
        finally:
            discard(rows)
        model.content["steps"] = [steps.get(job) for job in jobs]
        return model


class CrossCalibratedSVMModel(_Linear):
    """Adds ``probability`` (a vector that sums to 1) and ``prediction``."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shipped(dataset.sparkSession)
        steps, classes, folds = self.content["steps"], self.content["classes"], self.content["folds"]

        def chances(margin: np.ndarray) -> np.ndarray:
            p = np.column_stack([stepped(s, margin[:, i]) for i, s in enumerate(steps)]).reshape(len(margin), folds, classes)
            whole = p.sum(axis=2, keepdims=True)
            return np.where(whole > 0, p / np.where(whole > 0, whole, 1), 1 / classes).mean(axis=1)

        found = dataset.withColumn("_chances", self.margins(chances, "array<double>", F.col(self.content["features"])))
        place = (F.array_position("_chances", F.array_max("_chances")) - 1).cast("double")
        return found.withColumns({"probability": array_to_vector("_chances"), "prediction": place}).drop("_chances")


class PairwiseModel(_Linear):
    """Adds ``votes`` of the pairs' models for each class and ``prediction`` (smallest class among ties)."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shipped(dataset.sparkSession)
        pairs, classes = self.content["pairs"], self.content["classes"]

        def votes(margin: np.ndarray) -> np.ndarray:
            out = np.zeros((len(margin), classes), np.int32)
            for i, (a, b) in enumerate(pairs):
                out[:, a] += margin[:, i] <= 0
                out[:, b] += margin[:, i] > 0
            return out

        found = dataset.withColumn("votes", self.margins(votes, "array<int>", F.col(self.content["features"])))
        return found.withColumn("prediction", (F.array_position("votes", F.array_max("votes")) - 1).cast("double"))


class SigmoidModel(_Linear):
    """Adds ``probability`` (array, sums to 1) and ``prediction`` from one sigmoid per class."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shipped(dataset.sparkSession)
        slope, shift = (np.array(self.content["sigmoids"], float)[:, i] for i in (0, 1))

        def chances(margin: np.ndarray) -> np.ndarray:
            p = 1 / (1 + np.exp(-(margin * slope + shift)))
            return p / p.sum(axis=1, keepdims=True)

        found = dataset.withColumn("probability", self.margins(chances, "array<double>", F.col(self.content["features"])))
        return found.withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("double"))
