"""Training and prediction jobs on MLlib, and the estimators MLlib lacks."""

from __future__ import annotations

import itertools
import warnings
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier,
    NaiveBayes, OneVsRest, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from millrace.operators.calibration import PairwiseModel, SigmoidModel
from millrace.operators.extra_trees import ExtraTreesClassifier
from millrace.operators.metrics import roc_auc
from millrace.operators.neighbours import pivot_search
from millrace.session import shipped

MAX_DEPTH = 30
"""Deepest tree the library grows."""


@contextmanager
def kept(df: DataFrame):
    """Keep a training frame (memory, then disk) while an iterative fit re-reads it."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def assemble(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(keep..., features): the matrix form estimators read; a null is an error."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error").transform(
        df).select(*keep, "features")


def depth_of(wanted: int | None) -> int:
    """Depth within the limit; deeper (or unlimited) requests are cut with a warning."""
    if wanted is None or wanted > MAX_DEPTH:
        warnings.warn(f"tree depth {wanted} cut to {MAX_DEPTH}", stacklevel=2)
        return MAX_DEPTH
    return wanted


def in_parallel(work, items: Sequence, parallelism: int = 4) -> list:
    """Run independent fits side by side, so small jobs fill the cluster; order is kept."""
    items = list(items)
    if not items:
        return []
    with ThreadPool(min(parallelism, len(items))) as pool:
        return pool.map(work, items)


# classifiers

def random_forest(trees: int, depth: int | None, seed: int, **options) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth_of(depth), seed=seed, **options)


def decision_tree(depth: int | None, seed: int, **options) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=depth_of(depth), seed=seed, **options)


def logistic(reg: float = 0.0, iterations: int = 100, **options) -> LogisticRegression:
    return LogisticRegression(regParam=reg, maxIter=iterations, **options)


def naive_bayes(smoothing: float = 1.0) -> NaiveBayes:
    return NaiveBayes(modelType="multinomial", smoothing=smoothing)


def mlp(inputs: int, classes: int, iterations: int, seed: int, hidden: Sequence[int] = (10, 50)):
    """Dense network inputs-10-50-classes: sigmoid hidden layers, softmax output."""
    return MultilayerPerceptronClassifier(layers=[inputs, *hidden, classes], maxIter=iterations, seed=seed)


def gbt_binary(rounds: int, depth: int, step: float, subsample: float, seed: int,
               feature_share: float = 1.0, validation: str | None = None) -> GBTClassifier:
    """Boosted trees with logistic loss; rows where ``validation`` is true stop the rounds early."""
    booster = GBTClassifier(maxIter=rounds, maxDepth=depth_of(depth), stepSize=step, subsamplingRate=subsample,
                            featureSubsetStrategy=str(feature_share), seed=seed)
    return booster.setValidationIndicatorCol(validation) if validation else booster


def gbt_regression(rounds: int, depth: int, step: float, subsample: float, seed: int,
                   feature_share: float = 1.0, validation: str | None = None) -> GBTRegressor:
    booster = GBTRegressor(maxIter=rounds, maxDepth=depth_of(depth), stepSize=step, subsamplingRate=subsample,
                           featureSubsetStrategy=str(feature_share), seed=seed)
    return booster.setValidationIndicatorCol(validation) if validation else booster


def extra_trees(features: Sequence[str], trees: int, depth: int | None, seed: int, **options) -> Pipeline:
    """Extremely randomised trees over plain columns; a null is an error. See ``operators/extra_trees.py``."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error"),
        ExtraTreesClassifier(trees=trees, maxDepth=depth_of(depth), seed=seed, **options)])


class ExtraTrees:
    """The same with the columns given to ``fit``."""

    def __init__(self, trees: int, depth: int | None, seed: int, **options):
        self.make = lambda features, label: extra_trees(features, trees, depth, seed, labelCol=label, **options)

    def fit(self, df: DataFrame, features: Sequence[str], label: str = "label") -> PipelineModel:
        return self.make(features, label).fit(df)


class CalibratedSVM:
    """One linear SVM per class with Platt scaling of its margin on held-out rows."""

    def __init__(self, classes: int, iterations: int = 50, reg: float = 0.0):
        self.classes, self.iterations, self.reg = classes, iterations, reg

    def fit(self, train: DataFrame, held_out: DataFrame, label: str = "label") -> SigmoidModel:
        with kept(train.select("features", label)) as rows:
            model = OneVsRest(labelCol=label, classifier=LinearSVC(
                maxIter=self.iterations, regParam=self.reg), parallelism=4).fit(rows)
        with kept(held_out.select("features", label)) as held:
            def calibrate(index: int) -> tuple[float, float]:
                one = model.models[index].transform(held).select(
                    array_to_vector(F.array(F.get(vector_to_array("rawPrediction"), F.lit(1)))).alias("margin"),
                    (F.col(label) == index).cast("double").alias("is_class"))
                fitted = LogisticRegression(featuresCol="margin", labelCol="is_class", maxIter=20).fit(one)
                return float(fitted.coefficients[0]), float(fitted.intercept)

            sigmoids = in_parallel(calibrate, range(len(model.models)))
        weights = [m.coefficients.toArray().tolist() for m in model.models]
        return SigmoidModel({"weights": weights, "offsets": [float(m.intercept) for m in model.models], "sigmoids": sigmoids, "features": "features"})


class PairwiseSVM:
    """Linear SVMs for every pair of classes; the class with most wins is predicted."""

    def __init__(self, classes: int, c: float = 1.0, iterations: int = 50):
        self.classes, self.c, self.iterations = classes, c, iterations

    def fit(self, df: DataFrame, label: str = "label") -> PairwiseModel:
        with kept(df.select("features", label)) as rows:
            sizes = {int(r[0]): r[1] for r in rows.groupBy(label).count().collect()}
            pairs = [p for p in itertools.combinations(range(self.classes), 2) if all(sizes.get(k) for k in p)]

            def fit_pair(pair):
                chosen = rows.where(F.col(label).isin(*pair)).select(
                    "features", (F.col(label) == pair[1]).cast("double").alias("label"))
                # C weighs the summed hinge loss against the norm; regParam weighs its mean
                weight = 1.0 / (self.c * (sizes[pair[0]] + sizes[pair[1]]))
                return LinearSVC(maxIter=self.iterations, regParam=weight).fit(chosen)

            members = in_parallel(fit_pair, pairs)
        return PairwiseModel({"pairs": pairs, "classes": self.classes, "features": "features",
                              "weights": [m.coefficients.toArray().tolist() for m in members], "offsets": [float(m.intercept) for m in members]})


# nearest neighbours

def nearest(train: DataFrame, queries: DataFrame, key: str, vector: str, carry: str, k: int, width: int) -> DataFrame:
    """(query, distance, neighbour, carry): the k nearest training rows of every query, exact; ties by key."""
    return pivot_search(train, queries, key, vector, carry, k, width)[0]


def knn_classify(train: DataFrame, queries: DataFrame, key: str, vector: str, label: str, k: int, width: int,
                 weights: str = "uniform") -> DataFrame:
    """(query, prediction, nearest): majority (or 1/distance weighted) vote; smallest label on ties."""
    neighbours = nearest(train, queries, key, vector, label, k, width)
    weight = F.lit(1.0) if weights == "uniform" else 1.0 / F.greatest(F.col("distance"), F.lit(1e-12))
    votes = neighbours.groupBy("query", "carry").agg(F.sum(weight).alias("w"), F.min("distance").alias("d"))
    return votes.groupBy("query").agg(
        F.min(F.struct((-F.col("w")).alias("w"), "carry")).alias("best"), F.min("d").alias("nearest")).select(
        "query", F.col("best.carry").alias("prediction"), "nearest")


# one linear model per group

FACTOR_ROWS = 200_000
"""Rows a task gathers before it reduces them to one triangle per group."""


def fit_group_ols(df: DataFrame, group: str, features: Sequence[str], label: Column,
                  tolerance: float = 1e-10) -> DataFrame:
    """(group, n, intercept, coefficients): least squares per group.

    Tasks reduce their rows of a group to the triangle of a QR factorisation, a few numbers whatever the
    group's size; triangles of a group are stacked and reduced again. Unlike sums of products this does not square
    the condition of the columns. Columns that depend on earlier ones get coefficient 0; a group too
    small for its columns falls back on the mean through the same rule.
    """
    shipped(df.sparkSession)
    columns = [F.col(c).cast("double") for c in features] + [label.cast("double")]
    size = len(columns)
    rows = df.select(F.col(group).alias("_g"), *[c.alias(f"_x{i}") for i, c in enumerate(columns)])
    # one test on all columns: a filter per column makes the optimizer relate them pairwise
    known = F.array_compact(F.array(*[F.col(f"_x{i}") for i in range(size)]))
    rows = rows.where(F.col("_g").isNotNull() & (F.size(known) == size))
    # differences from the overall means lose fewer digits than raw values
    centre = rows.agg(*[F.avg(f"_x{i}") for i in range(size)]).first()
    middle = np.array([float(c or 0.0) for c in centre])
    key = df.schema[group].dataType
    triangles = T.StructType([T.StructField("_g", key), T.StructField("n", T.LongType()), T.StructField("r", T.BinaryType())])
    schema = T.StructType([
        T.StructField(group, key), T.StructField("n", T.LongType()),
        T.StructField("intercept", T.DoubleType()), T.StructField("coefficients", T.ArrayType(T.DoubleType()))])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= FACTOR_ROWS:
                yield factored(held)
                held, count = [], 0
        if count:
            yield factored(held)

    def factored(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        coded = table.column("_g").combine_chunks().dictionary_encode()
        order = np.argsort(coded.indices.to_numpy(), kind="stable")
        code = coded.indices.to_numpy()[order]
        x = np.column_stack([np.ones(len(code)), *[table.column(f"_x{i}").to_numpy()[order] - middle[i] for i in range(size)]])
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(code)) + 1, [len(code)]])
        parts = [np.linalg.qr(x[a:b], mode="r") for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(code[cuts[:-1]])), pa.array(np.diff(cuts)), pa.array([r.tobytes() for r in parts], pa.binary())],
                                          ["_g", "n", "r"])

    def solve(table: pa.Table) -> pa.Table:
        n = pc.sum(table.column("n")).as_py()
        stack = np.vstack([np.frombuffer(r).reshape(-1, size + 1) for r in sorted(table.column("r").to_pylist())])
        whole = np.linalg.qr(stack, mode="r") if len(stack) > size + 1 else stack
        used: list[int] = [0]
        for j in range(1, size):
            if len(used) >= n:
                break
            left = np.linalg.qr(whole[:, [*used, j]], mode="r")
            if len(left) > len(used) and abs(left[len(used), -1]) > tolerance * np.linalg.norm(whole[:, j]):
                used.append(j)
        left = np.linalg.qr(whole[:, [*used, size]], mode="r")
        k = len(used)
        found = np.linalg.solve(left[:k, :k], left[:k, k])
        solved = np.zeros(size)
        solved[used] = found
        intercept = solved[0] + middle[-1] - solved[1:] @ middle[:-1]
        return pa.table({group: table.column("_g").slice(0, 1), "n": pa.array([n], pa.int64()), "intercept": pa.array([float(intercept)]),
                         "coefficients": pa.array([solved[1:].tolist()], pa.list_(pa.float64()))})

    return rows.mapInArrow(reduce, triangles).groupBy("_g").applyInArrow(solve, schema)


def predict_group_ols(df: DataFrame, models: DataFrame, group: str, features: Sequence[str],
                      name: str = "prediction") -> DataFrame:
    """Add each row's prediction by its group's model (null for a group without one)."""
    joined = df.join(models.select(group, "intercept", "coefficients"), group, "left")
    value = F.col("intercept")
    for i, c in enumerate(features):
        value = value + F.get("coefficients", F.lit(i)) * F.col(c)
    return joined.withColumn(name, value).drop("intercept", "coefficients")


# predictions and importances

def probability_columns(df: DataFrame, names: Sequence[str], column: str = "probability") -> DataFrame:
    """One column per class name in place of the probability vector."""
    cells = vector_to_array(column) if df.schema[column].dataType.typeName() != "array" else F.col(column)
    return df.select(*[c for c in df.columns if c != column],
                     *[F.get(cells, F.lit(i)).alias(name) for i, name in enumerate(names)])


def positive_probability(column: str = "probability") -> Column:
    return F.get(vector_to_array(column), F.lit(1))


def importances(model, features: Sequence[str], df: DataFrame) -> DataFrame:
    """(feature, importance), largest first."""
    rows = [(name, float(value)) for name, value in zip(features, model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")


def _with_trees(model, df: DataFrame, rounds: int, keep: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """Predictions of the first trees side by side, and the running margin after each."""
    scored = df.select(*keep, "features")
    margins, total = [], F.lit(0.0)
    for i, (tree, weight) in enumerate(zip(model.trees[:rounds], model.treeWeights)):
        scored = tree.copy().setPredictionCol(f"_t{i}").transform(scored)
        total = total + F.col(f"_t{i}") * F.lit(float(weight))
        margins.append(total)
    return scored, margins


def rounds_margin(model, df: DataFrame, rounds: int, keep: Sequence[str]) -> DataFrame:
    """(keep..., margin): the boosted sum after the first ``rounds`` trees."""
    scored, margins = _with_trees(model, df, rounds, keep)
    return scored.select(*keep, margins[-1].alias("margin"))


def auc_by_round(model, valid: DataFrame, key: str, label: str = "label") -> DataFrame:
    """(round, auc) of a boosted binary model after every round, in one job."""
    scored, margins = _with_trees(model, valid, len(model.treeWeights), [key, label])
    cells = [F.struct(F.lit(i + 1).alias("round"), m.alias("margin")) for i, m in enumerate(margins)]
    long = scored.select(key, label, F.explode(F.array(*cells)).alias("r")).select(key, label, "r.*")
    return roc_auc(long, label, "margin", by=["round"])


def best_round(scores: Sequence[float], patience: int, larger: bool) -> int:
    """1-based round with the best score, looking no further than ``patience`` rounds without gain."""
    best = 0
    for i, score in enumerate(scores):
        if (score > scores[best]) if larger else (score < scores[best]):
            best = i
        elif i - best >= patience:
            break
    return best + 1
