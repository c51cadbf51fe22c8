"""Averaging, picking and stacking of model runs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Estimator
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from millrace.operators.metrics import log_loss_multiclass
from millrace.operators.models import in_parallel, kept
from millrace.operators.stored_models import StoredModel


def average_runs(runs: DataFrame, key: str, score: str, run: str, denominator: str = "present") -> DataFrame:
    """Mean score per key. ``files`` divides by the number of runs even where one lacks the key."""
    if denominator == "present":
        return runs.groupBy(key).agg(F.avg(score).alias(score))
    if denominator != "files":
        raise ValueError(f"unknown denominator {denominator}")
    n = runs.select(run).distinct().count()
    return runs.groupBy(key).agg((F.sum(score) / F.lit(n)).alias(score))


def average_best_worst(runs: DataFrame, scores: DataFrame, key: str, run: str, value: str, score: str,
                       n: int = 3) -> DataFrame:
    """Mean over the runs whose score is among the n lowest or the n highest; ties join in."""
    low = [r[0] for r in scores.orderBy(score).limit(n).select(score).collect()]
    high = [r[0] for r in scores.orderBy(F.desc(score)).limit(n).select(score).collect()]
    picked = scores.where(F.col(score).isin(low + high)).select(run).distinct()
    return runs.join(picked, run, "left_semi").groupBy(key).agg(F.avg(value).alias(value))


def seed_runs(train: DataFrame, test: DataFrame, make: Callable[[int], Estimator], key: str, runs: int,
              seed: int, increment: int, score) -> DataFrame:
    """(key, run, p): the same estimator fitted with seeds seed + i * increment."""
    with kept(train) as rows:
        models = in_parallel(lambda i: make(seed + i * increment).fit(rows), range(1, runs + 1))
    stacked = None
    for i, model in enumerate(models, start=1):
        part = model.transform(test).select(key, F.lit(i).alias("run"), score.alias("p"))
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked


class Stack:
    """Out-of-fold probabilities of several models feed a logistic blender."""

    def __init__(self, candidates: Mapping[str, Estimator], folds: int, iterations: int = 100):
        self.candidates, self.folds, self.iterations = dict(candidates), folds, iterations
        self.model: StackModel | None = None

    def fit(self, df: DataFrame, key: str, label: str, fold: str) -> DataFrame:
        """Fit all models; returns the out-of-fold table, one row per key.

        Every row is scored only by models that never saw it. A row is scored by all
        candidates of its fold in one pass, so no join brings the candidates together.
        """
        stacked = None
        names = list(self.candidates)
        with kept(df) as rows:
            jobs = [(name, number) for number in range(self.folds) for name in names]
            fitted = dict(zip(jobs, in_parallel(
                lambda job: self.candidates[job[0]].fit(rows.where(F.col(fold) != job[1])), jobs)))
            for number in range(self.folds):
                part = _scored(rows.where(F.col(fold) == number).select(key, label, "features"),
                               {name: [fitted[name, number]] for name in names}, [key, label])
                stacked = part if stacked is None else stacked.unionByName(part)
            blender = LogisticRegression(labelCol=label, maxIter=self.iterations).fit(_level_one(stacked, names))
        self.model = StackModel({"names": names, "folds": self.folds},
                                {"blender": blender, **{f"{name}-{number}": fitted[name, number] for name, number in jobs}})
        return stacked

    def transform(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """Blend of the mean over folds of every candidate: ``probability`` and ``prediction``."""
        return self.model.blend(df, keep)


class StackModel(StoredModel):
    """The fitted members of a stack and its blender; stored with all of them."""

    def blend(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        names = self.content["names"]
        models = {name: [self.members[f"{name}-{number}"] for number in range(self.content["folds"])] for name in names}
        scored = _scored(df.select(*keep, "features"), models, list(keep))
        return self.members["blender"].transform(_level_one(scored, names)).select(*keep, "probability", "prediction")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """All columns with ``probability`` and ``prediction``; needs a vector column ``features``."""
        whole = dataset.withColumn("_row", F.struct(*dataset.columns))
        return self.blend(whole, ["_row"]).select("_row.*", "probability", "prediction")


def _scored(df: DataFrame, models: Mapping[str, list], keep: list[str]) -> DataFrame:
    scored, done = df, []
    for name, members in models.items():
        for number, model in enumerate(members):
            cell = f"_{name}_{number}"
            scored = model.transform(scored).select(
                *keep, "features", *done, vector_to_array("probability").alias(cell))
            done.append(cell)
        total = F.col(f"_{name}_0")
        for number in range(1, len(members)):
            total = F.zip_with(total, F.col(f"_{name}_{number}"), lambda a, b: a + b)
        scored = scored.withColumn(f"_mean_{name}", F.transform(total, lambda v: v / len(members)))
        done = [c for c in done if not c.startswith(f"_{name}_")] + [f"_mean_{name}"]
        scored = scored.select(*keep, "features", *done)
    return scored.select(*keep, *[F.col(f"_mean_{n}").alias(n) for n in models])


def _level_one(scored: DataFrame, names: Sequence[str]) -> DataFrame:
    vectors = scored.withColumns({f"_v_{n}": array_to_vector(n) for n in names})
    return VectorAssembler(inputCols=[f"_v_{n}" for n in names], outputCol="features").transform(
        vectors).drop(*names, *[f"_v_{n}" for n in names])


def multiclass_loss(df: DataFrame, label: str = "label", probability: str = "probability") -> float:
    return float(df.agg(log_loss_multiclass(F.col(label), vector_to_array(probability))).first()[0])


def choose_lower(single: tuple[str, float, object], blend: tuple[str, float, object]) -> tuple[str, float, object]:
    """The candidate with the lower loss; the blend on a tie."""
    return single if single[1] < blend[1] else blend
