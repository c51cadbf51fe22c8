"""Parameter searches, cross validation and model comparison."""

from __future__ import annotations

import itertools
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from statistics import mean, pstdev

from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame, functions as F

from millrace.operators.metrics import mean_roc, roc_auc
from millrace.operators.models import in_parallel, kept, positive_probability


def grid(choices: Mapping[object, Sequence]) -> list[dict]:
    """Every combination of the listed parameter values."""
    names = list(choices)
    return [dict(zip(names, values)) for values in itertools.product(*choices.values())]


def draws(choices: Mapping[object, Sequence], n: int, seed: int) -> list[dict]:
    """``n`` different random combinations (all of them if there are fewer)."""
    draw = random.Random(seed)
    every = 1
    for values in choices.values():
        every *= len(values)
    picked = draw.sample(range(every), min(n, every))
    combos = []
    for number in picked:
        combo = {}
        for name, values in choices.items():
            number, place = divmod(number, len(values))
            combo[name] = values[place]
        combos.append(combo)
    return combos


@dataclass
class SearchResult:
    """Scores of every candidate over the folds, and the best one fitted on all rows."""

    candidates: list[dict]
    scores: list[list[float]]
    best: int
    best_model: Model

    def table(self, spark) -> DataFrame:
        """(candidate, params, mean, std)."""
        rows = []
        for i, (params, scores) in enumerate(zip(self.candidates, self.scores)):
            text = ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda kv: kv[0].name))
            rows.append((i, text, mean(scores), pstdev(scores)))
        return spark.createDataFrame(rows, "candidate int, params string, mean double, std double")


def search(df: DataFrame, estimator: Estimator, candidates: Sequence[dict], evaluator: Evaluator, fold: str,
           folds: int, parallelism: int = 4) -> SearchResult:
    """Cross validation over parameter maps on the fold numbers in ``fold``; the best is refitted.

    Folds are plain filters on a column, so no row passes through Python; ``parallelism``
    candidates train at the same time on the cluster.
    """
    scores: list[list[float]] = [[] for _ in candidates]
    with kept(df) as rows:
        for number in range(folds):
            held = rows.where(F.col(fold) == number)
            with kept(rows.where(F.col(fold) != number)) as train:
                def run(params, train=train, held=held):
                    return float(evaluator.evaluate(estimator.fit(train, params).transform(held)))

                for i, score in enumerate(in_parallel(run, candidates, parallelism)):
                    scores[i].append(score)
        means = [mean(s) for s in scores]
        pick = max if evaluator.isLargerBetter() else min
        best = pick(range(len(candidates)), key=means.__getitem__)
        return SearchResult(list(candidates), scores, best, estimator.fit(rows, candidates[best]))


def fold_scores(df: DataFrame, estimator: Estimator, evaluator: Evaluator, fold: str, folds: int):
    """[(fold, score, model)]: each fold scored by a model fitted on the others; all models kept."""
    with kept(df) as rows:
        def run(number: int):
            model = estimator.fit(rows.where(F.col(fold) != number))
            score = evaluator.evaluate(model.transform(rows.where(F.col(fold) == number)))
            return number, float(score), model

        return in_parallel(run, range(folds))


def train_best_fold(df: DataFrame, estimator: Estimator, key: str, label: str, fold: str, folds: int):
    """(best model by AUC on its own held-out fold, fold scores, mean ROC curve).

    The held-out scores of all folds are stacked, so all areas come from one job.
    """
    with kept(df) as rows:
        models = in_parallel(lambda n: estimator.fit(rows.where(F.col(fold) != n)), range(folds))
        parts = None
        for number, model in enumerate(models):
            scored = model.transform(rows.where(F.col(fold) == number)).select(
                key, label, fold, positive_probability().alias("score"))
            parts = scored if parts is None else parts.unionByName(scored)
        with kept(parts) as held:
            areas = {row[fold]: row["auc"] for row in roc_auc(held, label, "score", [fold]).collect()}
            curve = mean_roc(held, fold, label, "score").collect()
    best = max(range(folds), key=areas.__getitem__)
    return models[best], sorted(areas.items()), curve


def compare(train: DataFrame, valid: DataFrame, candidates: Mapping[str, Estimator], evaluator: Evaluator):
    """[(name, score, model)], best first by the evaluator's direction."""
    with kept(train) as rows, kept(valid) as held:
        def run(item):
            model = item[1].fit(rows)
            return item[0], float(evaluator.evaluate(model.transform(held))), model

        scored = in_parallel(run, list(candidates.items()))
    return sorted(scored, key=lambda s: s[1], reverse=evaluator.isLargerBetter())


def top_feature_union(models: Sequence, features: Sequence[str], n: int = 15) -> list[str]:
    """Union of the n most important features of every model that reports importances."""
    union: set[str] = set()
    for model in models:
        if hasattr(model, "featureImportances"):
            weights = model.featureImportances.toArray()
            order = sorted(range(len(features)), key=lambda i: (-weights[i], features[i]))
            union.update(features[i] for i in order[:n])
    return sorted(union)


def slice_features(df: DataFrame, features: Sequence[str], wanted: Sequence[str]) -> DataFrame:
    """``features`` vector reduced to the wanted columns."""
    slicer = VectorSlicer(inputCol="features", outputCol="_sliced",
                          indices=sorted(list(features).index(w) for w in wanted))
    return slicer.transform(df).drop("features").withColumnRenamed("_sliced", "features")


def boosting_rounds(df: DataFrame, booster: Estimator, fold: str, folds: int, loss: str | None = None):
    """(best number of rounds, mean held-out loss per round) over the folds."""
    with kept(df) as rows:
        def run(number: int) -> list[float]:
            model = booster.fit(rows.where(F.col(fold) != number))
            held = rows.where(F.col(fold) == number)
            return model.evaluateEachIteration(held, loss) if loss else model.evaluateEachIteration(held)

        curves = in_parallel(run, range(folds))
    length = min(len(c) for c in curves)
    means = [sum(c[i] for c in curves) / len(curves) for i in range(length)]
    return min(range(length), key=means.__getitem__) + 1, means
