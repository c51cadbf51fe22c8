"""Logistic regressions of many folds and penalties in one fit.

The weights of all (fold, penalty) pairs, and of every penalty over all rows, are columns of one matrix. A
step is one pass: each task sums the losses, slopes and curvatures of all columns over its rows. Newton steps
with halving follow; wide inputs take accelerated gradient steps instead. The strongest penalty is solved first and the
others start from its weights, so the number of jobs does not depend on how many candidates there are.

The loss is the mean log loss plus half the penalty times the squared weights of the columns divided by their deviation
over the rows learned from; the intercept is free.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import blocks as K
from millrace.operators.stored_models import StoredModel
from millrace.session import discard, shipped

NEWTON_WIDTH = 400
CURVATURES = 8_000_000
"""Numbers that a task sums for the curvatures of the candidates solved together."""


class LinearClassifier(StoredModel):
    """Adds ``margin``, ``probability`` (a vector) and ``prediction`` from weights and an intercept."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shipped(dataset.sparkSession)
        weights, intercept = np.array(self.content["weights"]), self.content["intercept"]

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            return pd.Series(np.stack(x.to_numpy()) @ weights + intercept if len(x) else [], dtype=float)

        p = 1 / (1 + F.exp(-F.col("margin")))
        return dataset.withColumn("margin", margin(vector_to_array(self.content["features"]))).withColumns(
            {"probability": array_to_vector(F.array(1 - p, p)), "prediction": (F.col("margin") > 0).cast("double")})


@dataclass
class PathResult:
    """Held-out mean log loss by penalty and fold, the best penalty, models over all rows, weights of every fold."""

    penalties: list[float]
    losses: np.ndarray
    best: int
    models: list[LinearClassifier]
    fold_weights: np.ndarray
    steps: int

    @property
    def model(self) -> LinearClassifier:
        return self.models[self.best]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(float(p), k, float(self.losses[i, k]), i == self.best) for i, p in enumerate(self.penalties) for k in range(self.losses.shape[1])]
        return spark.createDataFrame(rows, "penalty double, fold int, log_loss double, is_best boolean")


def _losses(margin: np.ndarray, label: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, margin) - label[:, None] * margin


class _Problem:
    """All candidates over packed rows, in units of each column's deviation over all rows."""

    def __init__(self, rows: DataFrame, width: int, folds: int):
        self.rows, self.width, self.folds = rows, width, folds
        shape = (folds + 1, width)

        def moments(block: K.Block):
            member = np.zeros((len(block), folds + 1))
            member[np.arange(len(block)), np.where(block.fold < 0, folds, block.fold)] = 1
            squared = K.Block(width, {**block.parts, "values": block.parts["values"] ** 2})
            return member.sum(axis=0), block.gathered(member).T, squared.gathered(member).T, member.T @ block.label

        n, s, q, y = K.summed(rows, width, moments, [(folds + 1,), shape, shape, (folds + 1,)])
        total = n.sum()
        self.center = s.sum(axis=0) / max(total, 1)
        self.n = np.append(total - n[:folds], total)
        self.positive = np.append(y.sum() - y[:folds], y.sum())
        means = np.vstack([s.sum(axis=0) - s[:folds], s.sum(axis=0)]) / np.maximum(self.n, 1)[:, None]
        spread = np.vstack([q.sum(axis=0) - q[:folds], q.sum(axis=0)]) / np.maximum(self.n, 1)[:, None] - means ** 2
        self.deviation = np.sqrt(np.maximum(spread, 0) * (self.n / np.maximum(self.n - 1, 1))[:, None])
        self.held = n[:folds]
        self.scale = np.where(self.deviation[-1] > 1e-12, self.deviation[-1], 1.0)

    def passes(self, group: np.ndarray, weights: np.ndarray, curved: bool):
        """Sums for candidates (numbers of left-out folds, ``folds`` for none): loss, held-out loss, slopes, curvatures."""
        center, scale, width, count = self.center, self.scale, self.width, len(group)
        raw = weights[:, :-1] / scale
        offset = weights[:, -1] - raw @ center

        def sums(block: K.Block):
            margin = block.times(raw.T) + offset
            learn = block.fold[:, None] != group[None, :]
            loss = _losses(margin, block.label)
            p = 1 / (1 + np.exp(-margin))
            error = np.where(learn, p - block.label[:, None], 0.0)
            slope = np.vstack([(block.gathered(error) - np.outer(center, error.sum(axis=0))) / scale[:, None], error.sum(axis=0)])
            out = [(loss * learn).sum(axis=0), (loss * ~learn).sum(axis=0), slope.T]
            if curved:
                z = np.column_stack([(block.dense() - center) / scale, np.ones(len(block))])
                out.append(np.stack([(z * w[:, None]).T @ z for w in np.where(learn, p * (1 - p), 0.0).T]))
            return out

        shapes = [(count,), (count,), (count, width + 1)] + ([(count, width + 1, width + 1)] if curved else [])
        return K.summed(self.rows, width, sums, shapes)

    def solve(self, group: np.ndarray, penalties: np.ndarray, weights: np.ndarray, steps: int, close: float) -> tuple[np.ndarray, np.ndarray, int]:
        """(weights, mean held-out loss, passes) at the optimum of every candidate."""
        curved = self.width <= NEWTON_WIDTH
        n = np.maximum(self.n[group], 1)[:, None]
        ridge = np.column_stack([penalties[:, None] * (self.deviation[group] / self.scale) ** 2, np.zeros(len(group))])
        curvature = None if curved else 0.25 * (self._steepest() + 1) + ridge.max(axis=1, keepdims=True)
        last, value, move = weights.copy(), np.full(len(group), np.inf), np.zeros_like(weights)
        ahead, speed = weights.copy(), np.ones(len(group))
        used = 0
        while True:
            loss, held, slope, *more = self.passes(group, ahead, curved)
            used += 1
            current = loss / n[:, 0] + 0.5 * (ridge * ahead * ahead).sum(axis=1)
            slope = slope / n + ridge * ahead
            done = np.abs(slope).max(axis=1) < close
            if done.all() or used >= steps:
                held_rows = np.array([self.held[f] if f < self.folds else 1 for f in group])
                return ahead, held / np.maximum(held_rows, 1), used
            if curved:
                worse = current > value + 1e-12
                move[worse] /= 2  # the last step was too long
                ok = ~worse
                last[ok], value[ok] = ahead[ok], current[ok]
                for c in np.flatnonzero(ok & ~done):
                    move[c] = -np.linalg.lstsq(more[0][c] / n[c] + np.diag(ridge[c]), slope[c], rcond=1e-12)[0]
                move[done & ok] = 0
                ahead = last + move
            else:
                new = ahead - slope / curvature
                back = ((ahead - new) * (new - last)).sum(axis=1) > 0  # speed is lost when the slope turns
                faster = np.where(back, 1.0, (1 + np.sqrt(1 + 4 * speed ** 2)) / 2)
                push = np.where(back, 0.0, (speed - 1) / faster)[:, None]
                ahead, last, speed = new + push * (new - last), new, faster

    def _steepest(self) -> float:
        """Largest eigenvalue of the scaled columns' second moments, from above, by power iteration."""
        center, scale = self.center, self.scale
        v, top = np.ones((self.width, 1)) / np.sqrt(self.width), 1.0
        for _ in range(10):
            raw = v / scale[:, None]

            def product(block: K.Block, raw=raw):
                inner = block.times(raw) - center @ raw
                return [(block.gathered(inner) - np.outer(center, inner.sum(axis=0))) / scale[:, None]]

            out = K.summed(self.rows, self.width, product, [(self.width, 1)])[0] / max(self.n[-1], 1)
            top = float(np.linalg.norm(out))
            v = out / max(top, 1e-300)
        return 1.2 * top


def logistic_path(df: DataFrame, penalties: Sequence[float], key: str, fold: str, folds: int, features: str = "features", label: str = "label",
                  steps: int = 100, close: float = 1e-9) -> PathResult:
    """Fit every penalty on the rows outside each fold, and on all rows; score it on the fold.

    Rows without a label or vector are left out. The penalty with the least mean held-out loss is best, the stronger one among
    equals.
    """
    penalties = [float(p) for p in penalties]
    width = K.width_of(df, features)
    rows = K.pack(df, features, label, key, width, F.col(fold))
    try:
        problem = _Problem(rows, width, folds)
        start = np.zeros((folds + 1, width + 1))
        rate = np.clip(problem.positive / np.maximum(problem.n, 1), 1e-9, 1 - 1e-9)
        start[:, -1] = np.log(rate / (1 - rate))
        every = np.arange(folds + 1)
        order = sorted(range(len(penalties)), key=lambda i: -penalties[i])
        weights, held = np.zeros((len(penalties), folds + 1, width + 1)), np.zeros((len(penalties), folds + 1))
        strongest, others = order[0], order[1:]
        weights[strongest], held[strongest], used = problem.solve(every, np.full(folds + 1, penalties[strongest]), start, steps, close)
        together = max(1, CURVATURES // ((folds + 1) * (width + 1) ** 2)) if width <= NEWTON_WIDTH else len(penalties)
        for begin in range(0, len(others), together):
            some = others[begin: begin + together]
            group = np.tile(every, len(some))
            found, losses, more = problem.solve(group, np.repeat([penalties[i] for i in some], folds + 1), np.tile(weights[strongest], (len(some), 1)), steps, close)
            weights[some], held[some] = found.reshape(len(some), folds + 1, -1), losses.reshape(len(some), -1)
            used += more
    finally:
        discard(rows)
    raw = weights.copy()
    raw[..., :-1] /= problem.scale
    raw[..., -1] -= raw[..., :-1] @ problem.center
    losses = held[:, :folds]
    best = min(order, key=lambda i: losses[i].mean())
    models = [LinearClassifier({"weights": w[folds, :-1].tolist(), "intercept": float(w[folds, -1]), "features": features, "penalty": p})
              for w, p in zip(raw, penalties)]
    return PathResult(penalties, losses, best, models, raw[:, :folds], used)
