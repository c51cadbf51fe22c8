"""Extra trees against a plain numpy version with the same draws; stored models."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from millrace.operators import extra_trees as X


@pytest.fixture(scope="module")
def data():
    draw = np.random.default_rng(8)
    x = draw.normal(size=(400, 5))
    x[:, 3] = np.round(x[:, 3])
    x[:, 4] = 7.0
    y = np.where(x[:, 0] + x[:, 1] > 0.5, 2, (x[:, 2] > 0).astype(int))
    return x, y


@pytest.fixture(scope="module")
def frame(spark, data):
    x, y = data
    rows = [(i, *map(float, r), float(k)) for i, (r, k) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, c double, d double, e double, label double").repartition(4)
    return VectorAssembler(inputCols=list("abcde"), outputCol="features").transform(df).cache()


def plain(x, y, tree, seed, columns, depth, kind, path=1):
    """Nested (column, threshold, left, right) or class counts."""
    counts = np.bincount(y, minlength=3)
    low, high = x.min(axis=0), x.max(axis=0)
    if depth == 0 or (counts > 0).sum() < 2 or not (high > low).any():
        return counts.tolist()
    every = np.arange(x.shape[1])
    order = X.hash_draws(seed, np.full(len(every), tree), np.full(len(every), path), every, 0)
    candidates = [j for j in np.argsort(order) if high[j] > low[j]][:columns]
    best = None
    for j in candidates:
        u = X.hash_draws(seed, np.array([tree]), np.array([path]), np.array([j]), 1)[0]
        cut = low[j] + u * (high[j] - low[j])
        left = x[:, j] <= cut
        total = 0.0
        for side in (y[left], y[~left]):
            share = np.bincount(side, minlength=3) / len(side)
            total += len(side) * (1 - (share ** 2).sum() if kind == "gini" else -sum(p * math.log2(p) for p in share if p > 0))
        if best is None or total < best[0] - 1e-9:
            best = total, j, cut, left
    _, j, cut, left = best
    return (j, cut, plain(x[left], y[left], tree, seed, columns, depth - 1, kind, 2 * path), plain(x[~left], y[~left], tree, seed, columns, depth - 1, kind, 2 * path + 1))


def nested(t, node=0):
    if t["feature"][node] < 0:
        return t["counts"][node]
    return (t["feature"][node], t["cut"][node], nested(t, t["left"][node]), nested(t, t["right"][node]))


def same(a, b):
    if isinstance(a, tuple) and isinstance(b, tuple):
        return a[0] == b[0] and abs(a[1] - b[1]) < 1e-12 and same(a[2], b[2]) and same(a[3], b[3])
    return a == b


@pytest.mark.parametrize("kind", ["gini", "entropy"])
def test_trees_equal_numpy(frame, data, kind, monkeypatch):
    x, y = data
    if kind == "entropy":
        monkeypatch.setattr(X, "CELLS", 60)  # several blocks of nodes at each level
    model = X.ExtraTreesClassifier(trees=3, maxDepth=4, columns=2, impurity=kind, seed=5).fit(frame)
    for number, tree in enumerate(model.content["trees"]):
        assert same(nested(tree), plain(x, y, number, 5, 2, 4, kind)), number
    assert {f for t in model.content["trees"] for f in t["feature"]} <= {-1, 0, 1, 2, 3}  # the constant column is never used


def test_repartitioned_rows_give_the_same_trees(frame):
    one, two = (X.ExtraTreesClassifier(trees=2, maxDepth=6, seed=1).fit(f) for f in (frame, frame.repartition(7)))
    assert one.content == two.content


def test_stored_in_a_pipeline(spark, frame, tmp_path):
    raw = frame.drop("features")
    stages = [VectorAssembler(inputCols=list("abcd"), outputCol="features"), X.ExtraTreesClassifier(trees=4, maxDepth=8)]
    model = Pipeline(stages=stages).fit(raw)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    rows = [m.transform(raw).select("id", "probability", "prediction", "label").orderBy("id").collect() for m in (model, again)]
    assert rows[0] == rows[1] and sum(r.prediction == r.label for r in rows[0]) > 380
    assert all(abs(sum(r.probability) - 1) < 1e-9 for r in rows[0])
    top = model.stages[-1].featureImportances
    assert abs(sum(top.toArray()) - 1) < 1e-9 and min(top.toArray()[:3]) > top.toArray()[3]


def test_edges(frame):
    with pytest.raises(Exception, match="no missing values"):
        gaps = frame.withColumn("a", F.when(F.col("id") > 3, F.col("a")).otherwise(float("nan"))).drop("features")
        X.ExtraTreesClassifier().fit(VectorAssembler(inputCols=["a", "b"], outputCol="features", handleInvalid="keep").transform(gaps))
    empty = X.ExtraTreesClassifier(trees=1).fit(frame.where("false"))
    assert empty.transform(frame.limit(2)).count() == 2
    pure = X.ExtraTreesClassifier(trees=1).fit(frame.where("label = 2"))
    assert pure.content["trees"][0]["feature"] == [-1] and pure.transform(frame).where("prediction <> 2").count() == 0
