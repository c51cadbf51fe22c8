"""Boosted trees against a plain numpy version, resumed fits, folds in lockstep."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import boosting as B
from millrace.operators.metrics import log_loss, rmspe


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(500, 4))
    x[:, 2] = np.round(x[:, 2])
    y = (x[:, 0] + 0.5 * x[:, 1] * (x[:, 2] > 0) + draw.normal(scale=0.4, size=500) > 0).astype(float)
    value = np.exp(0.4 * x[:, 0]) + 2 + 0.1 * draw.normal(size=500)
    x[draw.random((500, 4)) < 0.15] = np.nan
    x[y == 1, 1] = np.where(draw.random((y == 1).sum()) < 0.3, np.nan, x[y == 1, 1])  # missing values say something
    return x, y, value


@pytest.fixture(scope="module")
def frame(spark, rows):
    x, y, value = rows
    data = [(i, *[None if math.isnan(v) and i % 2 else float(v) for v in x[i]], float(y[i]), float(np.log1p(value[i])), i % 3) for i in range(len(y))]
    return spark.createDataFrame(data, "id bigint, a double, b double, c double, `d.1` double, y double, v double, fold int").repartition(5).cache()


NAMES = ["a", "b", "c", "d.1"]


def plain_tree(bins, g, h, s, columns, node=None, level=0):
    """Nested (feature, cut, missing_left, left, right) or a leaf value, by trying every cut."""
    node = np.arange(len(bins)) if node is None else node
    G, H = g[node].sum(), h[node].sum()
    best = None
    if level < s.depth:
        for f in columns:
            b = bins[node, f]
            for cut in range(255):
                if not (b == cut).any():
                    continue
                for missing_left in (True, False):
                    left = (b <= cut) | (missing_left & (b == B.MISSING))
                    left &= (b != B.MISSING) | missing_left
                    gl, hl = g[node][left].sum(), h[node][left].sum()
                    gr, hr = G - gl, H - hl
                    if min(hl, hr) < s.least_weight:
                        continue
                    gain = 0.5 * (gl ** 2 / (hl + s.l2) + gr ** 2 / (hr + s.l2) - G ** 2 / (H + s.l2)) - s.least_gain
                    if gain > 0 and (best is None or gain > best[0] + 1e-9):
                        best = gain, f, cut, missing_left, left
    if best is None:
        return -s.step * G / (H + s.l2)
    gain, f, cut, missing_left, left = best
    return (f, cut, missing_left, plain_tree(bins, g, h, s, columns, node[left], level + 1), plain_tree(bins, g, h, s, columns, node[~left], level + 1))


def nested(tree, node=0):
    if tree.feature[node] < 0:
        return tree.value[node]
    return (tree.feature[node], tree.cut[node], tree.missing_left[node], nested(tree, tree.left[node]), nested(tree, tree.right[node]))


def apply(tree, row):
    while isinstance(tree, tuple):
        f, cut, missing_left, left, right = tree
        tree = left if (missing_left if row[f] == B.MISSING else row[f] <= cut) else right
    return tree


def same(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    if not isinstance(a, tuple):
        return abs(a - b) < 1e-6
    return a[:3] == b[:3] and same(a[3], b[3]) and same(a[4], b[4])


@pytest.mark.parametrize("objective", ["logistic", "squared"])
def test_trees_equal_numpy(spark, frame, rows, objective):
    x, y, value = rows
    target = y if objective == "logistic" else np.log1p(value)
    s = B.Settings(rounds=5, depth=3, step=0.3, l2=1.5, least_gain=0.05, least_weight=2.0, row_share=0.8, feature_share=0.75, bins=16, objective=objective, seed=4)
    model = B.boost(frame, NAMES, "y" if objective == "logistic" else "v", "id", s)
    keys = np.array([r[0] for r in frame.orderBy("id").select(F.xxhash64(F.col("id").cast("string"))).collect()], np.int64).view(np.uint64)
    bins = B.binned(x, model.edges)
    margin = np.full(len(y), model.base)
    assert abs(model.base - (math.log(y.mean() / (1 - y.mean())) if objective == "logistic" else target.mean())) < 1e-12
    for number, tree in enumerate(model.trees):
        g, h = B.gradients(objective, target, margin)
        used = B.row_draws(keys, s.seed, number) < s.row_share
        assert 0.7 < used.mean() < 0.9
        columns = B.drawn_features(4, s.feature_share, s.seed, number)
        assert len(columns) == 3
        want = plain_tree(bins, g, h, s, columns, np.flatnonzero(used))
        assert same(nested(tree), want), number
        margin = margin + np.array([apply(want, b) for b in bins])
    got = {r["id"]: r["margin"] for r in model.transform(frame).select("id", "margin").collect()}
    assert np.allclose([got[i] for i in range(len(y))], margin, atol=1e-5)
    assert any(not m for t in model.trees for m, f in zip(t.missing_left, t.feature) if f >= 0)  # both sides are learned


def test_sums_passed_on_early_are_the_same(frame, monkeypatch):
    s = B.Settings(rounds=2, depth=3, bins=16, seed=1)
    whole = B.boost(frame, NAMES, "y", "id", s)
    monkeypatch.setattr(B, "CELLS", 10)
    monkeypatch.setattr(B, "DRIVER_BYTES", 0)
    monkeypatch.setattr(B, "BLOCK_ROWS", 37)
    assert B.boost(frame.repartition(3), NAMES, "y", "id", s).trees == whole.trees


def test_resumed_equals_uninterrupted(spark, frame, monkeypatch, tmp_path):
    monkeypatch.setattr(B, "REFRESH", 2)
    metric = B.column_metric(rmspe)
    s = B.Settings(rounds=7, depth=2, step=0.4, objective="squared", row_share=0.7, bins=32, seed=9)
    held = F.col("fold") == 0
    whole = B.boost(frame, NAMES, "v", "id", s, held, metric)
    B.boost(frame, NAMES, "v", "id", B.replace(s, rounds=3), held, metric).save(spark, str(tmp_path / "model"))
    part = B.Boosted.load(spark, str(tmp_path / "model"))
    assert len(part.trees) == 3 and part.trees == whole.trees[:3]
    again = B.boost(frame, NAMES, "v", "id", s, held, metric, start=part)
    assert again.trees == whole.trees and again.history.scores == whole.history.scores and len(whole.history.scores) == 7
    # the history is the metric of the held-out rows by the first trees
    for rounds in (1, 4, 7):
        scored = whole.transform(frame.where(held), rounds).agg(rmspe(F.col("v"), F.col("prediction"))).first()[0]
        assert abs(scored - whole.history.means[rounds - 1]) < 1e-9


def test_stops_without_gain(frame):
    noise = frame.withColumn("y", (F.xxhash64("id") % 2 == 0).cast("double"))
    s = B.Settings(rounds=40, depth=4, step=1.0, bins=16)
    model = B.boost(noise, NAMES, "y", "id", s, F.col("fold") == 0, B.area_metric, patience=3, larger=True)
    means = model.history.means
    assert len(means) < 40 and len(means) - model.history.best == 3 and means[model.history.best - 1] == max(means)


def test_area_equals_general_form(spark, frame, monkeypatch):
    rows = frame.select(F.col("fold").alias("model"), F.col("y").alias("label"), F.round("c", 1).alias("prediction"), F.col("id").alias("draw")).na.fill(0.0)
    few = {r["model"]: r["value"] for r in B.area_metric(rows).collect()}
    monkeypatch.setattr(B, "SCORES", 3)
    many = {r["model"]: r["value"] for r in B.area_metric(rows).collect()}
    assert set(few) == {0, 1, 2} and all(abs(few[m] - many[m]) < 1e-12 for m in few)


def test_folds_in_lockstep_equal_separate_fits(spark, frame):
    s = B.Settings(rounds=6, depth=3, step=0.3, row_share=0.8, bins=16, seed=2)
    jobs = spark.sparkContext.statusTracker()

    def counted(work):
        group = f"count-{id(work)}"
        spark.sparkContext.setJobGroup(group, group)
        out = work()
        return out, len(jobs.getJobIdsForGroup(group))

    metric = B.column_metric(log_loss)
    (models, history), many = counted(lambda: B.boost_folds(frame, NAMES, "y", "id", "fold", 3, s, metric))
    (_, _), few = counted(lambda: B.boost_folds(frame.withColumn("fold", F.col("fold") % 2), NAMES, "y", "id", "fold", 2, s, metric))
    assert many <= few + 3
    curves = []
    for m in range(3):
        # separate fit on the bins of all rows
        alone = B.boost(frame, NAMES, "y", "id", s, F.col("fold") == m, metric, start=B.Boosted(s, NAMES, models[m].edges, models[m].base))
        assert alone.trees == models[m].trees
        curves.append(alone.history.means)
    assert np.allclose(np.array(curves).T, history.scores) and history.best == int(np.mean(curves, axis=0).argmin()) + 1


def test_small_inputs(spark, frame):
    s = B.Settings(rounds=2, depth=2)
    empty = B.boost(frame.where("false"), NAMES, "y", "id", s)
    assert [t.value for t in empty.trees] == [[0.0], [0.0]]
    one = B.boost(frame.limit(1).withColumn("y", F.lit(1.0)), NAMES, "y", "id", s)
    assert all(t.feature == [-1] for t in one.trees)
    unlabelled = B.boost(frame.withColumn("y", F.when(F.col("id") < 250, F.col("y"))), NAMES, "y", "id", s)
    assert unlabelled.transform(frame).where("probability is null").count() == 0
    blank = frame.withColumns({c: F.lit(None).cast("double") for c in NAMES[:3]}).withColumnRenamed("d.1", "e")
    assert B.boost(blank, NAMES[:3], "y", "id", s).importances(spark).agg(F.sum("splits")).first()[0] == 0
