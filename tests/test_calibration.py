"""Isotonic steps against a plain version, calibrated SVMs, and every composite model stored and read."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from millrace.operators import calibration as C, ensembling as N, models as L, sampling as S, tuning as U
from millrace.operators.extra_trees import ExtraTreesClassifier


def plain(x, y):
    """Least squares under a rising order by the min-max formula: the value at each distinct score."""
    at = np.unique(x)
    total = np.array([y[x == v].sum() for v in at])
    n = np.array([(x == v).sum() for v in at])
    out = []
    for i in range(len(at)):
        out.append(max(min(total[a:b].sum() / n[a:b].sum() for b in range(i + 1, len(at) + 1)) for a in range(i + 1)))
    return at, np.array(out)


@pytest.mark.parametrize("ranges", [1, 2, 17])
def test_steps_equal_plain_version(spark, ranges):
    draw = np.random.default_rng(ranges)
    x = np.round(draw.normal(size=160), 1)
    y = (draw.random(160) < 1 / (1 + np.exp(-2 * x))).astype(float)
    group = np.arange(160) % 2
    df = spark.createDataFrame([(int(g), float(a), float(b)) for g, a, b in zip(group, x, y)], "g int, x double, y double").repartition(6)
    found = C.isotonic_steps(df, "x", "y", ["g"], ranges)
    for g in (0, 1):
        at, want = plain(x[group == g], y[group == g])
        assert np.allclose(C.stepped(found[(g,)], at), want)
    whole = C.isotonic_steps(df, "x", "y", ranges=ranges)[()]
    model = IsotonicRegression(featuresCol="x", labelCol="y").fit(df)
    got = model.transform(df.select("x", "y")).collect()
    assert np.allclose([r.prediction for r in got], C.stepped(whole, np.array([r.x for r in got])))


def test_steps_of_little(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 0.0), (float("nan"), 0.0)], "x double, y double")
    assert C.isotonic_steps(df, "x", "y") == {(): {"x": [1.0], "y": [1.0]}}
    assert C.isotonic_steps(df.where("false"), "x", "y") == {} and C.stepped(None, np.zeros(2)).tolist() == [0.5, 0.5]


@pytest.fixture(scope="module")
def frame(spark):
    draw = np.random.default_rng(31)
    rows = []
    for i in range(450):
        k = i % 3
        a, b = draw.normal(loc=[2.5 * (k == 1), 2.5 * (k == 2)])
        rows.append((i, float(a), float(b), float(k)))
    return L.assemble(spark.createDataFrame(rows, "id bigint, a double, b double, label double").repartition(4), ["a", "b"], ["id", "label"]).cache()


def test_calibrated_by_folds(frame):
    train, valid = S.split_by_fraction(frame, "id", 0.7, 1)
    model = C.CrossCalibratedSVM(classes=3, folds=3, maxIter=20).fit(train)
    out = model.transform(valid).collect()
    assert all(abs(sum(r.probability) - 1) < 1e-9 for r in out)
    assert np.mean([r.prediction == r.label for r in out]) > 0.75
    # each fold's steps come from its own rows' margins
    assert len(model.content["steps"]) == 9 and all(np.all(np.diff(s["y"]) >= 0) for s in model.content["steps"])
    loss = -np.mean([np.log(max(r.probability[int(r.label)], 1e-3)) for r in out])
    assert loss < 0.75


def test_pairs_equal_their_members(frame):
    model = L.PairwiseSVM(3, iterations=10).fit(frame)
    rows = model.transform(frame).collect()
    w, b = np.array(model.content["weights"]), np.array(model.content["offsets"])
    for r in rows[:100]:
        votes = [0, 0, 0]
        for (i, j), m in zip(model.content["pairs"], w @ r.features.toArray() + b):
            votes[j if m > 0 else i] += 1
        assert r.votes == votes and r.prediction == votes.index(max(votes))


def test_every_composite_model_is_stored_and_read(frame, tmp_path):
    folded = S.stratified_folds(frame, "id", "label", 2, 1)
    stack = N.Stack({"lr": L.logistic(iterations=10), "et": ExtraTreesClassifier(trees=3, maxDepth=4)}, 2, iterations=10)
    stack.fit(folded, "id", "label", "fold")
    fit_part, held = S.split_by_fraction(frame, "id", 0.7, 2)
    models = {"stack": stack.model, "pairs": L.PairwiseSVM(3, iterations=5).fit(frame), "sigmoid": L.CalibratedSVM(3, iterations=5).fit(fit_part, held),
              "svm": C.CrossCalibratedSVM(classes=3, folds=2, maxIter=5).fit(frame), "trees": ExtraTreesClassifier(trees=3, maxDepth=4).fit(frame)}
    for name, model in models.items():
        folder = str(tmp_path / name)
        PipelineModel([model]).write().overwrite().save(folder)  # as a stage, so the reader finds the class by itself
        again = PipelineModel.load(folder)
        columns = ["id", "prediction"] + (["votes"] if name == "pairs" else ["probability"])
        one, two = (m.transform(frame).select(*columns).orderBy("id").collect() for m in (model, again))
        assert one == two and len(one) == 450, name
    assert stack.model.transform(frame).columns == [*frame.columns, "probability", "prediction"]


def test_composite_models_are_compared(frame):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    train, valid = S.split_by_fraction(frame, "id", 0.7, 3)
    found = U.compare(train, valid, {"lr": LogisticRegression(maxIter=10), "et": ExtraTreesClassifier(trees=4, maxDepth=5),
                                     "svm": C.CrossCalibratedSVM(classes=3, folds=2, maxIter=10)}, MulticlassClassificationEvaluator(metricName="accuracy"))
    assert {n for n, _, _ in found} == {"lr", "et", "svm"} and all(s > 0.7 for _, s, _ in found)
    trees = ExtraTreesClassifier(seed=1)
    rows = S.stratified_folds(train, "id", "label", 2, 1)
    searched = U.search(rows, trees, U.grid({trees.maxDepth: [1, 5], trees.trees: [3]}), MulticlassClassificationEvaluator(metricName="accuracy"), "fold", 2)
    assert searched.best == 1
    assert Pipeline(stages=[trees]).getStages()[0].uid == trees.uid
