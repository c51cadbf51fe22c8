"""Many logistic regressions in one fit against separate fits."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.operators import blocks as K, penalised as P

PENALTIES = [0.001, 0.3, 0.02]


@pytest.fixture(scope="module")
def frame(spark):
    draw = np.random.default_rng(12)
    x = draw.normal(size=(600, 4)) * [1, 10, 0.1, 3] + [0, 5, 0, -40]
    x[:, 2] *= draw.random(600) < 0.3
    y = (x[:, 0] + 0.1 * x[:, 1] + 3 * x[:, 2] + draw.normal(size=600) > 0.5).astype(float)
    rows = []
    for i in range(600):  # dense and sparse vectors mixed
        v = Vectors.dense(x[i]) if i % 3 else Vectors.sparse(4, [(j, float(x[i, j])) for j in range(4) if x[i, j] != 0])
        rows.append((i, v, float(y[i]), i % 3))
    df = spark.createDataFrame(rows, ["id", "features", "label", "fold"])
    return df.repartition(5).cache()


def separate(rows, penalty):
    return LogisticRegression(regParam=penalty, maxIter=500, tol=1e-13).fit(rows)


@pytest.mark.parametrize("newton", [True, False])
def test_equals_separate_fits(spark, frame, monkeypatch, newton):
    if not newton:
        monkeypatch.setattr(P, "NEWTON_WIDTH", 1)
        monkeypatch.setattr(K, "DENSE_CELLS", 300)
    found = P.logistic_path(frame, PENALTIES, "id", "fold", 3, steps=5000 if not newton else 100, close=1e-9)
    evaluator = MulticlassClassificationEvaluator(metricName="logLoss")
    for i, penalty in enumerate(PENALTIES):
        whole = separate(frame, penalty)
        assert np.allclose(found.models[i].content["weights"], whole.coefficients, atol=1e-6)
        assert abs(found.models[i].content["intercept"] - whole.intercept) < 1e-5
        for k in range(3):
            one = separate(frame.where(F.col("fold") != k), penalty)
            assert np.allclose(found.fold_weights[i, k, :-1], one.coefficients, atol=1e-6)
            loss = evaluator.evaluate(one.transform(frame.where(F.col("fold") == k)))
            assert abs(found.losses[i, k] - loss) < 1e-6
    assert found.best == int(found.losses.mean(axis=1).argmin()) and found.table(spark).count() == 9
    scored = found.model.transform(frame).join(separate(frame, PENALTIES[found.best]).transform(frame).select("id", F.col("probability").alias("q")), "id").collect()
    assert max(abs(r.probability[1] - r.q[1]) for r in scored) < 1e-6


def test_jobs_do_not_depend_on_candidates(spark, frame):
    def jobs(penalties):
        group = f"path-{len(penalties)}"
        spark.sparkContext.setJobGroup(group, group)
        P.logistic_path(frame, penalties, "id", "fold", 3)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few, many = jobs([0.1, 0.01]), jobs([0.1, 0.01, 0.02, 0.03, 0.04, 0.05, 0.06, 0.07, 0.08, 0.09])
    assert many <= few + 1


def test_sums_in_two_stages(frame, monkeypatch):
    one = P.logistic_path(frame, [0.1], "id", "fold", 3)
    monkeypatch.setattr(K, "DRIVER_BYTES", 0)
    two = P.logistic_path(frame, [0.1], "id", "fold", 3)
    assert np.allclose(one.models[0].content["weights"], two.models[0].content["weights"], atol=1e-9)


def test_stored_and_degenerate(spark, frame, tmp_path):
    constant = P.logistic_path(frame.withColumn("label", F.lit(1.0)), [0.1], "id", "fold", 3)
    assert max(map(abs, constant.model.content["weights"])) < 1e-6
    constant.model.write().save(str(tmp_path / "m"))
    again = P.LinearClassifier.load(str(tmp_path / "m"))
    assert again.content == constant.model.content and again.transform(frame).where("prediction = 1").count() == 600
