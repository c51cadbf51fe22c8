"""Mini-batch training against a plain numpy version with the same draws."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.operators import blocks as K, network as N


@pytest.fixture(scope="module")
def data():
    draw = np.random.default_rng(21)
    x = draw.normal(size=(500, 6)) * (draw.random((500, 6)) < 0.6)
    y = (np.abs(x[:, 0]) + np.abs(x[:, 1]) > 1).astype(int) + (x[:, 2] > 0.5)
    return x, y


@pytest.fixture(scope="module")
def frame(spark, data):
    x, y = data
    rows = [(i, Vectors.dense(r) if i % 2 else Vectors.sparse(6, [(j, float(v)) for j, v in enumerate(r) if v]), float(k)) for i, (r, k) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["id", "features", "label"]).repartition(5).cache()


def plain(x, y, draws, batch, hidden, kinds, dropped, epochs, batches, step, momentum, l2, seed):
    """Training row by row of every batch, with full derivatives."""
    w = N.started([x.shape[1], *hidden, int(y.max()) + 1], seed)
    v = [np.zeros_like(a) for a in w]
    order, number = list(range(batches)), 0
    for epoch in range(epochs):
        random.Random(seed * 1_000_003 + epoch).shuffle(order)
        for b in order:
            rows = np.flatnonzero(batch == b)
            look = [a + momentum * s for a, s in zip(w, v)]
            total = [np.zeros_like(a) for a in w]
            for r in rows:
                acts, outs, masks = [x[r]], [], []
                for i, kind in enumerate(kinds):
                    z = acts[-1] @ look[2 * i] + look[2 * i + 1]
                    a = {"relu": np.maximum(z, 0), "tanh": np.tanh(z), "sigmoid": 1 / (1 + np.exp(-z))}[kind]
                    m = N.kept_units(draws[r: r + 1], seed, number, i, hidden[i], dropped[i])[0]
                    outs.append(a)
                    masks.append(m)
                    acts.append(a * m)
                z = acts[-1] @ look[-2] + look[-1]
                d = np.exp(z - z.max())
                d /= d.sum()
                d[y[r]] -= 1
                for i in range(len(hidden), -1, -1):
                    total[2 * i] += np.outer(acts[i], d)
                    total[2 * i + 1] += d
                    if i:
                        a = outs[i - 1]
                        slope = {"relu": (a > 0) * 1.0, "tanh": 1 - a ** 2, "sigmoid": a * (1 - a)}[kinds[i - 1]]
                        d = (look[2 * i] @ d) * masks[i - 1] * slope
            number += 1
            if len(rows):
                for i in range(len(w)):
                    v[i] = momentum * v[i] - step * (total[i] / len(rows) + (l2 * look[i] if i % 2 == 0 else 0))
                    w[i] = w[i] + v[i]
    return w


@pytest.mark.parametrize("kinds", [["relu", "tanh"], ["sigmoid", "relu"]])
def test_epochs_equal_numpy(spark, frame, data, kinds):
    x, y = data
    settings = dict(hidden=[7, 5], activations=kinds, dropout=[0.4, 0.2], epochs=2, batches=3, step=0.2, momentum=0.8, l2=0.01, seed=3)
    keys = frame.orderBy("id").select(F.xxhash64(F.col("id").cast("string")), F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(3)), F.lit(3))).collect()
    draws, batch = np.array([k[0] for k in keys], np.int64).view(np.uint64), np.array([k[1] for k in keys])
    want = plain(x, y, draws, batch, [7, 5], kinds, [0.4, 0.2], 2, 3, 0.2, 0.8, 0.01, 3)
    model = N.DenseNetwork(keyCol="id", **settings).fit(frame)
    assert all(np.allclose(a, b, atol=1e-10) for a, b in zip([np.array(w) for w in model.content["weights"]], want))
    again = N.DenseNetwork(keyCol="id", **settings).fit(frame.repartition(2))
    assert all(np.allclose(a, b, atol=1e-10) for a, b in zip(model.content["weights"], again.content["weights"]))


def test_wide_rows_stay_sparse(frame, monkeypatch):
    settings = dict(hidden=[4], epochs=1, batches=2, keyCol="id")
    one = N.DenseNetwork(**settings).fit(frame)
    monkeypatch.setattr(K, "DENSE_CELLS", 2)
    two = N.DenseNetwork(**settings).fit(frame)
    assert np.allclose(one.content["weights"][0], two.content["weights"][0])


def test_mask_shares():
    masks = N.kept_units(np.arange(4000, dtype=np.uint64) * np.uint64(7919), 1, 2, 0, 10, 0.3)
    assert abs((masks > 0).mean() - 0.7) < 0.01 and np.allclose(masks[masks > 0], 1 / 0.7)
    assert (N.kept_units(np.arange(3, dtype=np.uint64), 1, 2, 1, 5, 0.0) == 1).all()


def test_learns_more_than_the_sigmoid_network(spark, frame, tmp_path):
    evaluator = MulticlassClassificationEvaluator(metricName="logLoss")
    train, valid = frame.where("id % 5 > 0"), frame.where("id % 5 = 0")
    before = evaluator.evaluate(MultilayerPerceptronClassifier(layers=[6, 10, 50, 3], maxIter=15, seed=1).fit(train).transform(valid))
    model = N.DenseNetwork(hidden=[32, 16], dropout=[0.1], epochs=15, batches=4, step=0.15, keyCol="id", seed=1).fit(train)
    assert evaluator.evaluate(model.transform(valid)) < before
    assert model.content["losses"][-1] < 0.6 * model.content["losses"][0]
    model.write().save(str(tmp_path / "m"))
    again = N.NetworkModel.load(str(tmp_path / "m"))
    assert again.transform(valid).select("id", "probability").orderBy("id").collect() == model.transform(valid).select("id", "probability").orderBy("id").collect()


def test_small_inputs(frame):
    assert N.DenseNetwork(epochs=1).fit(frame.where("false")).transform(frame.where("false")).count() == 0
    gaps = frame.withColumn("label", F.when(F.col("id") > 100, F.col("label")))
    assert len(N.DenseNetwork(epochs=1, batches=1).fit(gaps).content["losses"]) == 1
    with pytest.raises(ValueError):
        N.DenseNetwork(hidden=[4, 4], activations=["relu", "relu", "tanh"]).fit(frame)
