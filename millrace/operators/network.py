"""Dense networks trained by synchronous mini-batches.

Rows are dealt to batches by a hash of their key and stored in blocks, a batch's rows together. A step is one pass
over one batch: tasks run their rows through the network and sum the slopes of all weights, the sums are added and the
driver takes a Nesterov step. Dropout masks are hashes of (row, step, layer, unit), so a task that runs again drops
the same units. Vectors may be sparse; only the first layer meets them.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from millrace.operators import blocks as K
from millrace.operators.boosting import _spread
from millrace.operators.stored_models import StoredModel
from millrace.session import discard, shipped

ACTIVATIONS = ("relu", "tanh", "sigmoid")


def activate(kind: str, z: np.ndarray) -> np.ndarray:
    if kind == "relu":
        return np.maximum(z, 0)
    return np.tanh(z) if kind == "tanh" else 1 / (1 + np.exp(-z))


def slope_of(kind: str, a: np.ndarray) -> np.ndarray:
    """Derivative of an activation from its value."""
    if kind == "relu":
        return (a > 0).astype(float)
    return 1 - a * a if kind == "tanh" else a * (1 - a)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def kept_units(draw: np.ndarray, seed: int, step: int, layer: int, units: int, dropped: float) -> np.ndarray:
    """1 / (1 - dropped) for the units of each row that stay, else 0."""
    if dropped <= 0:
        return np.ones((len(draw), units))
    salt = _spread(np.array([((seed % (1 << 20)) << 40) + step * 64 + layer + 1], np.uint64))
    row = _spread(draw ^ salt)[:, None]
    unit = np.arange(1, units + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    return (_spread(row ^ unit) / 2.0 ** 64 >= dropped) / (1 - dropped)


def started(sizes: list[int], seed: int) -> list[np.ndarray]:
    """Weights and offsets of all layers, evenly drawn within sqrt(6 / (inputs + outputs))."""
    draw, out = np.random.default_rng(seed), []
    for a, b in zip(sizes[:-1], sizes[1:]):
        far = np.sqrt(6 / (a + b))
        out += [draw.uniform(-far, far, (a, b)), np.zeros(b)]
    return out


def slopes(block: K.Block, weights: list[np.ndarray], kinds: list[str], dropped: list[float], seed: int, step: int) -> list[np.ndarray]:
    """Summed loss, number of rows and summed slopes of a block."""
    values, masks = [], []
    z = block.times(weights[0]) + weights[1]
    for layer, kind in enumerate(kinds):
        values.append(activate(kind, z))
        masks.append(kept_units(block.draw, seed, step, layer, z.shape[1], dropped[layer]))
        z = (values[-1] * masks[-1]) @ weights[2 * layer + 2] + weights[2 * layer + 3]
    p = softmax(z)
    rows, label = np.arange(len(block)), block.label.astype(int)
    loss = -np.log(np.maximum(p[rows, label], 1e-15)).sum()
    error = p
    error[rows, label] -= 1
    out: list[np.ndarray] = []
    for layer in range(len(kinds), 0, -1):
        a = values[layer - 1] * masks[layer - 1]
        out = [a.T @ error, error.sum(axis=0), *out]
        error = (error @ weights[2 * layer].T) * masks[layer - 1] * slope_of(kinds[layer - 1], values[layer - 1])
    return [np.array([loss, len(block)]), block.gathered(error), error.sum(axis=0), *out]


class DenseNetwork(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Layers of ``hidden`` units with ``activations`` (one for each, or one for all) and shares ``dropout`` left out in training,
    softmax at the end. Labels are class numbers; rows without label or vector are not learned from. Without ``keyCol`` the
    vector itself is a row's key. ``epochs`` passes of ``batches`` steps each.
    """

    hidden = Param(Params._dummy(), "hidden", "units of the hidden layers", TypeConverters.toListInt)
    activations = Param(Params._dummy(), "activations", "relu, tanh or sigmoid", TypeConverters.toListString)
    dropout = Param(Params._dummy(), "dropout", "share of units left out", TypeConverters.toListFloat)
    epochs = Param(Params._dummy(), "epochs", "passes over the rows", TypeConverters.toInt)
    batches = Param(Params._dummy(), "batches", "steps of a pass", TypeConverters.toInt)
    step = Param(Params._dummy(), "step", "step width", TypeConverters.toFloat)
    momentum = Param(Params._dummy(), "momentum", "share of the last step", TypeConverters.toFloat)
    l2 = Param(Params._dummy(), "l2", "penalty of squared weights", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "row key", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, hidden: list[int] | None = None, activations: list[str] | None = None, dropout: list[float] | None = None, epochs: int = 15,
                 batches: int = 8, step: float = 0.1, momentum: float = 0.9, l2: float = 0.0, seed: int = 0, featuresCol: str = "features",
                 labelCol: str = "label", keyCol: str = ""):
        super().__init__()
        self._setDefault(hidden=[50], activations=["relu"], dropout=[0.0], epochs=15, batches=8, step=0.1, momentum=0.9, l2=0.0, seed=0,
                         featuresCol="features", labelCol="label", keyCol="")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> NetworkModel:
        v = {p.name: self.getOrDefault(p) for p in self.params}
        hidden = list(v["hidden"])
        kinds, dropped = (list(x) * (len(hidden) if len(x) == 1 else 1) for x in (v["activations"], v["dropout"]))
        if set(kinds) - set(ACTIVATIONS) or len(kinds) != len(hidden) or len(dropped) != len(hidden) or not all(0 <= d < 1 for d in dropped):
            raise ValueError("one activation and one dropout share below 1 for each hidden layer, or one for all")
        key = F.col(v["keyCol"]).cast("string") if v["keyCol"] else F.xxhash64(vector_to_array(v["featuresCol"])).cast("string")
        data = dataset.select(F.col(v["featuresCol"]).alias("x"), F.col(v["labelCol"]).cast("double").alias("y"), key.alias("k"))
        top = data.agg(F.max("y")).first()[0]
        width, classes = K.width_of(data, "x"), int(top or 0) + 1
        weights = started([width, *hidden, classes], v["seed"])
        history = []
        if top is not None and width:
            number = F.pmod(F.xxhash64("k", F.lit(v["seed"])), F.lit(v["batches"]))
            rows = K.pack(data, "x", "y", "k", width, batch=number)
            try:
                weights, history = self._train(rows, width, weights, kinds, dropped, v)
            finally:
                discard(rows)
        return NetworkModel({"weights": [w.tolist() for w in weights], "kinds": kinds, "features": v["featuresCol"], "losses": history, "width": width})

    @staticmethod
    def _train(rows: DataFrame, width: int, weights: list[np.ndarray], kinds: list[str], dropped: list[float], v: dict):
        order, history = list(range(v["batches"])), []
        speed = [np.zeros_like(w) for w in weights]
        shapes = [(2,), *[w.shape for w in weights]]
        step = 0
        for epoch in range(v["epochs"]):
            random.Random(v["seed"] * 1_000_003 + epoch).shuffle(order)
            lost = seen = 0.0
            for batch in order:
                ahead = [w + v["momentum"] * s for w, s in zip(weights, speed)]

                def work(block: K.Block, ahead=ahead, step=step):
                    return slopes(block, ahead, kinds, dropped, v["seed"], step)

                head, *found = K.summed(rows.where(F.col("batch") == batch), width, work, shapes)
                step += 1
                if not head[1]:
                    continue
                lost, seen = lost + head[0], seen + head[1]
                for i, g in enumerate(found):
                    penalty = v["l2"] * ahead[i] if i % 2 == 0 else 0.0
                    speed[i] = v["momentum"] * speed[i] - v["step"] * (g / head[1] + penalty)
                weights = [w + s for w, s in zip(weights, speed)]
            history.append(lost / seen if seen else 0.0)
        return weights, history


class NetworkModel(StoredModel):
    """Adds ``probability`` (a vector) and ``prediction``; ``content['losses']`` is the mean training loss by epoch."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shipped(dataset.sparkSession)
        weights, kinds = [np.array(w) for w in self.content["weights"]], self.content["kinds"]
        width = self.content["width"]

        @F.arrow_udf("array<double>")
        def chances(vectors: pa.Array) -> pa.Array:
            starts, columns, values = K.sparse_rows(vectors)
            n = len(vectors)
            z = K.Block(width, {"starts": starts, "columns": columns, "values": values, "label": np.zeros(n), "fold": np.zeros(n, int),
                                "draw": np.zeros(n, np.uint64)}).times(weights[0]) + weights[1]
            for layer, kind in enumerate(kinds):
                z = activate(kind, z) @ weights[2 * layer + 2] + weights[2 * layer + 3]
            p = softmax(z)
            return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * p.shape[1], p.ravel())

        found = dataset.withColumn("_chances", chances(F.unwrap_udt(self.content["features"])))
        place = (F.array_position("_chances", F.array_max("_chances")) - 1).cast("double")
        return found.withColumns({"probability": array_to_vector("_chances"), "prediction": place}).drop("_chances")
