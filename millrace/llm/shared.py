"""What the operators share: session settings, stored intermediate tables, logistic fits."""

from __future__ import annotations

import os
import shutil
import tempfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from millrace.session import scratch_folder, tuned


def _ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once for each Spark context.

    Functions are pickled by reference, so workers must be able to import it wherever they run.
    """
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", False):
        return
    folder = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="run-"), "millrace_code"), "zip", folder, "millrace")
    context.addPyFile(archive)  # served to the executors by the driver
    context._millrace_shipped = True


def prepared(spark: SparkSession) -> SparkSession:
    """Adaptive features on, Arrow batches small enough for long texts, the package on the workers."""
    tuned(spark)
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    return spark


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if a column of the frame has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame) -> DataFrame:
    """The frame as a Parquet table below ``spark.checkpoint.dir``.

    Later jobs read it again instead of computing it; it survives lost executors.
    """
    path = scratch_folder(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 150, even: bool = True) -> np.ndarray:
    """Weights of a logistic regression, the last one its intercept.

    Accelerated gradient descent on the mean loss plus ``penalty / (2 n) |w|^2``; with ``even`` both
    classes weigh the same. With one class only the intercept is set.
    """
    rows, width = x.shape
    w = np.zeros(width + 1)
    positive = float(y.sum())
    if positive in (0.0, float(rows)):
        w[-1] = 8.0 if rows and positive else -8.0
        return w
    weight = np.where(y > 0, 0.5 / positive, 0.5 / (rows - positive)).astype(np.float32)
    if not even:
        weight = np.full(rows, 1.0 / rows, np.float32)
    # the steepest curvature, by power iteration
    v, top = np.ones(width + 1, np.float32), 1.0
    for _ in range(12):
        inner = weight * (x @ v[:-1] + v[-1])
        v = np.append(x.T @ inner, inner.sum())
        top = float(np.linalg.norm(v))
        v = (v / max(top, 1e-12)).astype(np.float32)
    step = 4.0 / (1.2 * top + 4.0 * penalty / rows + 1e-9)
    ridge = np.append(np.full(width, penalty / rows), 0.0)
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ ahead[:-1].astype(np.float32) + ahead[-1], -30, 30)))
        slope = (weight * (p - y)).astype(np.float32)
        new = ahead - step * (np.append(x.T @ slope, slope.sum()) + ridge * ahead)
        t_new = (1.0 + np.sqrt(1.0 + 4.0 * t * t)) / 2.0
        ahead = new + (t - 1.0) / t_new * (new - w)
        w, t = new, t_new
    return w


def chance(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
