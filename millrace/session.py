"""Session settings the operators rely on."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where the split costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tuned(spark: SparkSession) -> SparkSession:
    """Turn on the adaptive features; other settings stay as the cluster has them."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "millrace", cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and local benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tuned(spark)


def shipped(spark: SparkSession) -> SparkSession:
    """Send the package to the Python workers, once for each Spark context.

    Functions are pickled by reference, so workers must be able to import it wherever they run.
    """
    context = spark.sparkContext
    if not getattr(context, "_millrace_shipped", False):
        folder = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="run-"), "millrace_code")
        context.addPyFile(shutil.make_archive(target, "zip", folder, "millrace"))  # served to the executors by the driver
        context._millrace_shipped = True
    return spark


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder named by ``spark.checkpoint.dir``.

    Used where several later jobs read the same expensive frame: the copy lives in
    shared storage, so losing an executor never makes those jobs recompute it.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
            shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        context.setCheckpointDir(shared)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder every executor can reach, below ``spark.checkpoint.dir`` if that is set."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is not None:
        return f"{shared.rstrip('/')}/run-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def scratch_table(df: DataFrame) -> DataFrame:
    """The frame written as Parquet below ``scratch_folder`` and read again; ``discard`` deletes it."""
    path = scratch_folder(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._scratch = path
    return table


def discard(table: DataFrame) -> None:
    """Delete what ``scratch_table`` wrote, once no later job reads it."""
    table.unpersist()
    path = getattr(table, "_scratch", None)
    if path is not None:
        spark = table.sparkSession
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
