"""Writing results and reusing what was written before."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.operators.relational import columns_of


def write_csv(df: DataFrame, folder: str, float_format: str | None = None, quoting: str = "minimal",
              gzip: bool = True, order_by: Sequence[str] = (), separator: str = ",") -> None:
    """Part files with a header. ``quoting`` is ``minimal``, ``none`` or ``nonnumeric``.

    ``float_format`` is a printf pattern such as ``%.9f``. Sorting is global but spread over
    the part files, whose names keep the order.
    """
    if order_by:
        df = df.orderBy(*order_by)
    out = df
    if float_format:
        out = out.withColumns({
            f.name: F.format_string(float_format, f.name) for f in df.schema.fields
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))})
    writer = None
    if quoting == "nonnumeric":
        texts = set(columns_of(df, "string"))
        quoted = [F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"')).alias(f'"{c}"')
                  if c in texts else F.col(c).alias(f'"{c}"') for c in out.columns]
        out = out.select(*quoted)
        writer = out.write.option("quote", "\u0000").option("escapeQuotes", False)
    elif quoting == "none":
        writer = out.write.option("quote", "\u0000").option("escapeQuotes", False)
    else:
        writer = out.write
    writer = writer.mode("overwrite").option("header", True).option("sep", separator).option("emptyValue", "")
    if gzip:
        writer = writer.option("compression", "gzip")
    writer.csv(folder)


def write_stage(df: DataFrame, folder: str, kind: str = "parquet") -> None:
    """A prepared table between two stages: parquet, or TSV where a reader needs text."""
    if kind == "parquet":
        df.write.mode("overwrite").parquet(folder)
    elif kind == "tsv":
        df.write.mode("overwrite").option("header", True).option("sep", "\t").csv(folder)
    else:
        raise ValueError(f"unknown stage kind {kind}")


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether a finished Spark write lies in ``folder``, on any file system."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(folder.rstrip("/") + "/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def materialize(spark: SparkSession, folder: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stored table if its write was finished, else built, stored and read back."""
    if not is_complete(spark, folder):
        build().write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)


def load_or_fit(spark: SparkSession, folder: str, fit: Callable[[], PipelineModel]) -> PipelineModel:
    """The stored model if there is one, else fitted and stored."""
    if not is_complete(spark, folder.rstrip("/") + "/metadata"):
        fit().write().overwrite().save(folder)
    return PipelineModel.load(folder)
