"""Registry of runnable queries: Spark callables and the SQL that checks them."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import tuned

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MODULES = [
    "scans", "projections", "joining", "grouping", "ordering", "scalar", "features",
    "sparse_features", "sampling", "learning", "scoring", "blending", "user_functions", "flows",
]


class Tables:
    """The given parquet tables of one scale, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(tuned(spark), folder))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load() -> None:
    for module in MODULES:
        importlib.import_module(f"millrace.suite.{module}")
