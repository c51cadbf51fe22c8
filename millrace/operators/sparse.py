"""Long (key, feature) triples and the sparse vectors made from them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.functions.scalars import prefix_token
from millrace.operators.encoding import sorted_levels


def stack_tokens(blocks: Sequence[tuple[DataFrame, str, str]], key: str) -> DataFrame:
    """(key, feature) rows of several tables, each value prefixed with its block name."""
    parts = [df.select(key, prefix_token(prefix, column).alias("feature")) for df, column, prefix in blocks]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked


def index_triples(tokens: DataFrame, key: str) -> DataFrame:
    """(key, row, col, n): sorted ids of keys and features with their counts.

    Counted first, so each (key, feature) pair crosses the network once; features come from
    the data itself, so no column is empty.
    """
    counted = tokens.groupBy(key, "feature").agg(F.count("*").alias("n"))
    rows = sorted_levels(tokens, key).withColumnRenamed("code", "row")
    columns = sorted_levels(tokens, "feature").withColumnRenamed("code", "col")
    return counted.join(rows, key).join(columns, "feature").select(key, "row", "col", "n")


def offset_blocks(blocks: Sequence[tuple[str, DataFrame, int]], key: str) -> DataFrame:
    """(key, block, col): blocks of column ids put side by side; ``int`` is a block's width."""
    start, stacked = 0, None
    for name, pairs, width in blocks:
        part = pairs.select(key, F.lit(name).alias("block"), (F.col("col") + F.lit(start)).alias("col")).distinct()
        stacked = part if stacked is None else stacked.unionByName(part)
        start += width
    return stacked


def fit_token_vectors(tokens: DataFrame, column: str = "tokens") -> CountVectorizerModel:
    """Binary bag-of-tokens vectors for an array column; every token gets a column."""
    size = tokens.select(F.explode(column)).distinct().count()
    return CountVectorizer(inputCol=column, outputCol="features", binary=True, minDF=1.0,
                           vocabSize=max(1, size)).fit(tokens)


def sparse_vectors(triples: DataFrame, key: str, size: int, value: str = "n") -> DataFrame:
    """(key, features): one sparse vector per key from (key, col, value) triples, built in Arrow batches.

    A key has each column once, so its list is at most ``size`` long.
    """
    lists = triples.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(F.col("col").cast("int").alias("col"), F.col(value).cast("double").alias("v")))).alias("cells"))
    schema = T.StructType([triples.schema[key], T.StructField("features", VectorUDT())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(1)
            ends = np.concatenate([[0], np.cumsum(cells.value_lengths().to_numpy())]).astype(np.int32)
            inner = cells.flatten()
            columns, values = (pa.ListArray.from_arrays(ends, inner.field(f)) for f in ("col", "v"))
            parts = [pa.array(np.zeros(len(cells), np.int8)), pa.array(np.full(len(cells), size, np.int32)), columns, values]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.StructArray.from_arrays(parts, ["type", "size", "indices", "values"])], [key, "features"])

    return lists.select(key, "cells").mapInArrow(build, schema)
