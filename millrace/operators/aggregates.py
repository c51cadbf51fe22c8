"""Grouped, pivoted and whole-column aggregates."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.operators.ordered import number_rows, quantiles
from millrace.operators.relational import columns_of
from millrace.session import shipped

DENSE_LIMIT = 1_000
"""Widest table a pivot may build; above it use ``wide_sums`` or the long (sparse) form."""
WIDE_CELLS = 1_000_000
"""Cells of a wide table that are unfolded at once."""
PIVOT_ROWS = 500_000
"""Rows of a pivot that one task sums, about."""


def sum_columns(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum of every numeric column that is not a key."""
    values = [c for c in columns_of(df, "numeric") if c not in keys]
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in values])


def group_sizes(df: DataFrame, keys: Sequence[str], name: str = "size") -> DataFrame:
    """Rows per composite key; rows with a missing key part are left out."""
    return df.na.drop(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias(name))


def counts_by_category(df: DataFrame, key: str, category: Column, values: Sequence,
                       prefix: str) -> DataFrame:
    """One count column per listed category value, 0 where none; one shuffle on the key."""
    return df.groupBy(key).agg(*[F.count_if(category == v).alias(f"{prefix}{v}") for v in values])


def small_levels(df: DataFrame, column: str, limit: int = DENSE_LIMIT) -> list:
    """Sorted distinct values, for columns whose number of values is known to be small."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} values: use the sparse form")
    return sorted(row[0] for row in rows)


def pivot_sum(df: DataFrame, keys: Sequence[str], category: str, names: Mapping, value: str) -> DataFrame:
    """Sum of ``value`` per listed category as columns, 0 where a group has none.

    Rows meet by key in as many tasks as their number asks for, so the sums a task holds do not grow with the table.
    """
    if len(names) > DENSE_LIMIT:
        if len(keys) > 1:
            raise ValueError("more columns than a pivot may build: join the keys into one")
        return wide_sums(df, keys[0], category, names, F.col(value))
    cells = df.select(*dict.fromkeys([*keys, category, value]))
    met = cells.repartition(_pivot_tasks(df), *keys) if keys else cells
    wide = met.groupBy(*keys).pivot(category, list(names)).agg(F.sum(value))
    return wide.select(*keys, *[
        F.coalesce(F.col(f"`{level}`"), F.lit(0)).alias(name) for level, name in names.items()])


def _pivot_tasks(df: DataFrame) -> int:
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    # small tables: no more tasks than cores
    return max(1, -(-rows // PIVOT_ROWS), min(cores, -(-rows // (PIVOT_ROWS // 50))))


def wide_sums(df: DataFrame, key: str, category: str, names: Mapping, value: Column) -> DataFrame:
    """Sum of ``value`` per listed category as columns, 0 where a key has none; any number of categories.

    Sums stay in long form through the only shuffles; a key's list of (column, sum) is then unfolded into its row,
    batch by batch in Arrow columns, so neither the plan nor generated code grows with the columns.
    """
    spark = shipped(df.sparkSession)
    levels = list(names)
    numbered = spark.createDataFrame([(level, i) for i, level in enumerate(levels)],
                                     T.StructType([T.StructField("_level", df.schema[category].dataType), T.StructField("_place", T.IntegerType())]))
    sums = df.groupBy(F.col(key).alias("_key"), F.col(category).alias("_level")).agg(F.sum(value.cast("double")).alias("_sum"))
    cell = F.when(F.col("_place").isNotNull(), F.struct("_place", "_sum"))
    lists = sums.join(numbered, "_level", "left").groupBy("_key").agg(F.collect_list(cell).alias("_cells"))
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *[T.StructField(n, T.DoubleType()) for n in names.values()]])
    width = len(levels)
    rows_at_once = max(1, WIDE_CELLS // max(width, 1))

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, rows_at_once):
                batch = whole.slice(begin, rows_at_once)
                cells = batch.column("_cells")
                owner = np.repeat(np.arange(len(cells)), cells.value_lengths().to_numpy())
                inner = cells.flatten()
                dense = np.zeros((width, len(cells)))
                dense[inner.field("_place").to_numpy(), owner] = inner.field("_sum").fill_null(0.0).to_numpy()
                yield pa.RecordBatch.from_arrays([batch.column("_key"), *[pa.array(line) for line in dense]], schema=arrow(batch.schema.field("_key").type))

    def arrow(kind: pa.DataType) -> pa.Schema:
        return pa.schema([pa.field(key, kind), *[pa.field(n, pa.float64()) for n in names.values()]])

    return lists.mapInArrow(unfold, schema)


def join_text(df: DataFrame, key: str, value: str, order: str, separator: str = " ",
              block: int = 10_000) -> DataFrame:
    """Values of a group joined in order, as (key, block, text).

    A group of up to ``block`` rows gives one row; a longer one continues in blocks 1, 2 ...,
    so no task ever holds more than ``block`` values of one group.
    """
    numbered = number_rows(df.select(key, value, order), order, "_n", by=[key])
    blocks = numbered.groupBy(key, F.floor(F.col("_n") / block).cast("int").alias("block"))
    items = F.transform(F.array_sort(F.collect_list(F.struct("_n", F.col(value).cast("string").alias("v")))),
                        lambda item: item["v"])
    return blocks.agg(F.array_join(items, separator).alias("text"))


def distinct_tokens(df: DataFrame, key: str, token: Column) -> DataFrame:
    """Sorted distinct tokens per key as an array.

    Pairs are made distinct before they are collected, so an array is as long as the number
    of different tokens, however many rows the key has.
    """
    pairs = df.select(key, token.alias("_token")).where(F.col("_token").isNotNull()).distinct()
    return pairs.groupBy(key).agg(F.array_sort(F.collect_list("_token")).alias("tokens"))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value as text, n) for all columns in one job; null is a value."""
    texts = df.select([F.col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot([], list(columns), "column", "value").groupBy("column", "value").agg(
        F.count("*").alias("n"))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_unique), null counted as one value; string columns unless told otherwise."""
    columns = columns_of(df, "string") if columns is None else columns
    return value_counts(df, columns).groupBy("column").agg(F.count("*").alias("n_unique"))


def mode(df: DataFrame, column: str) -> DataFrame:
    """Most frequent known value, the smallest one among ties."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    best = counts.agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(column).alias("v"))).alias("b"))
    return best.select(F.col("b.v").alias("mode"), (-F.col("b.n")).alias("n"))


def describe(df: DataFrame, column: str, source: str) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of one column."""
    low, middle, high = quantiles(df, {column: [0.25, 0.5, 0.75]})[column]
    c = F.col(column)
    return df.agg(
        F.lit(source).alias("source"), F.count(c).alias("count"), F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.lit(low).alias("q25"),
        F.lit(middle).alias("q50"), F.lit(high).alias("q75"), F.max(c).alias("max"))


def null_counts(df: DataFrame) -> DataFrame:
    """(column, n) for the columns that have nulls, all columns in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "column", "n").where("n > 0")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair as (c1, c2, r)."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="_v").transform(df).select("_v")
    matrix = Correlation.corr(vectors, "_v").first()[0].toArray()
    cells = [(a, b, float(matrix[i][j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(cells, "c1 string, c2 string, r double")


def keep_one(df: DataFrame, key: str, order: str, keep: str = "first") -> DataFrame:
    """The first or last row per key along ``order`` (combined before the shuffle)."""
    pick = {"first": F.min_by, "last": F.max_by}[keep]
    others = [c for c in df.columns if c != key]
    chosen = df.groupBy(key).agg(pick(F.struct(*others), F.col(order)).alias("_row"))
    return chosen.select(key, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)


def normalise_row(columns: Sequence[str], suffix: str = "_n") -> list[Column]:
    """Each count column divided by the row's total; null for an empty row."""
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    return [F.try_divide(F.col(c), total).alias(c + suffix) for c in columns]
