"""Choosing features: constant, rarely varying, correlated and uninformative columns."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.operators.aggregates import distinct_counts, value_counts


FIRST_ROWS = 1_000
"""Rows looked at first for columns that vary; the others are looked at whole."""


def constant_columns(df: DataFrame) -> list[str]:
    """Columns with one distinct value, null counted as a value."""
    # most columns vary within a few rows; of the others, those whose extremes agree are counted by value (maps have no extremes)
    early = {row["column"] for row in distinct_counts(df.limit(FIRST_ROWS), df.columns).where("n_unique > 1").collect()}
    ordered = [f.name for f in df.schema.fields if f.name not in early and not _holds_map(f.dataType)]
    seen = df.agg(F.count("*").alias("rows"), *[cell for i, c in enumerate(ordered) for cell in (
        F.count(F.col(f"`{c}`")).alias(f"n{i}"), (F.min(F.col(f"`{c}`")) == F.max(F.col(f"`{c}`"))).alias(f"e{i}"))]).first()
    varying = early | {c for i, c in enumerate(ordered) if seen[f"n{i}"] and not (seen[f"e{i}"] and seen[f"n{i}"] == seen["rows"])}
    left = [c for c in df.columns if c not in varying]
    if not left:
        return []
    found = distinct_counts(df, left).where("n_unique = 1").collect()
    return sorted(row["column"] for row in found)


def _holds_map(kind: T.DataType) -> bool:
    """Maps and variants, also inside other types, cannot be compared."""
    return any(word in kind.simpleString() for word in ("map<", "variant"))


def near_zero_variance(df: DataFrame, columns: Sequence[str], ratio: float = 95 / 5,
                       unique_percent: float = 10.0) -> DataFrame:
    """(column, freq_ratio, percent_unique, zero_var, nzv) for all columns in one job.

    Per column, the most frequent value is taken out before the second count is looked up,
    so the value table is only ever aggregated, never sorted.
    """
    counts = value_counts(df, columns).where(F.col("value").isNotNull())
    top = counts.groupBy("column").agg(
        F.max(F.struct("n", "value")).alias("top"), F.count("*").alias("unique"), F.sum("n").alias("rows"))
    second = (counts.join(top, "column").where(F.col("value") != F.col("top.value"))
              .groupBy("column").agg(F.max("n").alias("second")))
    freq_ratio = F.coalesce(F.col("top.n") / F.col("second"), F.lit(0.0))
    table = top.join(second, "column", "left").select(
        "column", freq_ratio.alias("freq_ratio"),
        (F.lit(100.0) * F.col("unique") / F.col("rows")).alias("percent_unique"),
        (F.col("unique") == 1).alias("zero_var"))
    return table.withColumn("nzv", F.col("zero_var") | (
        (F.col("freq_ratio") > ratio) & (F.col("percent_unique") <= unique_percent)))


def correlation_array(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    vectors = VectorAssembler(inputCols=list(columns), outputCol="_v").transform(df).select("_v")
    return Correlation.corr(vectors, "_v").first()[0].toArray()


def highly_correlated(correlation: np.ndarray, columns: Sequence[str], cutoff: float) -> list[str]:
    """Columns to drop so that no two of the rest correlate above ``cutoff``.

    Columns are visited from the highest mean absolute correlation down. Of a pair above the
    cutoff, the column goes whose mean correlation with the remaining columns is larger than
    the mean over the other rows; p x p numbers, worked on at the driver.
    """
    size = np.abs(correlation)
    order = list(np.argsort(-size.mean(axis=0), kind="stable"))
    left = size.copy()
    np.fill_diagonal(left, np.nan)
    dropped: set[int] = set()
    for place, i in enumerate(order):
        for j in order[place + 1:]:
            if i in dropped:
                break
            if j in dropped or size[i, j] <= cutoff:
                continue
            others = np.delete(left, j, axis=0)
            loser = i if np.nanmean(left[i]) > np.nanmean(others) else j
            dropped.add(loser)
            left[loser, :] = np.nan
            left[:, loser] = np.nan
    return [columns[i] for i in sorted(dropped)]


def common_highly_correlated(train: DataFrame, test: DataFrame, columns: Sequence[str],
                             cutoff: float) -> list[str]:
    """Columns the filter drops both on train and on test."""
    on_test = set(highly_correlated(correlation_array(test, columns), columns, cutoff))
    return [c for c in highly_correlated(correlation_array(train, columns), columns, cutoff) if c in on_test]


def stored_cells(df: DataFrame, features: str, keep: Sequence[str]) -> DataFrame:
    """(keep..., feature, v): the cells other than 0 of an array or vector column, vectors dense or sparse."""
    if isinstance(df.schema[features].dataType, T.ArrayType):
        cells = df.select(*keep, F.posexplode(features).alias("feature", "v"))
    else:
        u = F.unwrap_udt(features)
        cell = lambda i, v: F.struct(i.cast("int").alias("feature"), v.alias("v"))
        listed = F.when(u["type"] == 0, F.zip_with(u["indices"], u["values"], cell)).otherwise(F.transform(u["values"], lambda v, i: cell(i, v)))
        cells = df.select(*keep, F.explode(listed).alias("c")).select(*keep, "c.feature", "c.v")
    return cells.withColumn("v", F.col("v").cast("double")).where("v <> 0")


def anova_of_cells(cells: DataFrame, totals: DataFrame) -> DataFrame:
    """(feature, f): one-way ANOVA F from (class, feature, v) cells other than 0 and (class, n) rows of each class.

    The zeros are known from the class sizes, so work and shuffle grow with the stored cells, not with
    rows x features. A feature without a stored cell has no row; one without spread inside its classes has no f.
    """
    v = F.col("v")
    parts = cells.groupBy("feature", "class").agg(F.sum(v).alias("s"), F.sum(v * v).alias("q")).join(totals, "class")
    rows, classes = totals.agg(F.sum("n"), F.count("*")).first()
    total = parts.groupBy("feature").agg(F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"))
    between = (F.col("b") - F.col("s") * F.col("s") / F.lit(rows)) / F.lit(max(classes - 1, 1))
    within = (F.col("q") - F.col("b")) / F.lit(max((rows or 0) - classes, 1))
    return total.select("feature", F.try_divide(between, within).alias("f"))


def anova_scores(df: DataFrame, features: str, label: str) -> DataFrame:
    """(feature, f): one-way ANOVA F of every element of the array or vector column ``features``."""
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).alias("class"), features)
    return anova_of_cells(stored_cells(rows, features, ["class"]), rows.groupBy("class").agg(F.count("*").alias("n")))


def select_percentile(scores: DataFrame, percent: float) -> list[int]:
    """Features scoring above the (100 - percent) percentile of the scores."""
    rows = scores.where("f is not null").collect()  # one row per feature
    values = np.array([row["f"] for row in rows])
    threshold = np.percentile(values, 100 - percent)
    return sorted(row["feature"] for row in rows if row["f"] > threshold)
