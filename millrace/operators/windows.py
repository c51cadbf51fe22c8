"""Differences along a sorted column, scale detection, ranking of candidates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from millrace.functions.scalars import round_half_even
from millrace.operators.ordered import order_statistics, split_points, tag_range


def value_gaps(values: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values with ``gap``, the difference to the next smaller one (null for the first).

    Values are cut into ranges; the first value of a range takes its neighbour from the
    largest value of the nearest filled range below, so no range waits for another.
    """
    by = list(by)
    distinct = values.select(*by, column).where(F.col(column).isNotNull()).distinct()
    tagged = tag_range(distinct, column, split_points(values, column))
    tops = tagged.groupBy(*by, "_range").agg(F.max(column).alias("_top"))
    below = tops.select(
        *[F.col(b).alias(f"_by_{b}") for b in by], F.col("_range").alias("_block"),
        F.lag("_top").over(Window.partitionBy(*by).orderBy("_range")).alias("_below"))
    match = F.col("_range") == F.col("_block")
    for b in by:
        match = match & (F.col(b) == F.col(f"_by_{b}"))
    inside = F.lag(column).over(Window.partitionBy(*by, "_range").orderBy(column))
    joined = tagged.withColumn("_previous", inside).join(below, match)
    return joined.select(
        *by, column, (F.col(column) - F.coalesce("_previous", "_below")).alias("gap"))


def scale_steps(df: DataFrame, columns: Sequence[str], smallest: float = 1e-6) -> DataFrame:
    """(column, step, n): the most common gap of every column's sorted values.

    All columns run in one job as (column, value) rows; the smallest step wins a tie.
    """
    long = df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value").select("column", round_half_even("value", 8).alias("value"))
    gaps = value_gaps(long, "value", by=["column"]).where(F.col("gap") > smallest)
    counted = gaps.groupBy("column", round_half_even("gap", 8).alias("step")).agg(F.count("*").alias("n"))
    best = counted.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("n"), "step")).alias("b"))
    return best.select("column", F.col("b.step").alias("step"), (-F.col("b.n")).alias("n"))


def undo_scaling(df: DataFrame, steps: Mapping[str, float]) -> DataFrame:
    """Near-zero values snapped to 0, then every column divided by its step."""
    def unscaled(c: str):
        snapped = F.when(round_half_even(c, 5) == 0, F.lit(0.0)).otherwise(F.col(c))
        return snapped * (1 / F.lit(steps[c]))
    return df.withColumns({c: unscaled(c) for c in steps})


def rank_scores(scores: DataFrame, candidate: str, score: str, n_top: int = 5) -> DataFrame:
    """Best candidates by mean score over folds: (rank, candidate, mean, std).

    The top is taken first, so the numbering runs on ``n_top`` rows.
    """
    summary = scores.groupBy(candidate).agg(
        F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"))
    top = summary.orderBy(F.desc("mean"), candidate).limit(n_top)
    return top.select(
        F.row_number().over(Window.orderBy(F.desc("mean"), candidate)).alias("rank"),
        candidate, "mean", "std")


def nth_smallest(df: DataFrame, column: str, n: int) -> float | None:
    """n-th smallest value (1-based); n is cut to the number of values."""
    return _nth(df, column, lambda size: min(n, size) - 1)


def nth_largest(df: DataFrame, column: str, n: int) -> float | None:
    return _nth(df, column, lambda size: size - min(n, size))


def _nth(df, column, place):
    size, values = order_statistics(df, {column: lambda count: [place(count)]})[column]
    return values[0] if size else None
