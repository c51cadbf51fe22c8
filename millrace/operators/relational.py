"""Projection, filter, join and set helpers where Spark has no one-liner."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

HOT_SHARE = 0.005
"""A join key counts as hot above this share of the rows (so at most 200 keys are)."""


def columns_difference(df: DataFrame, excluded: Sequence[str]) -> list[str]:
    return sorted(set(df.columns) - set(excluded))


def columns_of(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``numeric`` or ``string`` columns."""
    wanted = {"numeric": T.NumericType, "string": T.StringType}[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]


def first_of_repeated_columns(df: DataFrame) -> DataFrame:
    """Keep the first of the columns that share a name."""
    positional = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    first = {}
    for i, name in enumerate(df.columns):
        first.setdefault(name, i)
    return positional.select(*[F.col(f"_{i}").alias(name) for name, i in first.items()])


def drop_listed(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Drop rows whose value is listed; rows without a value stay."""
    return df.where(~F.coalesce(F.col(column).isin(list(values)), F.lit(False)))


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in left.columns if c in set(right.columns)]


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Equi-join on every column name both sides have."""
    return left.join(right, shared_columns(left, right), how)


def join_suffixed(left: DataFrame, right: DataFrame, on: Sequence[str],
                  suffixes: tuple[str, str] = ("_x", "_y"), how: str = "inner") -> DataFrame:
    """Equi-join that renames the other columns both sides have."""
    both = [c for c in shared_columns(left, right) if c not in on]
    return (left.withColumnsRenamed({c: c + suffixes[0] for c in both})
            .join(right.withColumnsRenamed({c: c + suffixes[1] for c in both}), list(on), how))


def hot_keys(df: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> list[tuple]:
    """Keys that hold more than ``share`` of the rows, at most ``1 / share`` of them."""
    counts = df.where(F.col(on[0]).isNotNull()).groupBy(*on).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    if not total:
        return []
    return [tuple(row[k] for k in on) for row in counts.where(F.col("_n") > total * share).collect()]


def hot_split_join(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left",
                   share: float = HOT_SHARE) -> DataFrame:
    """Join many rows to one row per key, with the hot keys of ``fact`` taken out of the shuffle.

    ``dim`` has one row per key, so the part of it that matches hot keys is at most
    ``1 / share`` rows: that part is broadcast. All other keys go through the planner's join.
    """
    on = list(on)
    keys = hot_keys(fact, on, share)
    if not keys:
        return fact.join(dim, on, how)

    def is_hot(df: DataFrame) -> Column:
        test = F.lit(False)
        if len(on) == 1:
            test = F.col(on[0]).isin([k[0] for k in keys])
        else:
            for key in keys:
                one = F.lit(True)
                for name, value in zip(on, key):
                    one = one & (F.col(name) == F.lit(value))
                test = test | one
        return F.coalesce(test, F.lit(False))

    hot = fact.where(is_hot(fact)).join(F.broadcast(dim.where(is_hot(dim))), on, how)
    return fact.where(~is_hot(fact)).join(dim, on, how).unionByName(hot)


def assign_where(df: DataFrame, condition: Column, values: Mapping[str, Column],
                 default: object = 0) -> DataFrame:
    """Columns computed for the rows of a filter, ``default`` on the other rows (no join)."""
    return df.withColumns({
        name: F.coalesce(F.when(condition, value), F.lit(default)) for name, value in values.items()})


def complete_keys(df: DataFrame, template: DataFrame, key: str) -> DataFrame:
    """Every key of ``template``: its row where ``df`` has none, sorted by key."""
    missing = template.join(df.select(key).distinct(), key, "left_anti")
    return df.unionByName(missing.select(*df.columns)).orderBy(key)


def merge_runs(runs: DataFrame, key: str, run: str, value: str, run_ids: Sequence,
               prefix: str = "p") -> DataFrame:
    """One column per run for the keys every run has; one shuffle for any number of runs."""
    wide = runs.groupBy(key).agg(*[
        F.max(F.when(F.col(run) == r, F.col(value))).alias(f"{prefix}{r}") for r in run_ids],
        F.count_distinct(F.when(F.col(run).isin(list(run_ids)), F.col(run))).alias("_runs"))
    return wide.where(F.col("_runs") == len(run_ids)).drop("_runs")


def stack_sources(train: DataFrame, test: DataFrame, marker: str = "is_train") -> DataFrame:
    return (train.withColumn(marker, F.lit(True))
            .unionByName(test.withColumn(marker, F.lit(False)), allowMissingColumns=True))


def gaps_in_sequence(df: DataFrame, column: str) -> DataFrame:
    """Integers missing between the smallest and the largest value.

    The span is generated by ``range`` (spread over tasks), never as one array.
    """
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None:
        return df.select(F.col(column).cast("bigint").alias(column)).limit(0)
    span = df.sparkSession.range(low, high + 1).withColumnRenamed("id", column)
    present = df.select(F.col(column).cast("bigint").alias(column)).distinct()
    return span.join(present, column, "left_anti")
