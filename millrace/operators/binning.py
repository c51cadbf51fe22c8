"""Quantile buckets, their indicator columns and the utilisation tiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import scalars as S
from millrace.functions.hashing import hash_fraction
from millrace.operators.ordered import quantiles


def quantile_edges(df: DataFrame, buckets: Mapping[str, int]) -> dict[str, list[float]]:
    """The n + 1 interpolated edges of every column, all in the same jobs."""
    found = quantiles(df, {c: [i / n for i in range(n + 1)] for c, n in buckets.items()})
    for c, edges in found.items():
        if any(a == b for a, b in zip(edges, edges[1:])):
            raise ValueError(f"bucket edges of {c} must be unique: {edges}")
    return found


def bucket_code(c: Column | str, edges: Sequence[float]) -> Column:
    """0-based bucket, right-closed; null stays null, values outside go to the end buckets."""
    c = F.col(c) if isinstance(c, str) else c
    code = sum(((c > F.lit(e)).cast("int") for e in edges[1:-1]), F.lit(0))
    return F.when(c.isNotNull(), code)


def indicators(code: Column, values: Sequence, prefix: str) -> dict[str, Column]:
    """One 0/1 column per value; all 0 for null."""
    return {f"{prefix}_{v}": F.when(code == v, 1).otherwise(0) for v in values}


def jitter(df: DataFrame, column: str, key: str, seed: int, noise_reduction: float = 1e6) -> Column:
    """The column plus uniform noise of width std / noise_reduction, drawn from the key."""
    spread = df.agg(F.stddev_samp(column)).first()[0] or 0.0
    width = spread / noise_reduction
    return F.col(column) + (hash_fraction(key, seed) * F.lit(width) - F.lit(width / 2))


class BucketModel:
    """Edges learned from one table, applied to any other, so schemas agree."""

    def __init__(self, column: str, edges: Sequence[float]):
        self.column, self.edges = column, list(edges)
        self.name = S.bucket_name(column)

    @classmethod
    def fit(cls, df: DataFrame, column: str, buckets: int) -> BucketModel:
        return cls(column, quantile_edges(df, {column: buckets})[column])

    def transform(self, df: DataFrame, dummies: bool = True, drop_original: bool = True,
                  drop_bucket: bool = True, values: Column | None = None) -> DataFrame:
        code = bucket_code(self.column if values is None else values, self.edges)
        added = {self.name: code}
        if dummies:
            added |= indicators(code, range(len(self.edges) - 1), self.name)
        drops = ([self.column] if drop_original else []) + ([self.name] if dummies and drop_bucket else [])
        return df.withColumns(added).drop(*drops)


def split_into_buckets(train: DataFrame, test: DataFrame | None, column: str, buckets: int,
                       refit_on_test: bool = False, jitter_key: str | None = None, seed: int = 0,
                       **options) -> tuple[DataFrame, DataFrame | None]:
    """Bucket ``column`` of both tables; edges come from ``train`` unless refitted."""

    def run(df: DataFrame, fitted: BucketModel | None) -> tuple[DataFrame, BucketModel]:
        values = jitter(df, column, jitter_key, seed) if jitter_key else F.col(column)
        if fitted is None:
            edges = quantile_edges(df.select(values.alias("_jittered")), {"_jittered": buckets})
            fitted = BucketModel(column, edges["_jittered"])
        return fitted.transform(df, values=values, **options), fitted

    train_out, model = run(train, None)
    if test is None:
        return train_out, None
    return train_out, run(test, None if refit_on_test else model)[0]


# Names of the utilisation tiers 0 to 3.
TIER_NAMES = ["has_no_cards_cancelled", "has_1_card_cancelled", "has_2_cards_cancelled",
              "has_3ormore_cards_cancelled"]


class UtilisationModel:
    """Four tier flags and the quantile buckets of the normal range 0 to 1."""

    def __init__(self, column: str, edges: Sequence[float]):
        self.column, self.edges = column, list(edges)

    @classmethod
    def fit(cls, df: DataFrame, column: str, buckets: int = 9) -> UtilisationModel:
        normal = df.where(F.col(column).between(0, 1))
        return cls(column, quantile_edges(normal, {column: buckets})[column])

    def transform(self, df: DataFrame) -> DataFrame:
        c = F.col(self.column)
        tier = S.tier_code(c)
        code = F.when(c.between(0, 1), bucket_code(c, self.edges))
        flags = {name: F.when(tier == i, 1).otherwise(0) for i, name in enumerate(TIER_NAMES)}
        flags |= indicators(code, range(len(self.edges) - 1), S.bucket_name(self.column))
        return df.withColumns(flags).drop(self.column)


def bucket_summary(df: DataFrame, column: str, code: Column, buckets: int) -> DataFrame:
    """(bucket, min, max, rows) with a row for every bucket, empty ones included."""
    used = df.where(F.col(column).isNotNull()).groupBy(code.alias("bucket")).agg(
        F.min(column).alias("min_value"), F.max(column).alias("max_value"),
        F.count(column).alias("num_records"))
    every = df.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    return every.join(used, "bucket", "left").na.fill({"num_records": 0})
