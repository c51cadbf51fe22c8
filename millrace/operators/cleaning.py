"""Imputation, scaling, winsorising and outlier flags."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.aggregates import value_counts
from millrace.operators.ordered import medians, order_statistics, quantiles
from millrace.operators.relational import columns_of

OUTLIER_THRESHOLD = 3.5
"""Modified z-score above which a value counts as an outlier."""
NORMAL_CONSISTENCY = 0.6745


# imputation

def mean_mode_fill(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Mean of numeric columns, most frequent value of the others (smallest among ties)."""
    numeric = [c for c in columns if c in columns_of(df, "numeric")]
    texts = [c for c in columns if c not in numeric]
    fill: dict[str, object] = {}
    if numeric:
        fill |= df.agg(*[F.avg(c).alias(c) for c in numeric]).first().asDict()
    if texts:
        counts = value_counts(df, texts).where(F.col("value").isNotNull())
        best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("b"))
        fill |= {row["column"]: row["b"]["value"] for row in best.collect()}
    return {c: v for c, v in fill.items() if v is not None}


class MixedImputerModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fills nulls with the learned value of each column."""

    fill = Param(Params._dummy(), "fill", "fill value per column, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, fill: str = "{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def values(self) -> dict[str, object]:
        return json.loads(self.getOrDefault(self.fill))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # a fraction learned on an integer column makes that column a double
        return dataset.withColumns({
            c: F.coalesce(F.col(c), F.lit(v)) for c, v in self.values().items() if c in dataset.columns})


class MixedImputer(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Mean for numeric columns, mode for text columns; usable in an ML Pipeline."""

    inputCols = Param(Params._dummy(), "inputCols", "columns to fill", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> MixedImputerModel:
        columns = self.getOrDefault(self.inputCols) if self.isSet(self.inputCols) else dataset.columns
        return MixedImputerModel(fill=json.dumps(mean_mode_fill(dataset, columns)))


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls replaced by the exact median of their column."""
    middle = {c: m for c, m in medians(df, columns).items() if m is not None}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m)) for c, m in middle.items()})


def fit_column_regressor(train: DataFrame, target: str, features: Sequence[str],
                         trees: int = 200, depth: int = 10, seed: int = 0) -> PipelineModel:
    """Forest that predicts ``target`` from the rows where it is known."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="error"),
        RandomForestRegressor(featuresCol="_features", labelCol=target, predictionCol="_predicted",
                              numTrees=trees, maxDepth=depth, seed=seed),
    ]).fit(train.where(F.col(target).isNotNull()))


def fill_by_regression(df: DataFrame, model: PipelineModel, target: str) -> DataFrame:
    """Add ``<target>_Imputed``: the known value, or the prediction cut to a whole number."""
    predicted = model.transform(df).drop("_features")
    whole = F.col("_predicted").cast("bigint").cast("double")
    return predicted.withColumn(f"{target}_Imputed", F.coalesce(F.col(target).cast("double"), whole)).drop(
        "_predicted")


# scaling

class MinMaxModel:
    """(x - min) / (max - min) per column; a constant column becomes 0."""

    def __init__(self, bounds: Mapping[str, tuple[float, float]]):
        self.bounds = dict(bounds)

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> MinMaxModel:
        row = df.agg(*[F.min(c).cast("double").alias(f"low_{i}") for i, c in enumerate(columns)],
                     *[F.max(c).cast("double").alias(f"high_{i}") for i, c in enumerate(columns)]).first()
        return cls({c: (row[f"low_{i}"], row[f"high_{i}"]) for i, c in enumerate(columns)})

    def transform(self, df: DataFrame) -> DataFrame:
        def scaled(c: str) -> Column:
            low, high = self.bounds[c]
            if low is None or high == low:
                return F.when(F.col(c).isNotNull(), F.lit(0.0))
            return (F.col(c) - F.lit(low)) / F.lit(high - low)
        return df.withColumns({c: scaled(c) for c in self.bounds})

    def inverse(self, column: Column, name: str) -> Column:
        """Back to the scale of ``name``, cut to a whole number."""
        low, high = self.bounds[name]
        return (column * F.lit(high - low) + F.lit(low)).cast("bigint")


# extremes

def winsor_bounds(df: DataFrame, columns: Sequence[str], share: float = 0.05) -> dict[str, tuple]:
    """Order statistics floor(share * n) places from either end, per column."""
    def places(n):
        cut = int(share * n)
        return [cut, n - cut - 1]
    found = order_statistics(df, {c: places for c in columns})
    return {c: tuple(values) for c, (n, values) in found.items() if n}


def winsorize(df: DataFrame, columns: Sequence[str], share: float = 0.05) -> DataFrame:
    """Values beyond the bounds moved onto them; nulls untouched."""
    bounds = winsor_bounds(df, columns, share)
    return df.withColumns({
        c: F.when(F.col(c).isNotNull(), F.greatest(F.least(F.col(c), F.lit(high)), F.lit(low)))
        for c, (low, high) in bounds.items()})


def _outside(c: Column, low: float, high: float) -> Column:
    return (c < F.lit(low)) | (c > F.lit(high))


def _beyond(deviation: Column, spread: Column, threshold: float) -> Column:
    """Modified z-score above the threshold; with no spread any deviation is beyond."""
    score = F.try_divide(F.lit(NORMAL_CONSISTENCY) * deviation, spread)
    return F.when(spread == 0, deviation > 0).otherwise(score > threshold)


def _two_sided(c: Column, middle: float, left: float, right: float, threshold: float) -> Column:
    spread = F.when(c > middle, F.lit(right)).otherwise(F.lit(left))
    return F.when(c == middle, F.lit(False)).otherwise(_beyond(F.abs(c - F.lit(middle)), spread, threshold))


def _spreads(df: DataFrame, column: str, middle: float) -> dict[str, float | None]:
    """Median distance from the median: of all values, of those up to it, of those from it."""
    c = F.col(column)
    away = F.abs(c - F.lit(middle))
    return medians(df.select(away.alias("all"), F.when(c <= middle, away).alias("left"),
                             F.when(c >= middle, away).alias("right")), ["all", "left", "right"])


def percentile_outlier(df: DataFrame, column: str, threshold: float = 95) -> Column:
    """True outside the central ``threshold`` percent."""
    tail = (100 - threshold) / 200
    return _outside(F.col(column), *quantiles(df, {column: [tail, 1 - tail]})[column])


def mad_outlier(df: DataFrame, column: str, threshold: float = OUTLIER_THRESHOLD) -> Column:
    """True where the distance from the median is large against the median distance."""
    middle = medians(df, [column])[column]
    away = F.abs(F.col(column) - F.lit(middle))
    spread = medians(df.select(away.alias("_d")), ["_d"])["_d"]
    return _beyond(away, F.lit(spread), threshold)


def double_mad_outlier(df: DataFrame, column: str, threshold: float = OUTLIER_THRESHOLD) -> Column:
    """The same with separate median distances left and right of the median."""
    middle = medians(df, [column])[column]
    spread = _spreads(df, column, middle)
    return _two_sided(F.col(column), middle, spread["left"], spread["right"], threshold)


def outlier_votes(df: DataFrame, column: str, min_votes: int = 3, percent: float = 95,
                  threshold: float = OUTLIER_THRESHOLD) -> DataFrame:
    """Flags of the three detectors, their number and whether it reaches ``min_votes``.

    Two fits serve all three: bounds and median together, then the three median distances.
    """
    c, tail = F.col(column), (100 - percent) / 200
    low, middle, high = quantiles(df, {column: [tail, 0.5, 1 - tail]})[column]
    spread = _spreads(df, column, middle)
    flags = {
        "by_percentile": _outside(c, low, high),
        "by_mad": _beyond(F.abs(c - F.lit(middle)), F.lit(spread["all"]), threshold),
        "by_double_mad": _two_sided(c, middle, spread["left"], spread["right"], threshold),
    }
    flagged = df.withColumns({name: F.coalesce(flag, F.lit(False)) for name, flag in flags.items()})
    votes = sum((F.col(name).cast("int") for name in flags), F.lit(0))
    return flagged.withColumn("votes", votes).withColumn("is_outlier", F.col("votes") >= min_votes)
