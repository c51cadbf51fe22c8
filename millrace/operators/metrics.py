"""Scores of predictions, as aggregates over (truth, prediction) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.scalars import clip_probability
from millrace.operators.ordered import medians, running_totals

GRID_STEPS = 99
"""The mean curve is taken at 100 evenly spaced false positive rates."""


def log_loss(y: Column, p: Column, eps: float = 1e-15) -> Column:
    """Aggregate: mean binary log loss; ``y`` may be a probability too."""
    p = clip_probability(p, eps)
    return -F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))


def log_loss_multiclass(truth: Column, probabilities: Column, eps: float = 1e-15) -> Column:
    """Aggregate: mean -ln of the probability given to the true class (0-based index)."""
    return -F.avg(F.log(clip_probability(F.get(probabilities, truth.cast("int")), eps)))


def score_counts(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    return df.groupBy(*by, score).agg(
        F.count_if(F.col(y) == 1).alias("positives"), F.count_if(F.col(y) != 1).alias("negatives"))


def _cumulated(df: DataFrame, y: str, score: str, by: Sequence[str]) -> DataFrame:
    """Counts at or above each score, with the totals of the group."""
    counts = score_counts(df, y, score, by)
    summed = running_totals(counts, score, ["positives", "negatives"], by, descending=True)
    totals = df.groupBy(*by).agg(F.count_if(F.col(y) == 1).alias("all_pos"),
                                 F.count_if(F.col(y) != 1).alias("all_neg"))
    if by:
        joined = summed.join(totals, list(by))
    else:
        joined = summed.withColumns({c: F.lit(n) for c, n in totals.first().asDict().items()})
    return joined.withColumns({"tp": F.col("positives_before") + F.col("positives"),
                               "fp": F.col("negatives_before") + F.col("negatives")})


def roc_curve(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score."""
    return _cumulated(df, y, score, by).select(
        *by, F.col(score).alias("threshold"),
        F.try_divide(F.col("fp"), F.col("all_neg")).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("all_pos")).alias("tpr"))


def roc_auc(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the curve as ``auc``: the share of (positive, negative) pairs in the right
    order, ties counting half."""
    counts = score_counts(df, y, score, by)
    summed = running_totals(counts, score, ["negatives"], by)
    right = F.col("positives") * (F.col("negatives_before") + F.col("negatives") / F.lit(2.0))
    return summed.groupBy(*by).agg(F.try_divide(
        F.sum(right), F.sum("positives") * F.sum("negatives").cast("double")).alias("auc"))


def mean_roc(df: DataFrame, fold: str, y: str, score: str) -> DataFrame:
    """(fpr, tpr): mean over folds of the interpolated curve on 100 points, from 0 to 1.

    Every curve point belongs to one grid interval on either side, so the neighbours of a
    grid point come from per-interval extremes: at most 100 rows per fold are ever ordered.
    """
    points = _cumulated(df, y, score, [fold]).select(
        fold, "tp", "fp", "all_pos", "all_neg",
        F.struct((F.col("fp") / F.col("all_neg")).alias("x"), (F.col("tp") / F.col("all_pos")).alias("y"))
        .alias("point"))
    # first grid index at or after the point, and last grid index before it, in whole numbers
    scaled = F.col("fp") * GRID_STEPS
    after = F.ceil(scaled / F.col("all_neg")).cast("int")
    exact = F.when((after - 1) * F.col("all_neg") >= scaled, after - 1).otherwise(
        F.when(after * F.col("all_neg") < scaled, after + 1).otherwise(after))
    tagged = points.withColumn("g", exact)
    last_left = tagged.groupBy(fold, "g").agg(F.max("point").alias("left"))
    first_right = tagged.groupBy(fold, (F.col("g") - 1).alias("g")).agg(F.min("point").alias("right"))
    grid = df.select(fold).distinct().select(
        fold, F.explode(F.sequence(F.lit(0), F.lit(GRID_STEPS))).alias("g"))
    so_far = Window.partitionBy(fold).orderBy("g")
    from_here = so_far.rowsBetween(0, Window.unboundedFollowing)
    origin = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    sides = (grid.join(last_left, [fold, "g"], "left").join(first_right, [fold, "g"], "left")
             .select(fold, "g", F.coalesce(F.max("left").over(so_far), origin).alias("left"),
                     F.min("right").over(from_here).alias("right")))
    x = F.col("g") / F.lit(float(GRID_STEPS))
    slope = (F.col("right.y") - F.col("left.y")) / (F.col("right.x") - F.col("left.x"))
    value = F.coalesce(F.col("left.y") + slope * (x - F.col("left.x")), F.col("left.y"))
    value = F.when(F.col("g") == 0, F.lit(0.0)).otherwise(value)
    mean = sides.select("g", value.alias("v")).groupBy("g").agg(F.avg("v").alias("tpr"))
    return mean.select("g", x.alias("fpr"),
                       F.when(F.col("g") == GRID_STEPS, F.lit(1.0)).otherwise(F.col("tpr")).alias("tpr"))


def curve_area(curve: DataFrame) -> DataFrame:
    """Trapezoid area of a 100-point mean curve."""
    step = Window.orderBy("g")
    width = F.col("fpr") - F.lag("fpr").over(step)
    height = (F.col("tpr") + F.lag("tpr").over(step)) / 2
    return curve.select((width * height).alias("a")).agg(F.sum("a").alias("auc"))


def rmspe(y: Column, p: Column) -> Column:
    """Aggregate: root mean square relative error of log-scale predictions."""
    return F.sqrt(F.avg(F.pow(F.expm1(p) / F.expm1(y) - 1, 2)))


def median_absolute_error(df: DataFrame, y: str, p: str) -> float | None:
    return medians(df.select(F.abs(F.col(y) - F.col(p)).alias("_d")), ["_d"])["_d"]


def classification_scores(df: DataFrame, y: str, p: str) -> DataFrame:
    """Accuracy, precision, recall and F1 of 0/1 predictions, one row."""
    hit = (F.col(y) == 1) & (F.col(p) == 1)
    counts = df.agg(
        F.count_if(hit).alias("tp"), F.count_if((F.col(y) != 1) & (F.col(p) == 1)).alias("fp"),
        F.count_if((F.col(y) == 1) & (F.col(p) != 1)).alias("fn"),
        F.count_if(F.col(y) == F.col(p)).alias("right"), F.count("*").alias("n"))
    return counts.select(
        "tp", "fp", "fn", F.try_divide("right", "n").alias("accuracy"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


class ColumnEvaluator(Evaluator):
    """ML evaluator from any aggregate of label and prediction columns."""

    def __init__(self, aggregate, larger_is_better: bool = False):
        super().__init__()
        self.aggregate = aggregate
        self.larger_is_better = larger_is_better

    def _evaluate(self, dataset: DataFrame) -> float:
        return float(dataset.agg(self.aggregate).first()[0])

    def isLargerBetter(self) -> bool:
        return self.larger_is_better


def rmspe_evaluator(label: str = "label", prediction: str = "prediction") -> ColumnEvaluator:
    return ColumnEvaluator(rmspe(F.col(label), F.col(prediction)))


class AreaEvaluator(Evaluator):
    """Exact area under the ROC curve of a probability or score column."""

    def __init__(self, label: str = "label", score: str = "score"):
        super().__init__()
        self.label, self.score = label, score

    def _evaluate(self, dataset: DataFrame) -> float:
        return float(roc_auc(dataset, self.label, self.score).first()["auc"])

    def isLargerBetter(self) -> bool:
        return True
