"""Credit default: extremes, buckets and an imputed income, then the model with the best AUC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.operators import binning as B, cleaning as C, models as M, tuning as U
from millrace.operators.metrics import AreaEvaluator
from millrace.operators.relational import columns_difference, complete_keys, drop_listed
from millrace.operators.sampling import stratified_folds, stratified_split
from millrace.session import cut_lineage

# Short names of the input columns, and the codes that stand for no answer.
SHORT_NAMES = {
    "NumberOfTime30-59DaysPastDueNotWorse": "NumLate3059",
    "NumberOfTime60-89DaysPastDueNotWorse": "NumLate6089",
    "NumberOfTimes90DaysLate": "NumLate90",
    "NumberOfOpenCreditLinesAndLoans": "NumOCLL",
    "NumberRealEstateLoansOrLines": "NumRELL",
    "NumberOfDependents": "NumDependents",
    "RevolvingUtilizationOfUnsecuredLines": "RUoUL",
}
BAD_CODES = [96, 98]
TARGET = "SeriousDlqin2yrs"
EXTREMES = ["MonthlyIncome", "DebtRatio", "NumOCLL", "NumRELL"]
INCOME_FEATURES = ["RUoUL", "age", "NumLate3059", "NumLate6089", "NumLate90", "DebtRatio", "NumOCLL",
                   "NumRELL", "NumDependents"]


def clean(df: DataFrame) -> DataFrame:
    """Short names, dependents filled by the median, extremes winsorised, coded rows dropped."""
    named = df.withColumnsRenamed(SHORT_NAMES)
    bounded = C.winsorize(C.fill_median(named, ["NumDependents"]), EXTREMES)
    return drop_listed(bounded, "NumLate3059", BAD_CODES)


def with_income(train: DataFrame, test: DataFrame, trees: int, depth: int, seed: int):
    """Both tables with ``MonthlyIncome_Imputed``: scaled, predicted, brought back to scale."""
    known = train.where(F.col("MonthlyIncome").isNotNull())
    scales = C.MinMaxModel.fit(known, [*INCOME_FEATURES, "MonthlyIncome"])

    def scaled(df: DataFrame) -> DataFrame:
        names = scales.bounds
        copies = df.withColumns({f"_raw_{c}": F.col(c) for c in names})
        return scales.transform(copies)

    model = C.fit_column_regressor(scaled(train), "MonthlyIncome", INCOME_FEATURES, trees, depth, seed)

    def filled(df: DataFrame) -> DataFrame:
        predicted = model.transform(scaled(df))
        income = F.coalesce(F.col("_raw_MonthlyIncome").cast("bigint"),
                            scales.inverse(F.col("_predicted"), "MonthlyIncome")).cast("double")
        return predicted.withColumn("MonthlyIncome_Imputed", income).select(
            *[F.col(f"_raw_{c}").alias(c) if c in scales.bounds else F.col(c) for c in df.columns],
            "MonthlyIncome_Imputed")

    return filled(train), filled(test)


def features(train: DataFrame, test: DataFrame, key: str, trees: int, depth: int, seed: int):
    # every step below learns something from the rows, so each reads a stored copy
    train, test = cut_lineage(clean(cut_lineage(train))), cut_lineage(clean(cut_lineage(test)))
    train, test = (cut_lineage(df) for df in with_income(train, test, trees, depth, seed))
    train, test = B.split_into_buckets(train, test, "age", 10, drop_original=False)
    train, test = B.split_into_buckets(train, test, "MonthlyIncome_Imputed", 10, drop_original=False,
                                       jitter_key=key, seed=seed)
    train, test = B.split_into_buckets(train, test, "NumOCLL", 8)
    train, test = B.split_into_buckets(train, test, "NumRELL", 4, jitter_key=key, seed=seed)
    tiers = B.UtilisationModel.fit(train, "RUoUL")
    return cut_lineage(tiers.transform(train)), cut_lineage(tiers.transform(test))


def default_scores(train: DataFrame, test: DataFrame, key: str, template: DataFrame | None = None,
                   income_trees: int = 50, trees: int = 50, depth: int = 8, folds: int = 5,
                   seed: int = 0) -> tuple[DataFrame, Sequence[tuple[str, float]]]:
    """(key, Probability) for every expected key, and the AUC of every model."""
    train, test = features(train, test, key, income_trees, min(depth, 8), seed)
    columns = columns_difference(train, [key, "age", "MonthlyIncome", "MonthlyIncome_Imputed", TARGET])
    scales = C.MinMaxModel.fit(train, columns)
    labelled = train.withColumn("label", F.col(TARGET).cast("double"))
    rows = M.assemble(scales.transform(labelled), columns, [key, "label"])
    split = stratified_split(rows, key, "label", 0.3, seed)
    folded = stratified_folds(split.where(~F.col("is_test")).drop("is_test"), key, "label", folds, seed)
    valid = split.where("is_test")
    results = []
    for name, estimator in {"lr": M.logistic(reg=0.001, iterations=20),
                            "rf": M.random_forest(trees, depth, seed, featureSubsetStrategy="5")}.items():
        model, _, _ = U.train_best_fold(folded, estimator, key, "label", "fold", folds)
        area = AreaEvaluator("label", "score").evaluate(
            model.transform(valid).select("label", M.positive_probability().alias("score")))
        results.append((name, area, model))
    name, _, best = max(results, key=lambda r: r[1])
    scored = best.transform(M.assemble(scales.transform(test), columns, [key])).select(
        key, M.positive_probability().alias("Probability"))
    if template is not None:
        scored = complete_keys(scored, template, key)
    return scored, [(n, a) for n, a, _ in results]
