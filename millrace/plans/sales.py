"""Store sales: date parts, store attributes, open days only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions import scalars as S
from millrace.functions.hashing import hash_fraction
from millrace.operators import boosting as B, encoding as E, models as M
from millrace.operators.metrics import rmspe
from millrace.session import cut_lineage

# Codes of the state holidays.
HOLIDAYS = ["a", "b", "c"]


def store_attributes(store: DataFrame) -> DataFrame:
    """Years since the competition opened, days since the promotion, distance without gaps."""
    distance = store.agg(F.avg("CompetitionDistance").cast("int")).first()[0]
    return store.select(
        "Store", "StoreType", "Assortment", "PromoInterval",
        F.coalesce("CompetitionDistance", F.lit(float(distance or 0))).alias("CompetitionDistance"),
        S.years_since_month("CompetitionOpenSinceYear", "CompetitionOpenSinceMonth")
        .alias("NumYearsSinceCompetitionOpened"),
        S.days_since_year_week("Promo2SinceYear", "Promo2SinceWeek").alias("DaysSincePromo2"))


def sales_features(sales: DataFrame, store: DataFrame, holidays=tuple(HOLIDAYS),
                   open_days_only: bool = True) -> DataFrame:
    """Sales rows with date parts and store attributes; text columns as 1-based codes."""
    rows = sales.where((F.col("Open") == 1) & (F.col("Sales") != 0)) if open_days_only else sales
    dated = rows.select(
        *[c for c in rows.columns if c not in ("Date", "StateHoliday")],
        F.dayofmonth("Date").alias("Day"), F.month("Date").alias("Month"), F.year("Date").alias("Year"),
        S.in_set_flag("StateHoliday", list(holidays)).alias("Is_StateHoliday"))
    attributes = coded = store_attributes(store)
    for c in ("StoreType", "Assortment", "PromoInterval"):
        levels = E.sorted_levels(store, c, start=1)
        coded = E.encode(coded, levels, c, f"_{c}", unseen=0).drop(c).withColumnRenamed(f"_{c}", c)
    # one row per store, joined to train and to test: computed once
    return dated.join(cut_lineage(coded.select(*attributes.columns)), "Store")


def boosted_sales(train: DataFrame, test: DataFrame, key: str, rounds: int = 100, depth: int = 8,
                  step: float = 0.1, validation_share: float = 0.4, patience: int = 20, seed: int = 0) -> tuple[DataFrame, float]:
    """(key, Sales) from boosting on log sales, and the relative error on held-out rows.

    The error is taken after every round and ends the fit after ``patience`` rounds without gain.
    """
    features = [c for c in train.columns if c not in (key, "Sales", "Customers", "Open") and c in test.columns]
    settings = B.Settings(rounds, depth, step, row_share=0.8, objective="squared", seed=seed)
    held_out = hash_fraction(key, f"{seed}-validation") < validation_share
    model = B.boost(train.withColumn("_log", F.log1p("Sales")), features, "_log", key, settings, held_out, B.column_metric(rmspe), patience)
    error = model.history.means[model.history.best - 1]
    scored = model.transform(test).select(key, F.expm1("prediction").alias("Sales"))
    return scored.orderBy(key), error


def per_store_sales(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """(key, Sales) from one linear model of log sales per store."""
    # the prepared rows are read for the means, the sums and the predictions
    train, test = cut_lineage(train), cut_lineage(test)
    features = [c for c in train.columns if c not in (key, "Store", "Sales", "Customers") and c in test.columns]
    models = M.fit_group_ols(train, "Store", features, F.log1p("Sales"))
    scored = M.predict_group_ols(test, models, "Store", features)
    return scored.select(key, F.expm1("prediction").alias("Sales")).orderBy(key)
