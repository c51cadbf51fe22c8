"""Insurance claims: a forest on one-hot columns, extra trees on unscaled columns, averaged boosting."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.operators import boosting as G, cleaning as C, encoding as E, ensembling as B, models as M, selection as X
from millrace.operators import windows as W
from millrace.operators.metrics import log_loss
from millrace.operators.relational import columns_of, stack_sources
from millrace.operators.sampling import sample_exact, split_by_fraction, stratified_folds
from millrace.session import cut_lineage, discard, scratch_table

MARK = "is_train"


def _apart(both: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    return both.where(MARK).drop(MARK), both.where(~F.col(MARK)).drop(MARK, target)


def _features(df: DataFrame, key: str, target: str) -> list[str]:
    return sorted(c for c in df.columns if c not in (key, target))


def encoded(train: DataFrame, test: DataFrame, key: str, target: str, max_values: int):
    """Gaps filled by mean or mode, text columns with few values one-hot, the others dropped."""
    both = scratch_table(stack_sources(train, test, MARK))  # read once per learned step
    inputs = [c for c in both.columns if c not in (key, target, MARK)]
    filled = C.MixedImputer(inputCols=inputs).fit(both).transform(both)
    onehot, dropped = E.onehot_low_cardinality(filled.drop(key, target, MARK), max_values)
    out = cut_lineage(onehot.transform(filled).drop(*dropped))
    discard(both)
    return _apart(out, target)


def forest_scores(train: DataFrame, test: DataFrame, key: str, target: str, max_values: int = 25,
                  trees: int = 100, depth: int = 10, seed: int = 0) -> tuple[DataFrame, float]:
    """(key, p) of the test rows and the log loss on 40 percent held out."""
    train, test = encoded(train, test, key, target, max_values)
    features = _features(train, key, target)
    rows = M.assemble(train.withColumn("label", F.col(target).cast("double")), features, [key, "label"])
    fit_rows, held = split_by_fraction(rows, key, 0.6, f"{seed}-hold-out")
    with M.kept(fit_rows) as kept:
        model = M.random_forest(trees, depth, seed).fit(kept)
    p = M.positive_probability()
    loss = model.transform(held).agg(log_loss(F.col("label"), p)).first()[0]
    return model.transform(M.assemble(test, features, [key])).select(key, p.alias("p")), float(loss)


def unscaled(train: DataFrame, test: DataFrame, key: str, target: str, order: str,
             drop: Sequence[str] = (), missing: float = -999.0) -> tuple[DataFrame, DataFrame]:
    """Numeric columns divided by their common step, text as first-seen codes, gaps filled."""
    unused = [c for c in drop if c != order]
    stored = scratch_table(stack_sources(train.drop(*unused), test.drop(*unused), MARK))
    both = stored.drop(*drop)
    numeric = [c for c in columns_of(both, "numeric") if c not in (key, target, order)]
    steps = {r["column"]: r["step"] for r in W.scale_steps(both, numeric).collect()}
    rows = W.undo_scaling(both, steps).na.fill(missing, numeric)
    for c in columns_of(both, "string"):
        levels = E.first_seen_levels(stored.where(MARK), c, order)
        rows = E.encode(rows, levels, c, f"_{c}", unseen=-1).drop(c).withColumnRenamed(f"_{c}", c)
    out = cut_lineage(rows)
    discard(stored)
    return _apart(out, target)


def extra_trees_scores(train: DataFrame, test: DataFrame, key: str, target: str, trees: int = 50,
                       depth: int = 12, seed: int = 0) -> tuple[DataFrame, float]:
    train, test = unscaled(train, test, key, target, order=key)
    features = _features(train, key, target)
    labelled = train.withColumn("label", F.col(target).cast("double"))
    fit_rows, held = split_by_fraction(labelled, key, 0.6, f"{seed}-hold-out")
    model = M.extra_trees(features, trees, depth, seed, impurity="entropy").fit(fit_rows)
    p = M.positive_probability()
    loss = model.transform(held).agg(log_loss(F.col("label"), p)).first()[0]
    return model.transform(test).select(key, p.alias("p")), float(loss)


def filtered(train: DataFrame, test: DataFrame, key: str, target: str, cutoff: float):
    """Gaps as -1, text as codes of train and test together, then the two column filters."""
    stored = scratch_table(stack_sources(train, test, MARK))
    texts = columns_of(stored, "string")
    both = coded = stored.na.fill(-1).na.fill("-1", texts)
    for c in texts:
        levels = E.first_seen_levels(both, c, key)
        coded = E.encode(coded, levels, c, f"_{c}").drop(c).withColumnRenamed(f"_{c}", c)
    both = cut_lineage(coded)
    discard(stored)
    features = _features(both.drop(MARK), key, target)
    flat = [r["column"] for r in X.near_zero_variance(both, features).where("nzv").collect()]
    features = [c for c in features if c not in flat]
    train, test = _apart(both.drop(*flat), target)
    drops = X.common_highly_correlated(train, test, features, cutoff)
    return train.drop(*drops), test.drop(*drops)


def boosted_scores(train: DataFrame, test: DataFrame, key: str, target: str, cutoff: float = 0.95,
                   rounds: int = 50, folds: int = 3, runs: int = 5, depth: int = 5, step: float = 0.1,
                   validation_rows: int = 1000, patience: int = 20, seed: int = 0, increment: int = 10) -> tuple[DataFrame, int]:
    """(key, p) as the mean over seeded runs, and the number of rounds found by cross validation.

    The folds grow together and stop after ``patience`` rounds without gain.
    """
    train, test = filtered(train, test, key, target, cutoff)
    features = _features(train, key, target)
    held = sample_exact(train.select(key), key, validation_rows, f"{seed}-validation")
    fit_rows = cut_lineage(train.join(held, key, "left_anti").withColumn("label", F.col(target).cast("double")))
    settings = G.Settings(rounds, depth, step, row_share=0.7, seed=seed)
    folded = stratified_folds(fit_rows, key, "label", folds, seed)
    _, history = G.boost_folds(folded, features, "label", key, "fold", folds, settings, G.column_metric(log_loss), patience)

    def run(number: int) -> DataFrame:
        model = G.boost(fit_rows, features, "label", key, G.replace(settings, rounds=history.best, seed=seed + number * increment))
        return model.transform(test).select(key, M.positive_probability().alias("p"), F.lit(number).alias("run"))

    parts = M.in_parallel(run, range(runs))
    return B.average_runs(functools.reduce(DataFrame.unionByName, parts), key, "p", "run"), history.best
