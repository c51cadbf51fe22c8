"""Marketing response: constant columns out, codes, boosting stopped by the AUC of held-out rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators import boosting as B, encoding as E, models as M, selection as X
from millrace.operators.relational import columns_of
from millrace.operators.sampling import sample_exact
from millrace.session import cut_lineage, discard, scratch_table


def coded(train: DataFrame, test: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Columns that vary, text as codes over train and test together, gaps as -1."""
    # every step below learns something from the rows, so each reads a stored copy
    stored = scratch_table(train), scratch_table(test)
    constant = X.constant_columns(stored[0])
    train, test = (df.drop(*constant) for df in stored)
    for c in columns_of(train, "string"):
        both = train.select(c, F.col(key).alias("_order"), F.lit(0).alias("_source")).unionByName(
            test.select(c, F.col(key).alias("_order"), F.lit(1).alias("_source")))
        # train values first, then those only test has, each in key order
        ordered = both.select(c, (F.col("_source") * F.lit(1 << 62) + F.col("_order")).alias("_order"))
        levels = E.first_seen_levels(ordered, c, "_order", start=1)
        train, test = (E.encode(df, levels, c, f"_{c}").drop(c).withColumnRenamed(f"_{c}", c)
                       for df in (train, test))
    train, test = cut_lineage(train.na.fill(-1)), cut_lineage(test.na.fill(-1))
    for df in stored:
        discard(df)
    return train, test


def response_scores(train: DataFrame, test: DataFrame, key: str, target: str, validation_rows: int,
                    rounds: int = 100, depth: int = 8, step: float = 0.1, patience: int = 20,
                    seed: int = 0) -> tuple[DataFrame, list[float], int]:
    """(key, p), the held-out AUC after every round, and the round used."""
    train, test = coded(train, test, key)
    features = sorted(c for c in train.columns if c not in (key, target))
    held = sample_exact(train.select(key), key, validation_rows, f"{seed}-validation").withColumn("_held", F.lit(True))
    settings = B.Settings(rounds, depth, step, row_share=0.7, feature_share=0.7, seed=seed)
    model = B.boost(train.join(held, key, "left"), features, target, key, settings, F.col("_held"), B.area_metric, patience, larger=True)
    return model.transform(test).select(key, M.positive_probability().alias("p")), model.history.means, model.history.best
