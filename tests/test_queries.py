"""Every query with SQL gives the same values; the others give rows."""

import pytest
from conftest import SMALL
from oracle import compare, connect

from millrace.suite import registry

registry.load()
# run by test_fitted_queries.py, which checks their values
ELSEWHERE = {"fit_gbt_binary", "fit_gbt_regression", "cv_boosting_rounds", "udaf_custom_metric", "fit_logistic_regression_cv",
             "fit_logistic_regression", "grid_search", "random_search", "cross_val_score", "train_best_fold", "fit_decision_tree",
             "predict_proba", "fit_random_forest_classifier", "feature_importance", "impute_by_regression", "choose_single_or_blend",
             "bagged_seed_runs", "refit_top_features"}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_as_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SMALL).toPandas()
    want = duck.execute(registry.ORACLES[name]).df()
    assert len(got) > 0
    assert compare(got, want) is None


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES) - ELSEWHERE))
def test_gives_rows(spark, name):
    assert registry.QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
