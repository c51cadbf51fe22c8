"""Queries of fitted models against plain numpy versions or separate fits on the same rows."""

import math

import numpy as np
import pytest
from conftest import SMALL
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from test_boosting import apply, plain_tree

from millrace.functions.hashing import hash_fraction
from millrace.operators import boosting as B
from millrace.operators.sampling import stratified_folds
from millrace.suite import learning as Q, registry
from millrace.suite.registry import Tables

registry.load()
SEED = Q.SEED


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SMALL)


def run(spark, name):
    return registry.QUERIES[name](spark, SMALL)


class Plain:
    """Boosting row by row of the query's table, with numpy."""

    def __init__(self, df, features, label, settings, held=None, fold=None):
        self.settings, self.features = settings, features
        held = F.lit(False) if held is None else held
        fold = F.lit(-1) if fold is None else F.col(fold)
        rows = df.select("o_orderkey", F.col(label).alias("_label"), *features, F.xxhash64(F.col("o_orderkey").cast("string")).alias("_draw"),
                         F.coalesce(held, F.lit(False)).alias("_held"), fold.alias("_fold")).toPandas()
        self.keys = rows["o_orderkey"].to_numpy()
        self.y = rows["_label"].to_numpy(float)
        self.held, self.fold = rows["_held"].to_numpy(bool), rows["_fold"].to_numpy()
        self.draw = rows["_draw"].to_numpy(np.int64).view(np.uint64)
        self.bins = B.binned(rows[features].to_numpy(float, na_value=np.nan), B.find_edges(df, features, settings.bins))

    def grow(self, out, score, patience, larger, rounds):
        """Margins after every round and the held-out scores, training without the rows ``out``."""
        s = self.settings
        mean = self.y[~out].mean()
        margin = np.full(len(self.y), math.log(mean / (1 - mean)) if s.objective == "logistic" else mean)
        margins, scores = [], []
        for number in range(rounds):
            g, h = B.gradients(s.objective, self.y, margin)
            used = np.flatnonzero(~out & (B.row_draws(self.draw, s.seed, number) < s.row_share))
            tree = plain_tree(self.bins, g, h, s, B.drawn_features(len(self.features), s.feature_share, s.seed, number), used)
            margin = margin + np.array([apply(tree, b) for b in self.bins])
            margins.append(margin)
            scores.append(score(self.y[out], margin[out]))
            best = (np.argmax if larger else np.argmin)(scores)
            if patience is not None and len(scores) - 1 - best >= patience:
                break
        return margins, scores


def area(y, margin):
    p, n = margin[y == 1], margin[y == 0]
    return ((p[:, None] > n[None, :]).sum() + 0.5 * (p[:, None] == n[None, :]).sum()) / (len(p) * len(n))


def relative(y, p):
    return math.sqrt(np.mean((np.expm1(p) / np.expm1(y) - 1) ** 2))


def loss(y, margin):
    return float(np.mean(np.logaddexp(0, margin) - y * margin))


def test_gbt_binary(spark, tables):
    s = B.Settings(rounds=10, depth=4, step=0.1, row_share=0.7, feature_share=0.7, seed=SEED)
    plain = Plain(Q.with_gaps(tables), Q.FEATURES, "label", s, hash_fraction("o_orderkey", SEED) < 0.2)
    margins, scores = plain.grow(plain.held, area, 5, True, 10)
    want = 1 / (1 + np.exp(-margins[int(np.argmax(scores))]))
    got = {r.o_orderkey: r.p for r in run(spark, "fit_gbt_binary").collect()}
    assert np.allclose([got[k] for k in plain.keys], want, atol=1e-6) and len(got) == len(want)


def test_gbt_regression(spark, tables):
    s = B.Settings(rounds=10, depth=4, step=0.3, row_share=0.7, feature_share=0.7, objective="squared", seed=SEED)
    rows = Q.with_gaps(tables).withColumn("log_price", F.log1p("price"))
    plain = Plain(rows, [f for f in Q.FEATURES if f != "price"], "log_price", s, hash_fraction("o_orderkey", SEED) < 0.2)
    margins, scores = plain.grow(plain.held, relative, 5, False, 10)
    want = np.expm1(margins[int(np.argmin(scores))])
    got = {r.o_orderkey: r.predicted for r in run(spark, "fit_gbt_regression").collect()}
    assert np.allclose([got[k] for k in plain.keys], want, rtol=1e-5)


def test_boosting_rounds_by_folds(spark, tables):
    s = B.Settings(rounds=5, depth=3, step=0.3, row_share=0.7, seed=SEED)
    rows = stratified_folds(Q.with_gaps(tables), "o_orderkey", "label", 2, SEED)
    plain = Plain(rows, Q.FEATURES, "label", s, fold="fold")
    curves = np.array([plain.grow(plain.fold == k, loss, None, False, 5)[1] for k in (0, 1)]).mean(axis=0)
    got = run(spark, "cv_boosting_rounds").orderBy("round").collect()
    assert np.allclose([r.log_loss for r in got], curves[: len(got)], atol=1e-6)
    assert [r.round for r in got if r.is_best] == [int(np.argmin(curves[: len(got)])) + 1]


def test_custom_metric(spark, tables):
    s = B.Settings(rounds=6, depth=3, step=0.3, objective="squared", seed=SEED)
    rows = Q.order_features(tables).withColumn("log_price", F.log1p("price"))
    plain = Plain(rows, [f for f in Q.FEATURES if f != "price"], "log_price", s, hash_fraction("o_orderkey", SEED) >= 0.6)
    scores = plain.grow(plain.held, relative, None, False, 6)[1]
    got = run(spark, "udaf_custom_metric").orderBy("round").collect()
    assert len(got) > 3 and np.allclose([r.rmspe for r in got], scores[: len(got)], rtol=1e-5)


@pytest.fixture(scope="module")
def matrices(tables):
    out = {}
    for label in ("label", "priority"):
        rows = Q.order_features(tables).withColumn("label", F.col(label))
        out[label] = VectorAssembler(inputCols=Q.FEATURES, outputCol="features").transform(rows).select("o_orderkey", "label", "features").cache()
    return out


def halves(rows):
    chosen = hash_fraction("o_orderkey", SEED) < 0.6
    return rows.where(chosen), rows.where(~chosen)


def test_logistic_cv_equals_separate_fits(spark, matrices):
    rows = stratified_folds(matrices["label"], "o_orderkey", "label", 3, SEED)
    losses = {}
    for penalty in (0.1, 0.01, 0.001):
        fit = lambda r, p=penalty: LogisticRegression(regParam=p, maxIter=300, tol=1e-12).fit(r)
        losses[penalty] = np.mean([MulticlassClassificationEvaluator(metricName="logLoss").evaluate(
            fit(rows.where(F.col("fold") != k)).transform(rows.where(F.col("fold") == k))) for k in range(3)])
    best = min(losses, key=losses.get)
    want = {r.o_orderkey: r.probability[1] for r in LogisticRegression(regParam=best, maxIter=300, tol=1e-12).fit(rows).transform(rows).collect()}
    got = {r.o_orderkey: r.p for r in run(spark, "fit_logistic_regression_cv").collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in got) < 1e-5


def test_multinomial_logistic_equals_numpy(spark, matrices):
    """The loss that the query reaches is that of the penalised optimum, found here by plain descent."""
    train, valid = halves(matrices["priority"])
    data = train.collect()
    x, y = np.array([r.features.toArray() for r in data]), np.array([int(r.label) for r in data])
    mean, spread = x.mean(axis=0), x.std(axis=0, ddof=1)
    z, target = (x - mean) / spread, np.eye(5)[y]
    w, b = np.zeros((x.shape[1], 5)), np.log(target.mean(axis=0))
    for _ in range(6000):
        e = np.exp(z @ w + b)
        p = e / e.sum(axis=1, keepdims=True)
        w -= 0.5 * (z.T @ (p - target) / len(z) + 0.01 * w)
        b -= 0.5 * (p - target).mean(axis=0)
    out = valid.collect()
    e = np.exp((np.array([r.features.toArray() for r in out]) - mean) / spread @ w + b)
    want = dict(zip((r.o_orderkey for r in out), e / e.sum(axis=1, keepdims=True)))
    got = run(spark, "fit_logistic_regression").collect()
    assert len(got) == len(want) and max(abs(r[f"p{k}"] - want[r.o_orderkey][k]) for r in got for k in range(5)) < 0.01


def scores_of(rows, estimator, metric, folds):
    evaluate = MulticlassClassificationEvaluator(metricName=metric).evaluate
    return [evaluate(estimator.fit(rows.where(F.col("fold") != k)).transform(rows.where(F.col("fold") == k))) for k in range(folds)]


def test_searches_equal_separate_fits(spark, matrices):
    rows = stratified_folds(matrices["label"], "o_orderkey", "label", 2, SEED).cache()
    for name, metric in (("grid_search", "f1"), ("random_search", "logLoss")):
        table = run(spark, name).collect()
        assert len(table) == (4 if name == "grid_search" else 3) and len({r.params for r in table}) == len(table)
        for r in table[:2]:
            chosen = dict(p.split("=") for p in r.params.split(", "))
            tree = DecisionTreeClassifier(seed=SEED, **{k: v if k == "impurity" else int(v) for k, v in chosen.items()})
            if "maxDepth" not in chosen:
                tree.setMaxDepth(5)
            found = scores_of(rows, tree, metric, 2)
            assert math.isclose(r["mean"], np.mean(found), abs_tol=1e-9) and math.isclose(r["std"], np.std(found), abs_tol=1e-9), r


def test_fold_scores_equal_separate_fits(spark, matrices):
    rows = stratified_folds(matrices["label"], "o_orderkey", "label", 3, SEED).cache()
    want = scores_of(rows, LogisticRegression(maxIter=10), "accuracy", 3)
    got = {r.fold: r.score for r in run(spark, "cross_val_score").collect()}
    assert np.allclose([got[k] for k in range(3)], want, atol=5e-3)
    areas = []
    for k in range(3):
        held = LogisticRegression(maxIter=10).fit(rows.where(F.col("fold") != k)).transform(rows.where(F.col("fold") == k)).collect()
        areas.append(area(np.array([r.label for r in held]), np.array([r.probability[1] for r in held])))
    best = run(spark, "train_best_fold").orderBy("fold").collect()
    assert np.allclose([r.auc for r in best], areas, atol=5e-3) and sum(r.is_best for r in best) == 1
    assert max(best, key=lambda r: r.auc).is_best


def test_forests_equal_separate_fits(spark, matrices):
    """The queries' parameters reach the learner: single trees and forests fitted without the library's helpers."""
    train, valid = halves(matrices["priority"])
    tree = DecisionTreeClassifier(maxDepth=6, seed=SEED, impurity="entropy").fit(train)
    want = {r.o_orderkey: r.prediction for r in tree.transform(valid).collect()}
    got = {r.o_orderkey: r.prediction for r in run(spark, "fit_decision_tree").collect()}
    assert got.keys() == want.keys() and np.mean([got[k] == want[k] for k in got]) > 0.99
    chance = {r.o_orderkey: r.probability for r in RandomForestClassifier(numTrees=5, maxDepth=4, seed=SEED).fit(train).transform(valid).collect()}
    found = run(spark, "predict_proba").collect()
    assert len(found) == len(chance)
    apart = [abs(r[name] - chance[r.o_orderkey][k]) for r in found for k, name in enumerate(Q.PRIORITIES)]
    assert np.mean(apart) < 0.05 and all(abs(sum(r[n] for n in Q.PRIORITIES) - 1) < 1e-9 for r in found)
    binary_train, binary_valid = halves(matrices["label"])
    forest = RandomForestClassifier(numTrees=20, maxDepth=5, seed=SEED, bootstrap=True, minInstancesPerNode=3).fit(binary_train)
    want = {r.o_orderkey: r.probability[1] for r in forest.transform(binary_valid).collect()}
    got = {r.o_orderkey: r.p for r in run(spark, "fit_random_forest_classifier").collect()}
    assert got.keys() == want.keys() and np.mean([abs(got[k] - want[k]) for k in got]) < 0.05
    shares = {r.feature: r.importance for r in run(spark, "feature_importance").collect()}
    assert set(shares) == set(Q.FEATURES) and math.isclose(sum(shares.values()), 1, abs_tol=1e-9)
    direct = RandomForestClassifier(numTrees=10, maxDepth=5, seed=SEED).fit(matrices["label"]).featureImportances.toArray()
    assert np.allclose([shares[f] for f in Q.FEATURES], direct, atol=0.1)


def test_imputed_values(spark, tables):
    got = run(spark, "impute_by_regression").collect()
    known = [r for r in got if r.o_totalprice is not None]
    filled = [r for r in got if r.o_totalprice is None]
    assert filled and all(r.o_totalprice_Imputed == r.o_totalprice for r in known)
    truth = {r.o_orderkey: r.o_totalprice for r in tables.orders.collect()}
    mean = np.mean([r.o_totalprice for r in known])
    low, high = min(r.o_totalprice for r in known), max(r.o_totalprice for r in known)
    assert all(low <= r.o_totalprice_Imputed <= high for r in filled)  # a forest's values are means of known ones
    error = np.mean([(r.o_totalprice_Imputed - truth[r.o_orderkey]) ** 2 for r in filled])
    assert error < 1.15 * np.mean([(mean - truth[r.o_orderkey]) ** 2 for r in filled])


def test_stack_equals_separate_fits(spark, matrices):
    train, test = halves(matrices["label"])
    folded = stratified_folds(train, "o_orderkey", "label", 2, SEED).cache()
    tree, line = DecisionTreeClassifier(maxDepth=4, seed=SEED), LogisticRegression(maxIter=5)
    p = lambda model, rows: {r.o_orderkey: r.p for r in model.transform(rows).select("o_orderkey", vector_to_array("probability")[1].alias("p")).collect()}
    models = [[e.fit(folded.where(F.col("fold") != k)) for k in range(2)] for e in (line, tree)]
    labels = {r.o_orderkey: r.label for r in folded.collect()}
    out = [{k: v for f in range(2) for k, v in p(m[f], folded.where(F.col("fold") == f)).items()} for m in models]
    level_one = spark.createDataFrame([(labels[k], float(1 - out[0][k]), float(out[0][k]), float(1 - out[1][k]), float(out[1][k])) for k in labels], "label double, a double, b double, c double, d double")
    blender = LogisticRegression(maxIter=10).fit(VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(level_one))
    means = [{k: np.mean([q[k] for q in both]) for k in both[0]} for both in ([p(m[f], test) for f in range(2)] for m in models)]
    w, c = blender.coefficients.toArray(), blender.intercept
    want = {k: 1 / (1 + math.exp(-(w @ [1 - means[0][k], means[0][k], 1 - means[1][k], means[1][k]] + c))) for k in means[0]}
    truth = {r.o_orderkey: r.label for r in test.collect()}
    blend_loss = -np.mean([math.log(want[k] if truth[k] else 1 - want[k]) for k in want])
    single = p(line.fit(train), test)
    single_loss = -np.mean([math.log(single[k] if truth[k] else 1 - single[k]) for k in single])
    got = run(spark, "choose_single_or_blend").collect()
    method = "single" if single_loss < blend_loss else "blend"
    chosen = single if method == "single" else want
    assert {r.method for r in got} == {method} or abs(single_loss - blend_loss) < 1e-3
    if {r.method for r in got} == {method}:
        assert np.mean([abs(r.p - chosen[r.o_orderkey]) for r in got]) < 0.01
        assert abs(got[0].log_loss - min(single_loss, blend_loss)) < 5e-3


def test_runs_are_means(spark):
    """Bagged runs lie between the single runs; features of the refit are among the given ones."""
    got = run(spark, "bagged_seed_runs").collect()
    assert all(0 < r.p < 1 for r in got) and len({r.o_orderkey for r in got}) == len(got)
    again = run(spark, "refit_top_features").collect()
    names = set(again[0].features.split(","))
    assert 3 <= len(names) <= 6 and names <= set(Q.FEATURES) and all(r.features == again[0].features for r in again)
    assert -np.mean([math.log(r.p if r.label else 1 - r.p) for r in again]) < math.log(2)
