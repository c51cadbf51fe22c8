"""Samples, metrics, estimators and ensembles on small data with a known answer."""

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from millrace.operators import ensembling as N, metrics as M, models as L, neighbours, sampling as S, tuning as U


@pytest.fixture(scope="module")
def labelled(spark):
    """Two informative columns, one noise column, three classes."""
    draw = np.random.default_rng(11)
    rows = []
    for i in range(600):
        k = i % 3
        a, b = draw.normal(loc=[3.0 * (k == 1), 3.0 * (k == 2)])
        rows.append((i, float(a), float(b), float(draw.normal()), float(k), float(k == 1)))
    df = spark.createDataFrame(rows, "id bigint, a double, b double, noise double, class double, binary double")
    return df.repartition(4).cache()


def matrix(df, label):
    return L.assemble(df.withColumn("label", F.col(label)), ["a", "b", "noise"], ["id", "label"])


def accuracy(df):
    return df.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]


def test_splits_are_stable_and_complete(spark):
    df = spark.range(2000)
    one, rest = S.split_by_fraction(df, "id", 0.6, 1)
    again, _ = S.split_by_fraction(df.repartition(13), "id", 0.6, 1)
    assert one.count() + rest.count() == 2000 and one.join(rest, "id").count() == 0
    assert {r[0] for r in one.collect()} == {r[0] for r in again.collect()}


@pytest.mark.parametrize("n", [0, 1, 777, 2000, 5000])
def test_exact_sample(spark, n):
    sample = S.sample_exact(spark.range(2000), "id", n, 3)
    assert sample.count() == sample.distinct().count() == min(n, 2000)


def test_sample_with_shared_draws(spark, monkeypatch):
    """Rows with the same 32-bit draw are told apart by the whole hash."""
    monkeypatch.setattr(S, "hash_number", lambda key, seed: F.col("id") % 3)
    assert S.sample_exact(spark.range(30), "id", 13, 3).count() == 13


def test_strata(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    sizes = {(r["y"], r["is_test"]): r["count"] for r in
             S.stratified_split(df, "id", "y", 0.3, 5).groupBy("y", "is_test").count().collect()}
    assert sizes == {(1, True): 30, (1, False): 70, (0, True): 270, (0, False): 630}
    folds = S.stratified_folds(df, "id", "y", 7, 5).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        counts = [r["count"] for r in folds if r["y"] == y]
        assert len(counts) == 7 and max(counts) - min(counts) <= 1
    assert S.class_sizes(S.undersample(df, "id", "y", 5), "y") == {0: 100, 1: 100}
    assert S.sample_percent(df, "id", 5, 1).count() == 50


@pytest.fixture(scope="module")
def scores(spark):
    draw = np.random.default_rng(2)
    rows = [(i, int(draw.random() < 0.4), round(float(draw.random()), 2), i % 3) for i in range(400)]
    return spark.createDataFrame(rows, "id bigint, y int, score double, fold int").cache()


def test_auc_with_ties(scores):
    want = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="score", numBins=0).evaluate(
        scores.withColumn("y", F.col("y").cast("double")))
    assert math.isclose(M.roc_auc(scores, "y", "score").first()["auc"], want, rel_tol=1e-12)
    curve = M.roc_curve(scores, "y", "score").orderBy("threshold").collect()
    assert (curve[0]["fpr"], curve[0]["tpr"]) == (1.0, 1.0)


def test_mean_roc_against_interpolation(scores):
    rows = scores.collect()
    grid, total = np.linspace(0, 1, 100), np.zeros(100)
    for fold in range(3):
        mine = [(r["score"], r["y"]) for r in rows if r["fold"] == fold]
        cuts = sorted({s for s, _ in mine}, reverse=True)
        p, n = sum(y for _, y in mine), sum(1 - y for _, y in mine)
        fpr = [0.0] + [sum(1 - y for s, y in mine if s >= c) / n for c in cuts]
        tpr = [0.0] + [sum(y for s, y in mine if s >= c) / p for c in cuts]
        part = np.interp(grid, fpr, tpr)
        part[0] = 0.0
        total += part
    total /= 3
    total[-1] = 1.0
    got = M.mean_roc(scores, "fold", "y", "score").orderBy("g")
    assert np.allclose([r["tpr"] for r in got.collect()], total, atol=1e-9)
    area = M.curve_area(got).first()["auc"]
    assert math.isclose(area, float(np.trapezoid(total, grid)), rel_tol=1e-9)


def test_losses(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.0), (1, 0.0), (0, 0.5)], "y int, p double")
    eps = 1e-15
    want = -(2 * math.log(1 - eps) + math.log(eps) + math.log(0.5)) / 4
    assert math.isclose(df.agg(M.log_loss(F.col("y"), F.col("p"))).first()[0], want, rel_tol=1e-9)
    table = M.classification_scores(df.withColumn("g", (F.col("p") >= 0.5).cast("int")), "y", "g").first()
    assert (table["accuracy"], table["precision"], table["recall"], table["f1"]) == (0.5, 0.5, 0.5, 0.5)
    assert M.median_absolute_error(df, "y", "p") == 0.25


def test_classifiers_learn(labelled):
    train, valid = S.split_by_fraction(matrix(labelled, "class"), "id", 0.7, 1)
    assert accuracy(L.random_forest(10, 5, 1).fit(train).transform(valid)) > 0.8
    assert accuracy(L.PairwiseSVM(3, iterations=10).fit(train).transform(valid)) > 0.8
    fit_part, calibration = S.split_by_fraction(train, "id", 0.7, 2)
    svm = L.CalibratedSVM(3, iterations=10).fit(fit_part, calibration).transform(valid)
    assert accuracy(svm) > 0.8
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 for r in svm.collect())
    assert accuracy(L.mlp(3, 3, 60, 1).fit(train).transform(valid)) > 0.7


def test_extra_trees(labelled):
    train, valid = S.split_by_fraction(labelled.withColumn("label", F.col("class")), "id", 0.7, 1)
    scored = L.ExtraTrees(6, 5, 3).fit(train, ["a", "b", "noise"]).transform(valid)
    assert accuracy(scored) > 0.75
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 for r in scored.collect())


def test_deep_trees_are_cut():
    with pytest.warns(UserWarning, match="cut to 30"):
        assert L.depth_of(117) == 30


@pytest.mark.parametrize("block", [5_000, 7])
@pytest.mark.parametrize("weights", ["uniform", "distance"])
def test_knn_against_numpy(spark, labelled, monkeypatch, block, weights):
    monkeypatch.setattr(neighbours, "QUERIES", block)
    monkeypatch.setattr(neighbours, "PART", 3 * block)
    rows = labelled.select("id", F.array("a", "b").alias("v"), F.col("class").cast("int").alias("c"))
    train, queries = S.split_by_fraction(rows, "id", 0.8, 4)
    got = {r["query"]: r["prediction"] for r in
           L.knn_classify(train, queries, "id", "v", "c", 5, 2, weights).collect()}
    t, q = train.orderBy("id").collect(), queries.collect()
    points, labels = np.array([r["v"] for r in t]), np.array([r["c"] for r in t])
    assert len(got) == len(q)
    for r in q:
        far = np.sqrt(((points - np.array(r["v"])) ** 2).sum(axis=1))
        near = np.argsort(far, kind="stable")[:5]
        votes = np.zeros(3)
        for i in near:
            votes[labels[i]] += 1.0 if weights == "uniform" else 1.0 / far[i]
        assert got[r["id"]] == int(np.argmax(votes.round(9)))


def test_group_ols(spark):
    rows = []
    for i in range(30):
        rows.append((1, float(i), float(i % 7), 5.0, 2.0 + 3.0 * i - 1.5 * (i % 7)))   # full rank
        rows.append((2, float(i), 2.0 * i, 5.0, 1.0 + 4.0 * i))                        # second column repeats the first
    rows.append((3, 1.0, 1.0, 5.0, 9.0))                                               # one row
    df = spark.createDataFrame(rows, "g int, x1 double, x2 double, fixed double, y double")
    fitted = {r["g"]: r for r in L.fit_group_ols(df, "g", ["x1", "x2", "fixed"], F.col("y")).collect()}
    assert np.allclose(fitted[1]["coefficients"], [3.0, -1.5, 0.0]) and math.isclose(fitted[1]["intercept"], 2.0)
    assert np.allclose(fitted[2]["coefficients"], [4.0, 0.0, 0.0])
    assert fitted[3]["coefficients"] == [0.0, 0.0, 0.0] and math.isclose(fitted[3]["intercept"], 9.0)
    models = L.fit_group_ols(df, "g", ["x1", "x2", "fixed"], F.col("y"))
    error = L.predict_group_ols(df, models, "g", ["x1", "x2", "fixed"]).agg(
        F.max(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert error < 1e-9


def test_search_prefers_the_better_candidate(labelled):
    rows = S.stratified_folds(matrix(labelled, "binary"), "id", "label", 3, 1)
    tree = L.decision_tree(3, 1)
    maps = U.grid({tree.maxDepth: [0, 3]})
    found = U.search(rows, tree, maps, BinaryClassificationEvaluator(), "fold", 3)
    assert found.best == 1 and len(found.scores[0]) == 3
    assert len(U.draws({"a": [1, 2, 3], "b": [1, 2]}, 4, 1)) == 4
    assert len(U.draws({"a": [1, 2]}, 9, 1)) == 2


def test_boosting_rounds_and_auc(labelled):
    rows = S.stratified_folds(matrix(labelled, "binary"), "id", "label", 2, 1)
    best, means = U.boosting_rounds(rows, L.gbt_binary(4, 3, 0.3, 1.0, 1), "fold", 2)
    assert len(means) == 4 and means[best - 1] == min(means)
    train, valid = rows.where("fold = 0"), rows.where("fold = 1")
    model = L.gbt_binary(3, 3, 0.3, 1.0, 1).fit(train)
    areas = {r["round"]: r["auc"] for r in L.auc_by_round(model, valid, "id").collect()}
    whole = BinaryClassificationEvaluator(numBins=0).evaluate(model.transform(valid))
    assert set(areas) == {1, 2, 3} and math.isclose(areas[3], whole, abs_tol=1e-9)
    margins = L.rounds_margin(model, valid, 3, ["id"]).join(model.transform(valid), "id").select(
        (1 / (1 + F.exp(-2 * F.col("margin")))).alias("p"), L.positive_probability().alias("q"))
    assert margins.agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0] < 1e-9
    assert L.best_round([0.5, 0.7, 0.6, 0.6, 0.9], 2, True) == 2
    assert L.best_round([0.5, 0.4, 0.3], 2, False) == 3


def test_top_features_are_the_informative_ones(labelled):
    rows = matrix(labelled, "class")
    model = L.random_forest(10, 4, 1).fit(rows)
    assert U.top_feature_union([model], ["a", "b", "noise"], 2) == ["a", "b"]
    assert U.slice_features(rows, ["a", "b", "noise"], ["a", "b"]).first()["features"].size == 2


def test_stack_scores_every_row_once(labelled):
    train, test = S.split_by_fraction(matrix(labelled, "class"), "id", 0.7, 1)
    folded = S.stratified_folds(train, "id", "label", 3, 1)
    stack = N.Stack({"lr": L.logistic(iterations=20), "dt": L.decision_tree(3, 1)}, 3)
    out = stack.fit(folded, "id", "label", "fold")
    assert out.count() == out.select("id").distinct().count() == train.count()
    blended = stack.transform(test, ["id", "label"])
    assert N.multiclass_loss(blended) < math.log(3)
    assert accuracy(blended) > 0.8


def test_averages(spark):
    runs = spark.createDataFrame([(1, "a", 0.2), (1, "b", 0.4), (2, "a", 0.6)], "id int, run string, p double")
    by_rows = {r["id"]: r["p"] for r in N.average_runs(runs, "id", "p", "run").collect()}
    by_files = {r["id"]: r["p"] for r in N.average_runs(runs, "id", "p", "run", "files").collect()}
    assert by_rows == {1: pytest.approx(0.3), 2: 0.6} and by_files == {1: pytest.approx(0.3), 2: 0.3}
    assert N.choose_lower(("a", 0.2, None), ("b", 0.2, None))[0] == "b"
