"""Queries: training, prediction, search."""

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from millrace.functions.hashing import hash_fraction
from millrace.operators import boosting as B
from millrace.operators import metrics as E
from millrace.operators import models as M
from millrace.operators import penalised as P
from millrace.operators import tuning as U
from millrace.operators.calibration import CrossCalibratedSVM
from millrace.operators.extra_trees import ExtraTreesClassifier
from millrace.operators.network import DenseNetwork
from millrace.operators.sampling import stratified_folds
from millrace.suite.projections import SPLIT
from millrace.suite.registry import Tables, query

FEATURES = ["quantity", "lines", "discount", "tax", "price", "month", "late"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEED = 720


def order_features(t: Tables):
    """One row per order: line aggregates, a binary label, a five-class label."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("quantity"), F.count("*").cast("double").alias("lines"),
        F.avg("l_discount").alias("discount"), F.avg("l_tax").alias("tax"),
        F.count_if(F.col("l_returnflag") == "R").cast("double").alias("late"))
    orders = t.orders.select(
        "o_orderkey", F.col("o_totalprice").alias("price"), F.month("o_orderdate").cast("double").alias("month"),
        (F.col("o_orderstatus") == "F").cast("double").alias("label"),
        (F.substring("o_orderpriority", 1, 1).cast("double") - 1).alias("priority"))
    return orders.join(lines, "o_orderkey")


def matrix(t: Tables, label: str = "label"):
    rows = order_features(t).withColumn("label", F.col(label))
    return M.assemble(rows, FEATURES, ["o_orderkey", "label"])


def parts(rows, key="o_orderkey"):
    chosen = hash_fraction(key, SEED) < 0.6
    return rows.where(chosen), rows.where(~chosen)


def binary_scores(model, rows):
    return model.transform(rows).select(
        "o_orderkey", "label", M.positive_probability().alias("p"), "prediction")


@query("fit_random_forest_classifier")
def fit_random_forest_classifier(t: Tables):
    rows = matrix(t)
    train, valid = parts(rows)
    with M.kept(train) as kept:
        model = M.random_forest(20, 5, SEED, bootstrap=True, minInstancesPerNode=3).fit(kept)
    return binary_scores(model, valid)


@query("fit_extra_trees")
def fit_extra_trees(t: Tables):
    train, valid = parts(order_features(t).select("o_orderkey", "label", *FEATURES))
    return binary_scores(M.extra_trees(FEATURES, 8, 5, SEED).fit(train), valid)


@query("fit_logistic_regression")
def fit_logistic_regression(t: Tables):
    train, valid = parts(matrix(t, "priority"))
    with M.kept(train) as kept:
        model = M.logistic(reg=0.01, iterations=20, family="multinomial").fit(kept)
    return M.probability_columns(model.transform(valid).select("o_orderkey", "label", "probability"),
                                 [f"p{i}" for i in range(5)])


@query("fit_logistic_regression_cv")
def fit_logistic_regression_cv(t: Tables):
    """All folds and penalties as columns of one matrix, a pass per step."""
    rows = stratified_folds(matrix(t), "o_orderkey", "label", 3, SEED)
    found = P.logistic_path(rows, [0.1, 0.01, 0.001], "o_orderkey", "fold", 3)
    return binary_scores(found.model, rows)


@query("fit_decision_tree")
def fit_decision_tree(t: Tables):
    train, valid = parts(matrix(t, "priority"))
    with M.kept(train) as kept:
        model = M.decision_tree(6, SEED, impurity="entropy").fit(kept)
    return model.transform(valid).select("o_orderkey", "label", "prediction")


@query("fit_naive_bayes", f"""with f as (select o_orderkey, cast(substr(o_orderpriority, 1, 1) as integer) - 1 as label,
    sum(l_quantity) as quantity, count(*)::double as lines, count(*) filter (where l_returnflag = 'R')::double as late,
    {SPLIT.format(key='o_orderkey')} < 0.6 as is_train from orders join lineitem on o_orderkey = l_orderkey
    group by o_orderkey, o_orderpriority), c as (select label, count(*) as n, sum(quantity) as quantity,
    sum(lines) as lines, sum(late) as late from f where is_train group by label),
    m as (select label, ln(n::double + 1) - ln((select sum(n) from c)::double + 5) as prior,
    ln(quantity + 1) - ln(quantity + lines + late + 3) as a, ln(lines + 1) - ln(quantity + lines + late + 3) as b,
    ln(late + 1) - ln(quantity + lines + late + 3) as d from c),
    s as (select f.o_orderkey, f.label, m.label as class, prior + a * quantity + b * lines + d * late as score
      from f, m where not is_train), x as (select *, max(score) over (partition by o_orderkey) as top from s)
    select o_orderkey, label::double as label, round(max(case when class = 0 then exp(score - top) end)
    / sum(exp(score - top)), 6) as p0 from x group by o_orderkey, label""")
def fit_naive_bayes(t: Tables):
    rows = order_features(t).withColumn("label", F.col("priority"))
    counts = M.assemble(rows, ["quantity", "lines", "late"], ["o_orderkey", "label"])
    train, valid = parts(counts)
    with M.kept(train) as kept:
        model = M.naive_bayes(smoothing=1.0).fit(kept)
    return model.transform(valid).select("o_orderkey", "label",
                                         F.round(vector_to_array("probability")[0], 6).alias("p0"))


@query("fit_linear_svm_calibrated")
def fit_linear_svm_calibrated(t: Tables):
    """One SVM per class and fold, calibrated by isotonic regression on the rows it left out."""
    train, valid = parts(matrix(t, "priority"))
    model = CrossCalibratedSVM(classes=5, folds=2, maxIter=5, keyCol="o_orderkey").fit(train)
    return M.probability_columns(model.transform(valid).select("o_orderkey", "label", "probability", "prediction"),
                                 [f"p{i}" for i in range(5)])


@query("fit_svm_linear_ovo")
def fit_svm_linear_ovo(t: Tables):
    train, valid = parts(matrix(t, "priority"))
    model = M.PairwiseSVM(classes=5, c=1.0, iterations=5).fit(train)
    return model.transform(valid).select("o_orderkey", "label", "prediction")


@query("fit_knn_classifier", f"""with e as (select vec_id, embedding::double[] as v, label,
    {SPLIT.format(key='vec_id')} < 0.6 as is_train from embeddings),
    d as (select a.vec_id as query, a.label as truth, b.vec_id as neighbour, b.label,
      list_distance(a.v, b.v) as d from e a join e b on not a.is_train and b.is_train),
    r as (select *, row_number() over (partition by query order by d, neighbour) as k from d),
    v as (select query, truth, label, count(*) as votes, min(d) as nearest from r where k <= 5 group by all)
    select query, truth, arg_min(label, {{'votes': -votes, 'label': label}}) as prediction,
    round(min(nearest), 6) as nearest from v group by query, truth""")
def fit_knn_classifier(t: Tables):
    train, queries = parts(t.embeddings, "vec_id")
    found = M.knn_classify(train, queries, "vec_id", "embedding", "label", k=5, width=64)
    truth = queries.select(F.col("vec_id").alias("query"), F.col("label").alias("truth"))
    return found.join(truth, "query").select("query", "truth", "prediction", F.round("nearest", 6).alias("nearest"))


def with_gaps(t: Tables):
    """Order features with unknown values: discounts of some months, taxes of some orders."""
    return order_features(t).withColumns({
        "discount": F.when(F.col("month") != 2, F.col("discount")), "tax": F.when(F.col("o_orderkey") % 7 != 0, F.col("tax"))})


@query("fit_gbt_binary")
def fit_gbt_binary(t: Tables):
    """Boosting stopped by the area under the curve of held-out rows; gaps stay gaps."""
    rows = with_gaps(t)
    settings = B.Settings(rounds=10, depth=4, step=0.1, row_share=0.7, feature_share=0.7, seed=SEED)
    model = B.boost(rows, FEATURES, "label", "o_orderkey", settings, hash_fraction("o_orderkey", SEED) < 0.2, B.area_metric, patience=5, larger=True)
    return binary_scores(model, rows)


@query("fit_gbt_regression")
def fit_gbt_regression(t: Tables):
    """Boosting on log prices stopped by the relative error of held-out rows."""
    rows = with_gaps(t).withColumn("log_price", F.log1p("price"))
    settings = B.Settings(rounds=10, depth=4, step=0.3, row_share=0.7, feature_share=0.7, objective="squared", seed=SEED)
    model = B.boost(rows, [f for f in FEATURES if f != "price"], "log_price", "o_orderkey", settings,
                    hash_fraction("o_orderkey", SEED) < 0.2, B.column_metric(E.rmspe), patience=5)
    return model.transform(rows).select("o_orderkey", "price", F.expm1("prediction").alias("predicted"))


@query("cv_boosting_rounds")
def cv_boosting_rounds(t: Tables):
    """Held-out log loss of both folds after every round, grown together."""
    rows = stratified_folds(with_gaps(t), "o_orderkey", "label", 2, SEED)
    settings = B.Settings(rounds=5, depth=3, step=0.3, row_share=0.7, seed=SEED)
    _, history = B.boost_folds(rows, FEATURES, "label", "o_orderkey", "fold", 2, settings, B.column_metric(E.log_loss), patience=3)
    table = [(i + 1, m, i + 1 == history.best) for i, m in enumerate(history.means)]
    return t.spark.createDataFrame(table, "round int, log_loss double, is_best boolean")


@query("fit_per_group_ols", """select l_suppkey, count(*) as n, round(regr_intercept(y, l_quantity), 6) as intercept,
    round(regr_slope(y, l_quantity), 6) as slope, 0.0::double as fixed from (select *, ln(l_extendedprice + 1) as y
    from lineitem) group by l_suppkey""")
def fit_per_group_ols(t: Tables):
    # a column that is constant within a group takes no part in its fit
    rows = t.lineitem.withColumn("fixed", F.col("l_suppkey") * 2)
    fitted = M.fit_group_ols(rows, "l_suppkey", ["fixed", "l_quantity"], F.log1p("l_extendedprice"))
    return fitted.select("l_suppkey", "n", F.round("intercept", 6).alias("intercept"),
                         F.round(F.col("coefficients")[1], 6).alias("slope"),
                         F.round(F.col("coefficients")[0], 6).alias("fixed"))


@query("fit_mlp")
def fit_mlp(t: Tables):
    rows = t.embeddings.select("vec_id", F.col("label").cast("double").alias("label"),
                               array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    train, valid = parts(rows, "vec_id")
    model = DenseNetwork(hidden=[50, 20], dropout=[0.2, 0.0], epochs=10, batches=4, step=0.1, seed=SEED, keyCol="vec_id").fit(train)
    return M.probability_columns(model.transform(valid).select("vec_id", "label", "probability"),
                                 [f"p{i}" for i in range(10)])


@query("predict_proba")
def predict_proba(t: Tables):
    train, valid = parts(matrix(t, "priority"))
    with M.kept(train) as kept:
        model = M.random_forest(5, 4, SEED).fit(kept)
    return M.probability_columns(model.transform(valid).select("o_orderkey", "probability"), PRIORITIES)


@query("grid_search")
def grid_search(t: Tables):
    rows = stratified_folds(matrix(t), "o_orderkey", "label", 2, SEED)
    tree = M.decision_tree(5, SEED)
    maps = U.grid({tree.maxDepth: [2, 4], tree.impurity: ["gini", "entropy"]})
    found = U.search(rows, tree, maps, MulticlassClassificationEvaluator(metricName="f1"), "fold", 2)
    return found.table(t.spark)


@query("random_search")
def random_search(t: Tables):
    rows = stratified_folds(matrix(t), "o_orderkey", "label", 2, SEED)
    tree = M.decision_tree(5, SEED)
    maps = U.draws({tree.maxDepth: [2, 3, 4, 5, 6], tree.minInstancesPerNode: [3, 10, 30],
                    tree.impurity: ["gini", "entropy"]}, 3, SEED)
    found = U.search(rows, tree, maps, MulticlassClassificationEvaluator(metricName="logLoss"), "fold", 2)
    return found.table(t.spark)


@query("cross_val_score")
def cross_val_score(t: Tables):
    rows = stratified_folds(matrix(t), "o_orderkey", "label", 3, SEED)
    scores = U.fold_scores(rows, M.logistic(iterations=10),
                           MulticlassClassificationEvaluator(metricName="accuracy"), "fold", 3)
    return t.spark.createDataFrame([(n, s) for n, s, _ in scores], "fold int, score double")


@query("train_best_fold")
def train_best_fold(t: Tables):
    rows = stratified_folds(matrix(t), "o_orderkey", "label", 3, SEED)
    _, scores, curve = U.train_best_fold(rows, M.logistic(iterations=10), "o_orderkey", "label", "fold", 3)
    area = E.curve_area(t.spark.createDataFrame(curve)).first()["auc"]
    best = max(scores, key=lambda s: s[1])[0]
    return t.spark.createDataFrame([(n, s, n == best, area) for n, s in scores],
                                   "fold int, auc double, is_best boolean, mean_auc double")


@query("compare_models")
def compare_models(t: Tables):
    train, valid = parts(matrix(t))
    found = U.compare(train, valid, {
        "lr": M.logistic(iterations=10), "dt": M.decision_tree(5, SEED), "rf": M.random_forest(5, 5, SEED),
        "et": ExtraTreesClassifier(trees=5, maxDepth=5, seed=SEED),
    }, MulticlassClassificationEvaluator(metricName="logLoss"))
    return t.spark.createDataFrame([(i + 1, n, s) for i, (n, s, _) in enumerate(found)],
                                   "rank int, model string, log_loss double")


@query("refit_top_features")
def refit_top_features(t: Tables):
    train, valid = parts(matrix(t))
    with M.kept(train) as kept:
        first = [M.random_forest(5, 5, SEED).fit(kept), M.decision_tree(5, SEED).fit(kept)]
        wanted = U.top_feature_union(first, FEATURES, 3)
        again = M.random_forest(5, 5, SEED).fit(U.slice_features(kept, FEATURES, wanted))
    return binary_scores(again, U.slice_features(valid, FEATURES, wanted)).withColumn(
        "features", F.lit(",".join(wanted)))


@query("feature_importance")
def feature_importance(t: Tables):
    with M.kept(matrix(t)) as kept:
        model = M.random_forest(10, 5, SEED).fit(kept)
    return M.importances(model, FEATURES, t.orders)
