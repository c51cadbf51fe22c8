"""Queries: ensembles of runs."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import ensembling as B
from millrace.operators import models as M
from millrace.operators.sampling import stratified_folds
from millrace.session import scratch_table
from millrace.suite.joining import RUNS, prediction_runs
from millrace.suite.learning import SEED, matrix, parts
from millrace.suite.registry import Tables, query


@query("average_submissions", f"""select event_id, round(sum(p) / 3, 8) as by_files, round(avg(p), 8) as by_rows
    from {RUNS} group by event_id""")
def average_submissions(t: Tables):
    runs = prediction_runs(t)
    by_files = B.average_runs(runs, "event_id", "p", "run", "files")
    both = by_files.withColumnRenamed("p", "by_files").join(
        B.average_runs(runs, "event_id", "p", "run").withColumnRenamed("p", "by_rows"), "event_id")
    return both.select("event_id", *[F.round(c, 8).alias(c) for c in ["by_files", "by_rows"]])


@query("bagged_seed_runs")
def bagged_seed_runs(t: Tables):
    train, test = parts(matrix(t))
    runs = B.seed_runs(train, test, lambda seed: M.gbt_binary(4, 3, 0.1, 0.7, seed), "o_orderkey", 3, SEED, 10,
                       M.positive_probability())
    return B.average_runs(runs, "o_orderkey", "p", "run")


@query("average_best_worst_runs", """with r as (select l_suppkey as run, l_partkey as id, avg(l_extendedprice) as p
    from lineitem group by all), s as (select s_suppkey as run, s_acctbal as score from supplier),
    k as (select run from s where score in (select score from s order by score limit 3)
      or score in (select score from s order by score desc limit 3))
    select id, round(avg(p), 6) as p from r semi join k using (run) group by id""")
def average_best_worst_runs(t: Tables):
    runs = t.lineitem.groupBy(F.col("l_suppkey").alias("run"), F.col("l_partkey").alias("id")).agg(
        F.avg("l_extendedprice").alias("p"))
    scores = t.supplier.select(F.col("s_suppkey").alias("run"), F.col("s_acctbal").alias("score"))
    found = B.average_best_worst(runs, scores, "id", "run", "p", "score", 3)
    return found.select("id", F.round("p", 6).alias("p"))


def candidates():
    return {"lr": M.logistic(iterations=5), "rf": M.random_forest(4, 4, SEED), "dt": M.decision_tree(4, SEED)}


@query("stacked_generalization")
def stacked_generalization(t: Tables):
    train, test = parts(matrix(t, "priority"))
    folded = stratified_folds(train, "o_orderkey", "label", 2, SEED)
    stack = B.Stack(candidates(), 2, iterations=10)
    stack.fit(folded, "o_orderkey", "label", "fold")
    return M.probability_columns(stack.transform(test, ["o_orderkey", "label"]), [f"p{i}" for i in range(5)])


@query("choose_single_or_blend")
def choose_single_or_blend(t: Tables):
    rows = scratch_table(matrix(t))  # read by every fit and score
    train, rest = parts(rows)
    folded = stratified_folds(train, "o_orderkey", "label", 2, SEED)
    single = M.logistic(iterations=5).fit(train)
    stack = B.Stack({"lr": M.logistic(iterations=5), "dt": M.decision_tree(4, SEED)}, 2, iterations=10)
    stack.fit(folded, "o_orderkey", "label", "fold")
    name, loss, scorer = B.choose_lower(
        ("single", B.multiclass_loss(single.transform(rest)), lambda df: single.transform(df)),
        ("blend", B.multiclass_loss(stack.transform(rest, ["o_orderkey", "label"])),
         lambda df: stack.transform(df, ["o_orderkey", "label"])))
    return scorer(rest).select("o_orderkey", F.lit(name).alias("method"), F.lit(loss).alias("log_loss"),
                               F.get(vector_to_array("probability"), F.lit(1)).alias("p"))
