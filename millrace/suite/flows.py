"""Queries: the six problems end to end on the given tables."""

from pyspark.sql import functions as F

from millrace.functions.hashing import hash_fraction
from millrace.operators import models as M
from millrace.operators.aggregates import small_levels
from millrace.plans import claims, credit, devices, response, sales, trips
from millrace.session import scratch_table
from millrace.suite.learning import SEED, order_features
from millrace.suite.registry import Tables, query
from millrace.suite.sparse_features import dimension, sales_table, store_table


def halves(rows, key, target=None):
    chosen = hash_fraction(key, SEED) < 0.6
    test = rows.where(~chosen)
    return rows.where(chosen), test.drop(target) if target else test


def stored_halves(rows, key, target=None):
    """``halves`` of rows that cost joins and aggregates: these run once, and each key is hashed once."""
    both = scratch_table(rows.withColumn("_chosen", hash_fraction(key, SEED) < 0.6))
    train, test = both.where("_chosen").drop("_chosen"), both.where("not _chosen").drop("_chosen")
    return train, test.drop(target) if target else test


def claim_rows(t: Tables):
    """Orders with numeric and text columns, gaps on every seventh and eleventh key."""
    customer = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    texts = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderpriority").join(
        customer, "c_custkey").join(t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    gap = F.col("o_orderkey") % 7 == 0
    return order_features(t).drop("priority").join(texts.drop("c_custkey", "c_nationkey"), "o_orderkey").select(
        F.col("o_orderkey").alias("ID"), F.col("label").cast("int").alias("target"),
        "quantity", "lines", "tax", "late", "month", "c_acctbal",
        F.when(gap, None).otherwise(F.col("discount")).alias("discount"),
        F.when(F.col("o_orderkey") % 11 == 0, None).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"), F.lit("x").alias("same"))


@query("claims_forest")
def claims_forest(t: Tables):
    train, test = stored_halves(claim_rows(t), "ID", "target")
    scores, loss = claims.forest_scores(train, test, "ID", "target", max_values=10, trees=10, depth=5, seed=SEED)
    return scores.withColumn("held_out_loss", F.lit(loss))


@query("claims_extra_trees")
def claims_extra_trees(t: Tables):
    train, test = stored_halves(claim_rows(t).drop("same"), "ID", "target")
    scores, loss = claims.extra_trees_scores(train, test, "ID", "target", trees=4, depth=5, seed=SEED)
    return scores.withColumn("held_out_loss", F.lit(loss))


@query("claims_boosted_runs")
def claims_boosted_runs(t: Tables):
    train, test = stored_halves(claim_rows(t), "ID", "target")
    scores, best = claims.boosted_scores(train, test, "ID", "target", rounds=4, folds=2, runs=2, depth=3,
                                         validation_rows=200, seed=SEED)
    return scores.withColumn("rounds", F.lit(best))


@query("credit_default")
def credit_default(t: Tables):
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum("o_totalprice").alias("total"), F.count("*").alias("orders"),
        F.count_if(F.col("o_orderstatus") == "P").alias("late"))
    lines = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    per_customer = lines.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.avg("l_extendedprice").alias("mean_price"), F.count("*").alias("lines"),
        F.sum("l_discount").alias("discounts"), F.count_if(F.col("l_returnflag") == "R").alias("returned"))
    rows = t.customer.join(orders, "c_custkey").join(per_customer, "c_custkey").select(
        F.col("c_custkey").alias("Id"), (F.col("c_acctbal") < 0).cast("int").alias(credit.TARGET),
        (F.pow(F.col("mean_price") / 50000, 3)).alias("RevolvingUtilizationOfUnsecuredLines"),
        (20 + F.col("c_custkey") % 61).alias("age"),
        F.when(F.col("c_custkey") % 97 == 0, 98).otherwise(F.col("late")).alias("NumberOfTime30-59DaysPastDueNotWorse"),
        F.col("returned").alias("NumberOfTime60-89DaysPastDueNotWorse"),
        (F.col("late") % 3).alias("NumberOfTimes90DaysLate"), F.col("discounts").alias("DebtRatio"),
        F.when(F.col("c_custkey") % 7 == 0, None).otherwise(F.col("total") / 1000).alias("MonthlyIncome"),
        F.col("lines").alias("NumberOfOpenCreditLinesAndLoans"),
        (F.col("orders") % 5).alias("NumberRealEstateLoansOrLines"),
        F.when(F.col("c_custkey") % 11 == 0, None).otherwise(F.col("c_custkey") % 4).alias("NumberOfDependents"))
    train, test = halves(rows, "Id")
    template = test.select("Id", F.lit(0.5).alias("Probability"))
    scores, areas = credit.default_scores(train, test, "Id", template, income_trees=5, trees=5, depth=4, folds=2,
                                          seed=SEED)
    return scores.withColumn("auc", F.lit(max(a for _, a in areas)))


@query("response_boosting")
def response_boosting(t: Tables):
    train, test = stored_halves(claim_rows(t), "ID", "target")
    scores, areas, best = response.response_scores(train, test, "ID", "target", validation_rows=200, rounds=5,
                                                   depth=3, patience=3, seed=SEED)
    return scores.withColumns({"round": F.lit(best), "auc": F.lit(areas[best - 1])})


@query("device_groups")
def device_groups(t: Tables):
    people = t.customer.select(F.col("c_custkey").alias("device_id"), F.col("c_mktsegment").alias("group"))
    events = t.events.withColumnRenamed("user_id", "device_id")
    rows = devices.training_set(people, events, dimension(t), "device_id", "ts")
    train, test = halves(rows, "device_id", "group")
    scores, method, loss = devices.group_scores(train, test, "device_id", "group", {
        "lr": M.logistic(iterations=5), "rf": M.random_forest(4, 4, SEED)}, folds=2, seed=SEED)
    return scores.withColumns({"method": F.lit(method), "log_loss": F.lit(loss)})


@query("trip_types")
def trip_types(t: Tables):
    brands = small_levels(t.part, "p_brand")
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("trip"),
                             F.date_format("o_orderdate", "EEEE").alias("day"))
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity").join(parts, "l_partkey").join(orders, "l_orderkey")
    visits = trips.department_table(rows, "l_orderkey", "day", "p_brand", "l_quantity", brands, "trip")
    train, test = stored_halves(visits, "l_orderkey", "trip")
    features = [c for c in test.columns if c != "l_orderkey"]
    return trips.trip_scores(train, test, "l_orderkey", "trip", features, trees=5, depth=5, seed=SEED)


def sales_halves(t: Tables):
    rows = sales.sales_features(sales_table(t), store_table(t), holidays=["f"])
    train, test = halves(rows, "Id", "Sales")
    return train, test


@query("sales_boosting")
def sales_boosting(t: Tables):
    train, test = sales_halves(t)
    scores, error = sales.boosted_sales(train, test, "Id", rounds=5, depth=4, seed=SEED)
    return scores.withColumn("held_out_rmspe", F.lit(error))


@query("sales_per_store")
def sales_per_store(t: Tables):
    train, test = sales_halves(t)
    return sales.per_store_sales(train.drop("Open"), test.drop("Open"), "Id")
