"""Queries: the places where user code plugs in."""

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.functions.hashing import hash_fraction
from millrace.operators import aggregates as A
from millrace.operators import boosting as B
from millrace.operators import cleaning as C
from millrace.operators.relational import hot_keys
from millrace.session import scratch_folder
from millrace.suite.learning import FEATURES, SEED, order_features
from millrace.suite.projections import NULL_ORDERS, null_price
from millrace.suite.registry import Tables, query


@query("udf_row_lambda", """select l_orderkey, l_linenumber, case when q <= 1 then 0 when q <= 2 then 1
    when q <= 3 then 2 else 3 end as tier, (l_returnflag = 'R')::integer as is_returned,
    'flag:' || l_returnflag as token from (select *, l_quantity / 10 as q from lineitem)""")
def udf_row_lambda(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", S.tier_code(F.col("l_quantity") / 10).alias("tier"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_returned"),
        S.prefix_token("flag", "l_returnflag").alias("token"))


@query("udaf_group_lambda", """select user_id, string_agg(distinct event_type || ':' || hour(ts)::varchar, ' '
    order by event_type || ':' || hour(ts)::varchar) as text from events group by user_id""")
def udaf_group_lambda(t: Tables):
    token = F.concat("event_type", F.lit(":"), F.hour("ts").cast("string"))
    return A.distinct_tokens(t.events, "user_id", token).select(
        "user_id", F.array_join("tokens", " ").alias("text"))


@query("udaf_custom_metric")
def udaf_custom_metric(t: Tables):
    """A user's metric after every round of boosting; the fit is stopped, stored, read again and gone on with."""
    rows = order_features(t).withColumn("log_price", F.log1p("price"))
    features = [f for f in FEATURES if f != "price"]
    held_out = hash_fraction("o_orderkey", SEED) >= 0.6
    metric = B.column_metric(lambda y, p: F.sqrt(F.avg(F.pow(F.expm1(p) / F.expm1(y) - 1, 2))))
    settings = B.Settings(rounds=3, depth=3, step=0.3, objective="squared", seed=SEED)
    folder = scratch_folder(t.spark) + "/boosted"
    B.boost(rows, features, "log_price", "o_orderkey", settings, held_out, metric).save(t.spark, folder)
    model = B.boost(rows, features, "log_price", "o_orderkey", B.replace(settings, rounds=6), held_out, metric, patience=2,
                    start=B.Boosted.load(t.spark, folder))
    history = model.history
    table = [(i + 1, m, i + 1 == history.best) for i, m in enumerate(history.means)]
    return t.spark.createDataFrame(table, "round int, rmspe double, is_best boolean")


HOT_PARTS = 64
"""Parts a hot group is cut into; every other group is one part."""


@query("group_map", """select l_suppkey, count(*) as n, round(avg(l_extendedprice / l_quantity), 6) as unit_price
    from lineitem group by l_suppkey""")
def group_map(t: Tables):
    """User code per group; hot groups go in salted parts whose results are then combined."""
    hot = [key[0] for key in hot_keys(t.lineitem, ["l_suppkey"], share=0.02)]
    salt = F.pmod(F.xxhash64("l_orderkey", "l_partkey"), F.lit(HOT_PARTS))
    part = F.when(F.col("l_suppkey").isin(hot), salt).otherwise(F.lit(0)) if hot else F.lit(0)
    rows = t.lineitem.select("l_suppkey", "l_quantity", "l_extendedprice", part.alias("part"))

    def summarise(keys: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        unit = pdf["l_extendedprice"] / pdf["l_quantity"]
        return pd.DataFrame({"l_suppkey": [keys[0]], "n": [len(pdf)], "total": [float(unit.sum())]})

    pieces = rows.groupBy("l_suppkey", "part").applyInPandas(summarise, "l_suppkey bigint, n bigint, total double")
    return pieces.groupBy("l_suppkey").agg(
        F.sum("n").alias("n"), F.round(F.sum("total") / F.sum("n"), 6).alias("unit_price"))


@query("custom_transformer", f"""with o as {NULL_ORDERS} select o_orderkey, round(coalesce(o_totalprice,
    (select avg(o_totalprice) from o)), 6) as o_totalprice from o""")
def custom_transformer(t: Tables):
    """A fit/transform class inside a Pipeline, stored and loaded before use."""
    orders = null_price(t.orders).select("o_orderkey", "o_totalprice")
    folder = scratch_folder(t.spark) + "/imputer"
    Pipeline(stages=[C.MixedImputer(inputCols=["o_totalprice"])]).fit(orders).write().overwrite().save(folder)
    return PipelineModel.load(folder).transform(orders).withColumn("o_totalprice", F.round("o_totalprice", 6))
