"""Queries: evaluation metrics."""

from pyspark.sql import functions as F

from millrace.operators import metrics as M
from millrace.operators import sampling as S
from millrace.suite.registry import Tables, query
from millrace.suite.sampling import random_rank

SCORED = """(select doc_id, quality as y, n_chars::double as score, n_chars / (n_chars + 1000.0::double) as p
    from labels join documents using (doc_id))"""


def scored(t: Tables):
    documents = t.documents.select("doc_id", F.col("n_chars").cast("double").alias("score"),
                                   (F.col("n_chars") / (F.col("n_chars") + 1000.0)).alias("p"))
    return t.labels.select("doc_id", F.col("quality").alias("y")).join(documents, "doc_id")


@query("log_loss_binary", f"""select round(-avg(y * ln(greatest(least(p, 1 - 1e-15::double), 1e-15::double))
    + (1 - y) * ln(1 - greatest(least(p, 1 - 1e-15::double), 1e-15::double))), 6) as loss from {SCORED}""")
def log_loss_binary(t: Tables):
    return scored(t).agg(F.round(M.log_loss(F.col("y"), F.col("p")), 6).alias("loss"))


@query("log_loss_multiclass", """with e as (select label, list_transform(embedding[1:10], lambda v: exp(v::double))
    as s from embeddings) select round(-avg(ln(s[label + 1] / list_sum(s))), 6) as loss from e""")
def log_loss_multiclass(t: Tables):
    exponents = F.transform(F.slice("embedding", 1, 10), lambda v: F.exp(v.cast("double")))
    total = F.aggregate(F.col("s"), F.lit(0.0), lambda a, v: a + v)
    rows = t.embeddings.select("label", exponents.alias("s")).select(
        "label", F.transform("s", lambda v: v / total).alias("p"))
    return rows.agg(F.round(M.log_loss_multiclass(F.col("label"), F.col("p")), 6).alias("loss"))


@query("roc_curve", f"""with c as (select score, count(*) filter (where y = 1) as pos, count(*) filter
    (where y <> 1) as neg from {SCORED} group by score) select score as threshold,
    sum(neg) over w / (select sum(neg) from c) as fpr, sum(pos) over w / (select sum(pos) from c) as tpr
    from c window w as (order by score desc)""")
def roc_curve(t: Tables):
    return M.roc_curve(scored(t), "y", "score")


@query("roc_auc", f"""with r as (select y, rank() over (order by score) + (count(*) over (partition by score)
    - 1) / 2.0::double as r from {SCORED}), n as (select count(*) filter (where y = 1)::double as p,
    count(*) filter (where y <> 1)::double as n from r)
    select round((sum(r) filter (where y = 1) - any_value(p) * (any_value(p) + 1) / 2)
    / (any_value(p) * any_value(n)), 6) as auc from r, n""")
def roc_auc(t: Tables):
    return M.roc_auc(scored(t), "y", "score").select(F.round("auc", 6).alias("auc"))


@query("mean_roc", f"""with s as (select (({random_rank('doc_id', 'y')} - 1) % 5)::integer as fold, y, score
    from {SCORED}), c as (select fold, score, count(*) filter (where y = 1) as pos, count(*) filter (where y <> 1)
    as neg from s group by all), k as (select fold, sum(neg) over w / sum(neg) over (partition by fold) as x,
    sum(pos) over w / sum(pos) over (partition by fold) as y,
    sum(neg) over w as fp, sum(neg) over (partition by fold) as n
    from c window w as (partition by fold order by score desc)),
    points as (select * from k union all select distinct fold, 0.0, 0.0, 0, n from k),
    grid as (select f.fold, g::integer as g from (select distinct fold from k) f, range(100) r(g)),
    b as (select grid.fold, g, max({{'x': x, 'y': y}}) filter (where fp * 99 <= g * n) as l,
      min({{'x': x, 'y': y}}) filter (where fp * 99 > g * n) as r from grid join points using (fold) group by all),
    v as (select g, case when g = 0 then 0 when r is null then l.y else l.y + (r.y - l.y) / (r.x - l.x)
      * (g / 99.0::double - l.x) end as v from b)
    select g, round(g / 99.0::double, 6) as fpr, round(case when g = 99 then 1.0::double else avg(v) end, 6) as tpr
    from v group by g""")
def mean_roc(t: Tables):
    folds = S.stratified_folds(scored(t), "doc_id", "y", 5, 720)
    return M.mean_roc(folds, "fold", "y", "score").withColumns(
        {"fpr": F.round("fpr", 6), "tpr": F.round("tpr", 6)})


LOGGED = "(select ln(l_extendedprice + 1) as y, ln(l_quantity * 1800 + 1) as p from lineitem)"


def logged(t: Tables):
    return t.lineitem.select(F.log1p("l_extendedprice").alias("y"),
                             F.log1p(F.col("l_quantity") * 1800).alias("p"))


@query("rmspe", f"select round(sqrt(avg(pow((exp(p) - 1) / (exp(y) - 1) - 1, 2))), 6) as rmspe from {LOGGED}")
def rmspe(t: Tables):
    return logged(t).agg(F.round(M.rmspe(F.col("y"), F.col("p")), 6).alias("rmspe"))


@query("median_absolute_error", f"select round(median(abs(y - p)), 6) as error, round(-median(abs(y - p)), 6)"
       f" as score from {LOGGED}")
def median_absolute_error(t: Tables):
    error = M.median_absolute_error(logged(t), "y", "p")
    return t.spark.createDataFrame([(round(error, 6), round(-error, 6))], "error double, score double")


@query("f1_accuracy", f"""with c as (select count(*) filter (where y = 1 and p > 0.5) as tp,
    count(*) filter (where y <> 1 and p > 0.5) as fp, count(*) filter (where y = 1 and p <= 0.5) as fn,
    count(*) filter (where y = (p > 0.5)::integer) as hits, count(*) as n from {SCORED})
    select tp, fp, fn, round(hits / n, 6) as accuracy, round(tp / (tp + fp), 6) as precision,
    round(tp / (tp + fn), 6) as recall, round(2 * tp / (2 * tp + fp + fn), 6) as f1 from c""")
def f1_accuracy(t: Tables):
    rows = scored(t).withColumn("guess", (F.col("p") > 0.5).cast("int"))
    scores = M.classification_scores(rows, "y", "guess")
    return scores.withColumns({c: F.round(c, 6) for c in ["accuracy", "precision", "recall", "f1"]})
