"""Queries: imputation, encoding, buckets, scaling, outliers, feature selection."""

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.functions.hashing import hash_fraction
from millrace.operators import binning as B
from millrace.operators import cleaning as C
from millrace.operators import encoding as E
from millrace.operators import selection as X
from millrace.suite.grouping import PART_NULLS, edge_list, part_nulls
from millrace.suite.projections import NULL_ORDERS, SPLIT, null_price, null_text
from millrace.suite.registry import Tables, query


@query("impute_mean_mode", f"""with o as {NULL_ORDERS} select o_orderkey, round(coalesce(o_totalprice,
    (select avg(o_totalprice) from o)), 6) as o_totalprice, coalesce(o_orderpriority,
    (select o_orderpriority from o where o_orderpriority is not null group by o_orderpriority
     order by count(*) desc, o_orderpriority limit 1)) as o_orderpriority from o""")
def impute_mean_mode(t: Tables):
    orders = null_text(null_price(t.orders)).select("o_orderkey", "o_totalprice", "o_orderpriority")
    model = C.MixedImputer(inputCols=["o_totalprice", "o_orderpriority"]).fit(orders)
    return model.transform(orders).withColumn("o_totalprice", F.round("o_totalprice", 6))


@query("impute_median", f"""with o as {NULL_ORDERS} select o_orderkey, round(coalesce(o_totalprice,
    (select median(o_totalprice) from o)), 6) as o_totalprice from o""")
def impute_median(t: Tables):
    orders = null_price(t.orders).select("o_orderkey", "o_totalprice")
    return C.fill_median(orders, ["o_totalprice"]).withColumn("o_totalprice", F.round("o_totalprice", 6))


@query("impute_by_regression")
def impute_by_regression(t: Tables):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("quantity"), F.count("*").cast("double").alias("lines"),
        F.avg("l_discount").alias("discount"))
    orders = null_price(t.orders).select("o_orderkey", "o_totalprice").join(lines, "o_orderkey")
    features = ["quantity", "lines", "discount"]
    model = C.fit_column_regressor(orders, "o_totalprice", features, trees=10, depth=5, seed=329521)
    return C.fill_by_regression(orders, model, "o_totalprice").select(
        "o_orderkey", "o_totalprice", "o_totalprice_Imputed")


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("onehot", "select o_orderkey, " + ", ".join(
    f"case when o_orderpriority = '{p}' then 1 else 0 end as \"o_orderpriority_{p}\"" for p in PRIORITIES)
    + f" from {NULL_ORDERS}")
def onehot(t: Tables):
    orders = null_text(t.orders).select("o_orderkey", "o_orderpriority")
    return E.OneHotModel.fit(orders, ["o_orderpriority"]).transform(orders)


PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("onehot_low_cardinality", "select p_partkey, p_size, fixed, " + ", ".join(
    f"case when p_type = '{v}' then 1 else 0 end as p_type_{v}" for v in PART_TYPES)
    + f", 1 as label_x from {PART_NULLS}")
def onehot_low_cardinality(t: Tables):
    parts = part_nulls(t)
    model, dropped = E.onehot_low_cardinality(parts, 10)
    return model.transform(parts).drop(*dropped)


@query("label_encode_sorted", """select p_partkey, p_type, dense_rank() over (order by p_type) - 1 as code
    from part""")
def label_encode_sorted(t: Tables):
    part = t.part.select("p_partkey", "p_type")
    return E.encode(part, E.sorted_levels(part, "p_type"), "p_type", "code")


@query("label_encode_first_seen", """with l as (select event_type, row_number() over (order by min(event_id))
    - 1 as code from events where event_id % 7 <> 0 and event_type <> 'error' group by event_type)
    select event_id, e.event_type, coalesce(code, -1) as code from events e left join l using (event_type)""")
def label_encode_first_seen(t: Tables):
    events = t.events.select("event_id", "event_type")
    known = events.where("event_id % 7 <> 0 and event_type <> 'error'")
    levels = E.first_seen_levels(known, "event_type", "event_id")
    return E.encode(events, levels, "event_type", "code", unseen=-1)


def bucket_sql(x, edges):
    return f"cast(len(list_filter({edges}, lambda v: v < {x})) as integer)"


@query("qcut", f"""with e as (select {edge_list(10, 'l_extendedprice')} as edges from lineitem)
    select l_orderkey, l_linenumber, l_extendedprice, {bucket_sql('l_extendedprice', 'edges')} as bucket
    from lineitem, e""")
def qcut(t: Tables):
    edges = B.quantile_edges(t.lineitem, {"l_extendedprice": 10})["l_extendedprice"]
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice",
                             B.bucket_code("l_extendedprice", edges).alias("bucket"))


JITTERED = f"""(select o_orderkey, x + ({SPLIT.format(key='o_orderkey')} * width - width / 2) as x
    from (select o_orderkey, (o_custkey % 9)::double as x from orders),
    (select stddev_samp((o_custkey % 9)::double) / 1000000 as width from orders))"""


@query("qcut_jitter", f"""with j as {JITTERED}, e as (select {edge_list(4, 'x')} as edges from j)
    select o_orderkey, {bucket_sql('x', 'edges')} as bucket from j, e""")
def qcut_jitter(t: Tables):
    # nine values in four buckets: equal values are told apart by the noise
    orders = t.orders.select("o_orderkey", (F.col("o_custkey") % 9).cast("double").alias("x"))
    noisy = orders.select("o_orderkey", B.jitter(orders, "x", "o_orderkey", 720).alias("x"))
    edges = B.quantile_edges(noisy, {"x": 4})["x"]
    return noisy.select("o_orderkey", B.bucket_code("x", edges).alias("bucket"))


@query("split_into_buckets", f"""with s as (select o_orderkey, o_totalprice as x,
    {SPLIT.format(key='o_orderkey')} < 0.6 as is_train from orders),
    e as (select {edge_list(8, 'x')} as edges from s where is_train),
    b as (select *, {bucket_sql('x', 'edges')} as code from s, e)
    select o_orderkey, is_train, {', '.join(
    f"case when code = {i} then 1 else 0 end as o_totalprice_bucket_{i}" for i in range(8))} from b""")
def split_into_buckets(t: Tables):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    is_train = hash_fraction("o_orderkey", 720) < 0.6
    train, test = B.split_into_buckets(orders.where(is_train), orders.where(~is_train), "o_totalprice", 8)
    return train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))


@query("utilization_features", f"""with r as (select l_orderkey, l_linenumber, l_extendedprice / 30000 as ratio
    from lineitem), e as (select {edge_list(9, 'ratio')} as edges from r where ratio between 0 and 1),
    b as (select *, case when ratio between 0 and 1 then {bucket_sql('ratio', 'edges')} end as code from r, e)
    select l_orderkey, l_linenumber, case when ratio <= 1 then 1 else 0 end as has_no_cards_cancelled,
    case when ratio > 1 and ratio <= 2 then 1 else 0 end as has_1_card_cancelled,
    case when ratio > 2 and ratio <= 3 then 1 else 0 end as has_2_cards_cancelled,
    case when ratio > 3 then 1 else 0 end as has_3ormore_cards_cancelled,
    {', '.join(f"case when code = {i} then 1 else 0 end as ratio_bucket_{i}" for i in range(9))} from b""")
def utilization_features(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") / 30000).alias("ratio"))
    return B.UtilisationModel.fit(rows, "ratio").transform(rows)


SCALES = ["l_quantity", "l_extendedprice"]


@query("minmax_scale", "select l_orderkey, l_linenumber, " + ", ".join(
    f"round((l.{c} - m.{c}_low) / (m.{c}_high - m.{c}_low), 6) as {c}" for c in SCALES)
    + ", 0.0::double as fixed from lineitem l, (select "
    + ", ".join(f"min({c}) as {c}_low, max({c}) as {c}_high" for c in SCALES) + " from lineitem) m")
def minmax_scale(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", *SCALES, F.lit(7.0).alias("fixed"))
    scaled = C.MinMaxModel.fit(rows, [*SCALES, "fixed"]).transform(rows)
    return scaled.withColumns({c: F.round(c, 6) for c in SCALES})


@query("minmax_inverse", """select o_orderkey, cast(trunc((o_totalprice - low) / (high - low) * (high - low)
    + low) as bigint) as price from orders, (select min(o_totalprice) as low, max(o_totalprice) as high
    from orders)""")
def minmax_inverse(t: Tables):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    model = C.MinMaxModel.fit(orders, ["o_totalprice"])
    scaled = model.transform(orders)
    return scaled.select("o_orderkey", model.inverse(F.col("o_totalprice"), "o_totalprice").alias("price"))


@query("winsorize", f"""with o as {NULL_ORDERS}, s as (select list_sort(list(o_totalprice)) as v from o
    where o_totalprice is not null), b as (select v[floor(0.05 * len(v))::integer + 1] as low,
    v[len(v) - floor(0.05 * len(v))::integer] as high from s)
    select o_orderkey, case when o_totalprice is not null then greatest(least(o_totalprice, high), low) end
    as o_totalprice from o, b""")
def winsorize(t: Tables):
    return C.winsorize(null_price(t.orders).select("o_orderkey", "o_totalprice"), ["o_totalprice"])


SKEWED = "(select o_orderkey, exp(o_totalprice / 100000) as x from orders)"
PERCENTILE_FLAG = f"""(select o_orderkey, x < low or x > high as by_percentile from {SKEWED},
    (select quantile_cont(x, 0.025) as low, quantile_cont(x, 0.975) as high from {SKEWED}))"""
MAD_FLAG = f"""(with m as (select median(x) as m from {SKEWED}),
    d as (select o_orderkey, abs(x - m) as d from {SKEWED}, m), s as (select median(d) as s from d)
    select o_orderkey, 0.6745 * d / s > 3.5 as by_mad from d, s)"""
DOUBLE_FLAG = f"""(with m as (select median(x) as m from {SKEWED}),
    d as (select o_orderkey, x, m, abs(x - m) as d from {SKEWED}, m),
    s as (select median(d) filter (where x <= m) as l, median(d) filter (where x >= m) as r from d)
    select o_orderkey, case when x = m then false else 0.6745 * d / case when x > m then r else l end > 3.5
    end as by_double_mad from d, s)"""


def skewed(t: Tables):
    return t.orders.select("o_orderkey", F.exp(F.col("o_totalprice") / 100000).alias("x"))


@query("outlier_percentile", f"select * from {PERCENTILE_FLAG}")
def outlier_percentile(t: Tables):
    rows = skewed(t)
    return rows.select("o_orderkey", C.percentile_outlier(rows, "x").alias("by_percentile"))


@query("outlier_mad", f"select * from {MAD_FLAG}")
def outlier_mad(t: Tables):
    rows = skewed(t)
    return rows.select("o_orderkey", C.mad_outlier(rows, "x").alias("by_mad"))


@query("outlier_double_mad", f"select * from {DOUBLE_FLAG}")
def outlier_double_mad(t: Tables):
    rows = skewed(t)
    return rows.select("o_orderkey", C.double_mad_outlier(rows, "x").alias("by_double_mad"))


@query("outlier_vote", f"""select o_orderkey, by_percentile, by_mad, by_double_mad, by_percentile::integer
    + by_mad::integer + by_double_mad::integer as votes, by_percentile and by_mad and by_double_mad
    as is_outlier from {PERCENTILE_FLAG} join {MAD_FLAG} using (o_orderkey)
    join {DOUBLE_FLAG} using (o_orderkey)""")
def outlier_vote(t: Tables):
    return C.outlier_votes(skewed(t), "x").drop("x")


@query("constant_columns", f"select p_partkey, p_name, p_brand, p_type, p_size from {PART_NULLS}")
def constant_columns(t: Tables):
    parts = part_nulls(t)
    return parts.drop(*X.constant_columns(parts))


NZV_COLUMNS = ["l_quantity", "l_linenumber", "rare", "fixed"]
NZV_ROWS = """(select l_quantity, l_linenumber, case when l_quantity = 1 then 1 else 0 end as rare,
    'x' as fixed from lineitem)"""


@query("near_zero_variance", "with c as (" + " union all ".join(
    f"select '{c}' as \"column\", count(*) as n from {NZV_ROWS} group by {c}" for c in NZV_COLUMNS)
    + """), r as (select *, row_number() over (partition by "column" order by n desc) as k from c),
    s as (select "column", max(n) filter (where k = 1) as a, max(n) filter (where k = 2) as b,
          count(*) as u, sum(n) as rows from r group by "column")
    select "column", round(coalesce(a / b, 0), 6) as freq_ratio, round(100.0::double * u / rows, 6)
    as percent_unique, u = 1 as zero_var, u = 1 or (coalesce(a / b, 0) > 95 / 5 and 100.0 * u / rows <= 10)
    as nzv from s""")
def near_zero_variance(t: Tables):
    rows = t.lineitem.select("l_quantity", "l_linenumber",
                             F.when(F.col("l_quantity") == 1, 1).otherwise(0).alias("rare"),
                             F.lit("x").alias("fixed"))
    return X.near_zero_variance(rows, NZV_COLUMNS).withColumns(
        {c: F.round(c, 6) for c in ["freq_ratio", "percent_unique"]})


CORRELATED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "net", "gross"]
_PAIRS = [(i, j) for i in range(6) for j in range(i, 6)]


def _dropped_sql(side: str) -> str:
    """The filter of one side: columns in falling order of their mean correlation, then pair by pair."""
    matrix = ", ".join(f"abs(corr({CORRELATED[i]}, {CORRELATED[j]})) as c{i}{j}" for i, j in _PAIRS)
    cells = "[" + ", ".join("[" + ", ".join(f"c{min(i, j)}{max(i, j)}" for j in range(6)) + "]" for i in range(6)) + "]"
    return f"""{side}_corr as (select {cells} as m from (select {matrix} from r where {'' if side == 'train' else 'not '}is_train)),
    {side}_place as (select i, row_number() over (order by list_avg(m[i]) desc, i) as place from {side}_corr, range(1, 7) as t(i)),
    {side}_sorted as (select (select list(i order by place) from {side}_place) as o, m from {side}_corr),
    {side}_pair as (select row_number() over (order by a, b) as step, a, b from range(1, 7) as x(a), range(1, 7) as y(b) where b > a),
    {side}_walk as (select 0::bigint as step, []::bigint[] as d union all
      select w.step + 1, case when list_contains(d, o[a]) or list_contains(d, o[b]) or m[o[a]][o[b]] <= 0.9 then d
        when list_avg([m[o[a]][k] for k in range(1, 7) if k <> o[a] and not list_contains(d, k)])
          > list_avg(flatten([[m[q][k] for k in range(1, 7) if k <> q and not list_contains(d, k)] for q in range(1, 7)
              if q <> o[b] and not list_contains(d, q)]))
        then list_append(d, o[a]) else list_append(d, o[b]) end
      from {side}_walk w join {side}_pair p on p.step = w.step + 1, {side}_sorted),
    {side}_out as (select arg_max(d, step) as d from {side}_walk)"""


@query("high_correlation_filter", f"""with recursive r as (select l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax,
    l_extendedprice * (1 - l_discount) as net, l_extendedprice * (1 + l_tax) as gross,
    {SPLIT.format(key='l_orderkey')} < 0.6 as is_train from lineitem), {_dropped_sql('train')}, {_dropped_sql('test')}
    select l_orderkey, "column", round(value, 6) as value from (select l_orderkey, {', '.join(f"{c}::double as {c}" for c in CORRELATED)} from r)
    unpivot (value for "column" in ({', '.join(CORRELATED)}))
    where not list_contains((select list_intersect(train_out.d, test_out.d) from train_out, test_out), list_position({CORRELATED}, "column"))""")
def high_correlation_filter(t: Tables):
    rows = t.lineitem.select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("gross"))
    columns = rows.columns[1:]
    is_train = hash_fraction("l_orderkey", 720) < 0.6
    dropped = X.common_highly_correlated(rows.where(is_train), rows.where(~is_train), columns, 0.9)
    left = [c for c in columns if c not in dropped]
    # which columns are left depends on the data, so they come in long form
    doubles = rows.select("l_orderkey", *[F.col(c).cast("double").alias(c) for c in left])
    return doubles.unpivot("l_orderkey", left, "column", "value").withColumn("value", F.round("value", 6))


@query("select_percentile_anova", """with v as (select label, unnest(embedding)::double as v,
    unnest(range(len(embedding)))::integer as feature from embeddings),
    p as (select feature, label, count(*) as n, sum(v) as s, sum(v * v) as q from v group by all),
    f as (select feature, ((sum(s * s / n) - sum(s) * sum(s) / sum(n)) / (count(*) - 1))
          / ((sum(q) - sum(s * s / n)) / (sum(n) - count(*))) as f from p group by feature)
    select feature, round(f, 6) as f, f > (select quantile_cont(f, 0.77) from f) as selected from f""")
def select_percentile_anova(t: Tables):
    scores = X.anova_scores(t.embeddings, "embedding", "label")
    selected = X.select_percentile(scores, 23)
    return scores.select("feature", F.round("f", 6).alias("f"), F.col("feature").isin(selected).alias("selected"))


@query("assemble_features", f"""select o_orderkey, cast(case when o_orderstatus = 'F' then 1 else 0 end as double)
    as label, o_custkey::double as f0, coalesce(o_totalprice, -1) as f1, month(o_orderdate)::double as f2
    from {NULL_ORDERS}""")
def assemble_features(t: Tables):
    orders = null_price(t.orders).na.fill({"o_totalprice": -1.0}).withColumn("month", F.month("o_orderdate"))
    matrix = VectorAssembler(inputCols=["o_custkey", "o_totalprice", "month"], outputCol="features",
                             handleInvalid="error").transform(orders)
    cells = vector_to_array("features")
    return matrix.select("o_orderkey", (F.col("o_orderstatus") == "F").cast("double").alias("label"),
                         *[cells[i].alias(f"f{i}") for i in range(3)])
