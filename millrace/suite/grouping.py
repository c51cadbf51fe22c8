"""Queries: aggregations."""

from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import aggregates as A
from millrace.operators import binning as B
from millrace.operators.ordered import quantiles
from millrace.suite.projections import NULL_ORDERS, null_price, null_text
from millrace.suite.registry import Tables, query

HOURS = list(range(24))
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("agg_sum_single_key", """select l_orderkey, round(sum(l_quantity), 4) as l_quantity,
    round(sum(l_extendedprice), 4) as l_extendedprice, round(sum(l_discount), 4) as l_discount,
    round(sum(l_tax), 4) as l_tax from lineitem group by l_orderkey""")
def agg_sum_single_key(t: Tables):
    summed = A.sum_columns(t.lineitem.select("l_orderkey", *LINE_NUMBERS), ["l_orderkey"])
    return summed.select("l_orderkey", *[F.round(c, 4).alias(c) for c in LINE_NUMBERS])


@query("agg_sum_multi_key", """select l_suppkey, sum(quantity) as quantity, count(*) as flags,
    max(quantity) as top_quantity from (select l_suppkey, l_returnflag, l_linestatus,
    sum(l_quantity) as quantity from lineitem group by all) group by l_suppkey""")
def agg_sum_multi_key(t: Tables):
    fine = t.lineitem.groupBy("l_suppkey", "l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("quantity"))
    return fine.groupBy("l_suppkey").agg(
        F.sum("quantity").alias("quantity"), F.count("*").alias("flags"),
        F.max("quantity").alias("top_quantity"))


@query("agg_group_size", """select user, event_type, count(*) as size from (select event_type,
    case when event_id % 7 = 0 then null else user_id end as user from events)
    where user is not null group by all""")
def agg_group_size(t: Tables):
    events = t.events.select("event_type", F.when(F.col("event_id") % 7 == 0, None)
                             .otherwise(F.col("user_id")).alias("user"))
    return A.group_sizes(events, ["user", "event_type"])


HOUR_COUNTS = ", ".join(f"count(*) filter (where hour(ts) = {h}) as h{h}" for h in HOURS)


@query("crosstab", f"select user_id, {HOUR_COUNTS} from events group by user_id")
def crosstab(t: Tables):
    return A.counts_by_category(t.events, "user_id", F.hour("ts"), HOURS, "h")


@query("unstack_counts", f"select event_type, {HOUR_COUNTS} from events group by event_type")
def unstack_counts(t: Tables):
    long = t.events.groupBy("event_type", F.hour("ts").alias("hour")).agg(F.count("*").alias("n"))
    return A.pivot_sum(long, ["event_type"], "hour", {h: f"h{h}" for h in HOURS}, "n")


@query("pivot_indicator_sum", """select l_orderkey, """ + ", ".join(
    f"count(*) filter (where code = {c}) as Prod{c:04d}" for c in range(1, 25)) +
    """, count(*) filter (where code = 999999) as Prod999999
    from (select l_orderkey, coalesce(cast(nullif(replace(p_brand, 'Brand#', ''), '25') as integer), 999999)
          as code from lineitem join part on l_partkey = p_partkey) group by l_orderkey""")
def pivot_indicator_sum(t: Tables):
    # product codes 1 to 24; the last brand stands for a missing code
    code = F.coalesce(F.nullif(F.replace("p_brand", F.lit("Brand#"), F.lit("")), F.lit("25")).cast("int"),
                      F.lit(999999))
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), code.alias("code"))
    lines = t.lineitem.select("l_orderkey", "l_partkey").join(parts, "l_partkey")
    codes = A.small_levels(parts, "code")
    names = {c: f"Prod{c:04d}" for c in codes}
    return lines.groupBy("l_orderkey").agg(*[F.count_if(F.col("code") == c).alias(names[c]) for c in codes])


WEEKDAYS = ["Friday", "Monday", "Saturday", "Sunday", "Thursday", "Tuesday", "Wednesday"]


def visit_departments(t: Tables):
    """Visits with scan counts per department id, as the trip data has them."""
    brands = A.small_levels(t.part, "p_brand")
    dept = F.element_at(F.create_map(*[x for i, b in enumerate(brands) for x in (F.lit(b), F.lit(i))]),
                        F.col("p_brand"))
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), dept.alias("dept"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("visit"), "l_partkey", "l_quantity")
    wide = A.pivot_sum(lines.join(parts, "l_partkey"), ["visit"], "dept",
                       {i: f"Dept{i:02d}" for i in range(len(brands))}, "l_quantity")
    day = F.date_format("o_orderdate", "EEEE")
    orders = t.orders.select(
        F.col("o_orderkey").alias("visit"), F.col("o_orderpriority").alias("trip_type"),
        (F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), day) - 1).alias("dow"))
    return wide.join(orders, "visit")


@query("pivot_dept_scan", """with d as (select p_partkey, dense_rank() over (order by p_brand) - 1 as dept
    from part) select l_orderkey as visit, o_orderpriority as trip_type, list_position(['Friday',
    'Monday', 'Saturday', 'Sunday', 'Thursday', 'Tuesday', 'Wednesday'], dayname(o_orderdate))::bigint - 1
    as dow, """ + ", ".join(f"coalesce(sum(l_quantity) filter (where dept = {i}), 0) as Dept{i:02d}"
                            for i in range(25)) +
    """ from lineitem join d on l_partkey = p_partkey join orders on l_orderkey = o_orderkey
    group by l_orderkey, o_orderpriority, o_orderdate""")
def pivot_dept_scan(t: Tables):
    return visit_departments(t)


@query("string_agg", """select conv_id, 0 as block, string_agg(role || ':' || length(text)::varchar, ' '
    order by turn) as text from conversations group by conv_id""")
def string_agg(t: Tables):
    rows = t.conversations.select(
        "conv_id", "turn", F.concat("role", F.lit(":"), F.length("text").cast("string")).alias("word"))
    return A.join_text(rows, "conv_id", "word", "turn")


@query("string_agg_distinct", """select user_id, string_agg(distinct 'app_id:' || event_type, ' '
    order by 'app_id:' || event_type) as tokens from events group by user_id""")
def string_agg_distinct(t: Tables):
    tokens = A.distinct_tokens(t.events, "user_id", S.prefix_token("app_id", "event_type"))
    return tokens.select("user_id", F.array_join("tokens", " ").alias("tokens"))


@query("distinct_values", "select distinct p_brand from part order by p_brand")
def distinct_values(t: Tables):
    return t.part.select("p_brand").distinct().orderBy("p_brand")


PART_NULLS = """(select p_partkey, p_name, case when p_partkey % 11 = 0 then null else p_brand end
    as p_brand, p_type, p_size, 7 as fixed, 'x' as label from part)"""


def part_nulls(t: Tables):
    return t.part.select("p_partkey", "p_name", F.when(F.col("p_partkey") % 11 == 0, None)
                         .otherwise(F.col("p_brand")).alias("p_brand"), "p_type", "p_size",
                         F.lit(7).alias("fixed"), F.lit("x").alias("label"))


def unique_counts_sql(columns):
    return " union all ".join(
        f"select '{c}' as \"column\", count(distinct {c}) + max(case when {c} is null then 1 else 0 end)"
        f" as n_unique from {PART_NULLS}" for c in columns)


@query("count_distinct_per_column", unique_counts_sql(["p_name", "p_brand", "p_type", "label"]))
def count_distinct_per_column(t: Tables):
    return A.distinct_counts(part_nulls(t))


@query("category_distribution", " union all ".join(
    f"select '{c}' as \"column\", {c} as value, count(*) as n from {NULL_ORDERS} group by {c}"
    for c in ["o_orderstatus", "o_orderpriority"]))
def category_distribution(t: Tables):
    return A.value_counts(null_text(t.orders), ["o_orderstatus", "o_orderpriority"])


@query("mode_value", """select o_custkey as mode, count(*) as n from orders group by o_custkey
    order by n desc, mode limit 1""")
def mode_value(t: Tables):
    return A.mode(t.orders, "o_custkey")


@query("mean_trunc", """select cast(trunc(avg(p_retailprice)) as integer) as price,
    cast(trunc(avg(case when p_partkey % 7 = 0 then null else p_size end)) as integer) as size from part""")
def mean_trunc(t: Tables):
    size = F.when(F.col("p_partkey") % 7 == 0, None).otherwise(F.col("p_size"))
    return t.part.agg(F.avg("p_retailprice").cast("int").alias("price"),
                      F.avg(size).cast("int").alias("size"))


DESCRIBE = """select '{name}' as source, count(x) as count, round(avg(x), 4) as mean,
    round(stddev_samp(x), 4) as std, min(x) as min, round(quantile_cont(x, 0.25), 6) as q25,
    round(quantile_cont(x, 0.5), 6) as q50, round(quantile_cont(x, 0.75), 6) as q75, max(x) as max
    from (select o_totalprice as x from {source})"""


@query("describe_column", DESCRIBE.format(name="train", source=NULL_ORDERS) + " union all "
       + DESCRIBE.format(name="test", source="orders"))
def describe_column(t: Tables):
    both = A.describe(null_price(t.orders), "o_totalprice", "train").unionByName(
        A.describe(t.orders, "o_totalprice", "test"))
    return both.select("source", "count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"),
                       "min", *[F.round(q, 6).alias(q) for q in ["q25", "q50", "q75"]], "max")


def edge_list(n, column):
    return f"quantile_cont({column}, [" + ", ".join(f"{i / n!r}" for i in range(1, n)) + "])"


@query("bucket_summary", f"""with e as (select {edge_list(10, 'l_extendedprice')} as edges from lineitem),
    b as (select l_extendedprice as x, cast(len(list_filter(edges, lambda v: v < l_extendedprice))
    as integer) as bucket from lineitem, e) select i::integer as bucket, min(x) as min_value,
    max(x) as max_value, count(x) as num_records from range(10) r(i) left join b on bucket = i group by i""")
def bucket_summary(t: Tables):
    edges = B.quantile_edges(t.lineitem, {"l_extendedprice": 10})["l_extendedprice"]
    return B.bucket_summary(t.lineitem, "l_extendedprice", B.bucket_code("l_extendedprice", edges), 10)


@query("null_counts", f"""select 'o_totalprice' as "column", count(*) as n from {NULL_ORDERS}
    where o_totalprice is null union all select 'o_orderpriority', count(*) from {NULL_ORDERS}
    where o_orderpriority is null""")
def null_counts(t: Tables):
    return A.null_counts(null_text(null_price(t.orders)))


@query("percentiles", """select unnest([2.5, 25, 50, 75, 97.5])::double as pct, round(unnest(quantile_cont(
    l_extendedprice, [0.025, 0.25, 0.5, 0.75, 0.975])), 6) as price, unnest(quantile_cont(l_quantity,
    [0.025, 0.25, 0.5, 0.75, 0.975])) as quantity from lineitem""")
def percentiles(t: Tables):
    shares = [0.025, 0.25, 0.5, 0.75, 0.975]
    found = quantiles(t.lineitem, {"l_extendedprice": shares, "l_quantity": shares})
    rows = [(p * 100, round(a, 6), b)
            for p, a, b in zip(shares, found["l_extendedprice"], found["l_quantity"])]
    return t.spark.createDataFrame(rows, "pct double, price double, quantity double")


@query("correlation_matrix", " union all ".join(
    f"select '{a}' as c1, '{b}' as c2, round(corr({a}, {b}), 6) as r from lineitem"
    for a in LINE_NUMBERS for b in LINE_NUMBERS))
def correlation_matrix(t: Tables):
    return A.correlations(t.lineitem, LINE_NUMBERS).select("c1", "c2", F.round("r", 6).alias("r"))


@query("drop_duplicates_keep", """select user_id, min(event_id) as first_id, arg_min(event_type, event_id)
    as first_type, max(event_id) as last_id, arg_max(event_type, event_id) as last_type
    from events group by user_id""")
def drop_duplicates_keep(t: Tables):
    events = t.events.select("user_id", "event_id", "event_type")
    first, last = (A.keep_one(events, "user_id", "event_id", keep).select(
        "user_id", F.col("event_id").alias(f"{keep}_id"), F.col("event_type").alias(f"{keep}_type"))
        for keep in ("first", "last"))
    return first.join(last, "user_id")


@query("row_sum", """select user_id, count(*) filter (where hour(ts) between 5 and 9) as h_morning,
    count(*) as h_all from events group by user_id""")
def row_sum(t: Tables):
    hours = A.counts_by_category(t.events, "user_id", F.hour("ts"), HOURS, "h")
    return hours.select("user_id", S.row_total([f"h{h}" for h in range(5, 10)]).alias("h_morning"),
                        S.row_total([f"h{h}" for h in HOURS]).alias("h_all"))


LINE_HOLES = """(select l_orderkey, l_linenumber, case when l_orderkey % 7 = 0 then null else l_quantity end
    as a, l_discount as b, case when l_orderkey % 11 = 0 then null else l_tax end as c from lineitem)"""


def line_holes(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 7 == 0, None).otherwise(F.col("l_quantity")).alias("a"),
        F.col("l_discount").alias("b"),
        F.when(F.col("l_orderkey") % 11 == 0, None).otherwise(F.col("l_tax")).alias("c"))


@query("row_mean", f"""select l_orderkey, l_linenumber, round(list_avg([a, b, c]), 6) as mean
    from {LINE_HOLES}""")
def row_mean(t: Tables):
    return line_holes(t).select("l_orderkey", "l_linenumber",
                                F.round(S.row_mean(["a", "b", "c"]), 6).alias("mean"))


@query("row_median", f"""select l_orderkey, l_linenumber, round(list_median([a, b, c]), 6) as median
    from {LINE_HOLES}""")
def row_median(t: Tables):
    return line_holes(t).select("l_orderkey", "l_linenumber",
                                F.round(S.row_median(["a", "b", "c"]), 6).alias("median"))


@query("row_normalize", "select user_id, " + ", ".join(
    f"round_even(count(*) filter (where event_type = '{k}') / count(*) * 100, 0) / 100 as share_{k}"
    for k in ["click", "purchase", "view"]) +
    " from events where event_type in ('click', 'purchase', 'view') group by user_id")
def row_normalize(t: Tables):
    kinds = ["click", "purchase", "view"]
    counts = A.counts_by_category(t.events.where(F.col("event_type").isin(kinds)), "user_id",
                                  F.col("event_type"), kinds, "share_")
    names = [f"share_{k}" for k in kinds]
    shares = counts.select("user_id", *A.normalise_row(names, suffix=""))
    return shares.select("user_id", *[S.round_half_even(c, 2).alias(c) for c in names])
