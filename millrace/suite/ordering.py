"""Queries: windows, sorts, top-k, set operations."""

from pyspark.sql import functions as F

from millrace.functions.hashing import hash_fraction
from millrace.operators import relational as R
from millrace.operators import windows as W
from millrace.operators.ordered import order_statistics
from millrace.suite.projections import SPLIT
from millrace.suite.registry import Tables, query


@query("lag_difference", """select x, round_even((x - lag(x) over (order by x)) * 1e8, 0) / 1e8 as gap
    from (select distinct o_totalprice as x from orders)""")
def lag_difference(t: Tables):
    prices = t.orders.select(F.col("o_totalprice").alias("x"))
    return W.value_gaps(prices, "x").select("x", W.round_half_even("gap", 8).alias("gap"))


STEPS = """(select step, count(*) as n from (select round_even((x - lag(x) over (order by x)) * 1e8, 0) / 1e8
    as step from (select distinct round_even({column} * 1e8, 0) / 1e8 as x from {table}))
    where step > 0.000001 group by step order by n desc, step limit 1)"""


@query("find_scale_denominator", "select 'o_totalprice' as \"column\", step, n from "
       + STEPS.format(column="o_totalprice", table="orders"))
def find_scale_denominator(t: Tables):
    return W.scale_steps(t.orders, ["o_totalprice"])


SCALED = [("l_quantity", 0.0371), ("l_discount", 0.5)]


@query("undo_feature_scaling", "select l_orderkey, l_linenumber, " + ", ".join(
    f"round(case when round_even({c} * {f} * 1e5, 0) / 1e5 = 0 then 0 else {c} * {f}::double end "
    f"* (1 / (select step from {STEPS.format(column=f'({c} * {f}::double)', table='lineitem')})), 6) as {c}"
    for c, f in SCALED) + " from lineitem")
def undo_feature_scaling(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", *[(F.col(c) * f).alias(c) for c, f in SCALED])
    names = [c for c, _ in SCALED]
    steps = {row["column"]: row["step"] for row in W.scale_steps(rows, names).collect()}
    return W.undo_scaling(rows, steps).select(
        "l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in names])


@query("rank_scores", """select cast(row_number() over (order by mean desc, l_suppkey) as integer) as rank,
    l_suppkey, round(mean, 6) as mean, round(std, 6) as std from (select l_suppkey, avg(l_discount) as mean,
    stddev_pop(l_discount) as std from lineitem group by l_suppkey) order by mean desc, l_suppkey limit 5""")
def rank_scores(t: Tables):
    top = W.rank_scores(t.lineitem, "l_suppkey", "l_discount", 5)
    return top.select("rank", "l_suppkey", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("nth_smallest_largest", """with s as (select list_sort(list(s_acctbal)) as v from supplier)
    select i::integer as n, v[least(i, len(v))] as smallest, v[len(v) + 1 - least(i, len(v))] as largest
    from s, (select unnest([1, 2, 3, 1000000]) as i)""")
def nth_smallest_largest(t: Tables):
    sizes = [1, 2, 3, 1000000]
    n, values = order_statistics(t.supplier, {"s_acctbal": lambda count: [
        r for k in sizes for r in (min(k, count) - 1, count - min(k, count))]})["s_acctbal"]
    rows = [(k, values[2 * i], values[2 * i + 1]) for i, k in enumerate(sizes)]
    return t.spark.createDataFrame(rows, "n int, smallest double, largest double")


@query("order_statistic", """with s as (select list_sort(list(o_totalprice)) as v, count(*) as n from orders)
    select k::bigint as k, v[k + 1] as value from s, (select unnest([0, floor(0.05 * n), n - 1 -
    floor(0.05 * n), n - 1])::bigint as k from s)""")
def order_statistic(t: Tables):
    places = {}

    def ranks(n):
        places["k"] = [0, int(0.05 * n), n - 1 - int(0.05 * n), n - 1]
        return places["k"]

    _, values = order_statistics(t.orders, {"o_totalprice": ranks})["o_totalprice"]
    return t.spark.createDataFrame(list(zip(places["k"], values)), "k bigint, value double")


@query("sort_rows", "select o_orderkey, o_totalprice from orders order by o_orderkey")
def sort_rows(t: Tables):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey")


@query("top_n", """select p_partkey, p_retailprice from part
    order by p_retailprice desc, p_partkey limit 15""")
def top_n(t: Tables):
    return t.part.select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(15)


@query("argmin_pick", """select arg_min(s_suppkey, s_acctbal) as best, min(s_acctbal) as loss,
    arg_max(s_suppkey, s_acctbal) as worst, max(s_acctbal) as top from supplier""")
def argmin_pick(t: Tables):
    return t.supplier.agg(
        F.min_by("s_suppkey", "s_acctbal").alias("best"), F.min("s_acctbal").alias("loss"),
        F.max_by("s_suppkey", "s_acctbal").alias("worst"), F.max("s_acctbal").alias("top"))


@query("union_rows", """select c_name as name, c_acctbal as balance, c_mktsegment from customer
    union all select s_name, s_acctbal, null from supplier""")
def union_rows(t: Tables):
    customer = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
                                 "c_mktsegment")
    supplier = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return customer.unionByName(supplier, allowMissingColumns=True)


@query("union_distinct_levels", "select c_nationkey as level from customer union select s_nationkey from supplier")
def union_distinct_levels(t: Tables):
    return (t.customer.select(F.col("c_nationkey").alias("level"))
            .union(t.supplier.select("s_nationkey")).distinct())


@query("except_values", """select c_custkey from customer except
    select o_custkey from orders where o_totalprice > 300000""")
def except_values(t: Tables):
    return t.customer.select("c_custkey").subtract(
        t.orders.where("o_totalprice > 300000").select("o_custkey"))


@query("sequence_gaps", """select unnest(range(min(o_custkey), max(o_custkey) + 1)) as o_custkey
    from orders where o_totalprice > 400000 except select o_custkey from orders where o_totalprice > 400000""")
def sequence_gaps(t: Tables):
    return R.gaps_in_sequence(t.orders.where("o_totalprice > 400000"), "o_custkey")


@query("intersect_values", f"""select o_custkey from orders where {SPLIT.format(key='o_orderkey')} < 0.3
    intersect select c_custkey from customer where c_acctbal > 0""")
def intersect_values(t: Tables):
    return (t.orders.where(hash_fraction("o_orderkey", 720) < 0.3).select("o_custkey")
            .intersect(t.customer.where("c_acctbal > 0").select("c_custkey")))
