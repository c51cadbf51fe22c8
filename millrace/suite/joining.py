"""Queries: joins."""

from pyspark.sql import functions as F

from millrace.operators import relational as R
from millrace.suite.registry import Tables, query


@query("join_left_natural", """select event_id, user_id, value, c_name, c_acctbal
    from events left join customer on user_id = c_custkey""")
def join_left_natural(t: Tables):
    events = t.events.select("event_id", "user_id", "value")
    customer = t.customer.select(F.col("c_custkey").alias("user_id"), "c_name", "c_acctbal")
    return R.natural_join(events, customer, "left")


@query("join_left_key", """select o_orderkey, o_custkey, o_totalprice, c_mktsegment, c_nationkey
    from orders left join customer on o_custkey = c_custkey""")
def join_left_key(t: Tables):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    customer = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    return R.hot_split_join(orders, customer, ["o_custkey"], "left")


@query("join_inner_natural", """select s_suppkey, s_name, s_acctbal, s_nationkey, n_name, n_regionkey
    from supplier join nation on s_nationkey = n_nationkey""")
def join_inner_natural(t: Tables):
    nation = t.nation.withColumnRenamed("n_nationkey", "s_nationkey")
    return R.natural_join(t.supplier, nation)


@query("join_inner_key", """select o_orderkey, o_orderpriority, quantity, lines from orders join
    (select l_orderkey, sum(l_quantity) as quantity, count(*) as lines from lineitem group by l_orderkey)
    on o_orderkey = l_orderkey""")
def join_inner_key(t: Tables):
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("quantity"), F.count("*").alias("lines"))
    return t.orders.select("o_orderkey", "o_orderpriority").join(per_order, "o_orderkey")


@query("join_on_index_suffix", """select a.o_orderkey, a.o_totalprice, a.o_orderstatus,
    b.o_totalprice as o_totalprice_y, b.o_orderpriority from orders a
    join (select o_orderkey, o_totalprice * 2 as o_totalprice, o_orderpriority from orders) b
    on a.o_orderkey = b.o_orderkey""")
def join_on_index_suffix(t: Tables):
    left = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    right = t.orders.select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"),
                            "o_orderpriority")
    return R.join_suffixed(left, right, ["o_orderkey"], ("", "_y"))


@query("concat_columns", """select l_orderkey, l_linenumber, l_quantity, l_extendedprice / l_quantity
    as unit_price, l_quantity * l_tax as tax_share from lineitem""")
def concat_columns(t: Tables):
    # columns derived from the same rows are added in one select, without a join
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity",
                             (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
                             (F.col("l_quantity") * F.col("l_tax")).alias("tax_share"))


@query("assign_by_index", """select l_orderkey, l_linenumber, case when l_returnflag = 'R'
    then l_quantity else 0 end as returned, case when l_returnflag = 'R' then l_extendedprice else 0 end
    as returned_value from lineitem""")
def assign_by_index(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice")
    return R.assign_where(
        rows, F.col("l_returnflag") == "R",
        {"returned": F.col("l_quantity"), "returned_value": F.col("l_extendedprice")}, default=0.0,
    ).select("l_orderkey", "l_linenumber", "returned", "returned_value")


@query("lookup_map", """select o_orderkey, c_acctbal as balance from orders left join
    (select * from customer where c_acctbal > 0) on o_custkey = c_custkey""")
def lookup_map(t: Tables):
    series = t.customer.where("c_acctbal > 0").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("balance"))
    return t.orders.select("o_orderkey", "o_custkey").join(series, "o_custkey", "left").drop("o_custkey")


@query("join_chain_left", """select l_orderkey, lines, o_custkey, c_mktsegment, n_name from
    (select l_orderkey, count(*) as lines from lineitem group by l_orderkey)
    left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey
    left join nation on c_nationkey = n_nationkey""")
def join_chain_left(t: Tables):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    customer = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    with_customer = R.hot_split_join(lines.join(orders, "l_orderkey", "left"), customer, ["o_custkey"])
    return with_customer.join(nation, "c_nationkey", "left").select(
        "l_orderkey", "lines", "o_custkey", "c_mktsegment", "n_name")


@query("join_semi", """select c_custkey, c_name from customer where c_custkey in
    (select o_custkey from orders where o_orderstatus = 'F')""")
def join_semi(t: Tables):
    wanted = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(wanted, "c_custkey", "left_semi")


@query("join_anti", """select c_custkey, c_name from customer where not exists
    (select 1 from orders where o_custkey = c_custkey and o_totalprice > 400000)""")
def join_anti(t: Tables):
    excluded = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(excluded, "c_custkey", "left_anti")


def prediction_runs(t: Tables):
    """Three runs of scores in long form; runs 2 and 3 each miss one kind of event."""
    score = F.col("value") / 500
    runs = [t.events.select("event_id", F.lit(1).alias("run"), score.alias("p")),
            t.events.where("event_type <> 'view'").select("event_id", F.lit(2).alias("run"),
                                                          (score * 0.5).alias("p")),
            t.events.where("event_type <> 'click'").select("event_id", F.lit(3).alias("run"),
                                                           (score * 0.25).alias("p"))]
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


RUNS = """(select event_id, 1 as run, value / 500 as p from events union all
    select event_id, 2, value / 500 * 0.5::double from events where event_type <> 'view' union all
    select event_id, 3, value / 500 * 0.25::double from events where event_type <> 'click')"""


@query("merge_prediction_runs", f"""with r as {RUNS} select event_id, a.p as p1, b.p as p2, c.p as p3
    from (select * from r where run = 1) a join (select * from r where run = 2) b using (event_id)
    join (select * from r where run = 3) c using (event_id)""")
def merge_prediction_runs(t: Tables):
    return R.merge_runs(prediction_runs(t), "event_id", "run", "p", [1, 2, 3])


@query("complete_missing_keys", """select c_custkey, coalesce(mean_price, 0) as mean_price from customer
    left join (select o_custkey, round(avg(o_totalprice), 6) as mean_price from orders
    where o_totalprice > 300000 group by o_custkey) on o_custkey = c_custkey""")
def complete_missing_keys(t: Tables):
    known = (t.orders.where("o_totalprice > 300000").groupBy(F.col("o_custkey").alias("c_custkey"))
             .agg(F.round(F.avg("o_totalprice"), 6).alias("mean_price")))
    template = t.customer.select("c_custkey", F.lit(0.0).alias("mean_price"))
    return R.complete_keys(known, template, "c_custkey")
