"""Queries: projections, schema operations, filters."""

from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.functions.hashing import hash_fraction
from millrace.operators import relational as R
from millrace.operators.ordered import number_rows
from millrace.suite.registry import Tables, query

SPLIT = "(cast('0x' || substr(md5({key}::varchar || ':720'), 1, 8) as bigint) / 4294967296.0)"


def null_price(orders):
    """Orders with a price missing on every seventh key."""
    return orders.withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, None).otherwise(F.col("o_totalprice")))


def null_text(orders):
    return orders.withColumn(
        "o_orderpriority",
        F.when(F.col("o_orderkey") % 11 == 0, None).otherwise(F.col("o_orderpriority")))


NULL_ORDERS = """(select o_orderkey, o_custkey, o_orderstatus, o_orderdate,
    case when o_orderkey % 7 = 0 then null else o_totalprice end as o_totalprice,
    case when o_orderkey % 11 = 0 then null else o_orderpriority end as o_orderpriority
    from orders)"""


@query("project_reorder", "select o_orderdate, o_orderkey, o_totalprice, o_custkey from orders")
def project_reorder(t: Tables):
    return t.orders.select("o_orderdate", "o_orderkey", "o_totalprice", "o_custkey")


@query("drop_columns", "select o_orderkey, o_custkey, o_orderdate, o_totalprice from orders")
def drop_columns(t: Tables):
    return t.orders.drop("o_orderstatus", "o_orderpriority")


@query("rename_columns", """select o_orderkey as order_id, o_custkey as customer_id,
    o_totalprice as price, o_orderstatus, o_orderdate, o_orderpriority from orders""")
def rename_columns(t: Tables):
    return t.orders.withColumnsRenamed(
        {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_totalprice": "price"})


@query("columns_difference", "select c_acctbal, c_mktsegment, c_nationkey from customer")
def columns_difference(t: Tables):
    customer = t.customer
    return customer.select(*R.columns_difference(customer, ["c_custkey", "c_name"]))


@query("select_by_dtype", "select p_partkey, p_size, p_retailprice from part")
def select_by_dtype(t: Tables):
    part = t.part
    return part.select(*R.columns_of(part, "numeric"))


@query("dedupe_column_names", "select o_orderkey, o_totalprice, o_custkey from orders")
def dedupe_column_names(t: Tables):
    repeated = t.orders.select("o_orderkey", "o_totalprice", "o_orderkey", "o_custkey", "o_totalprice")
    return R.first_of_repeated_columns(repeated)


@query("filter_predicate", f"""select o_orderkey, o_totalprice, o_orderpriority
    from {NULL_ORDERS} where o_orderstatus = 'F' and o_totalprice >= 1000
    and o_orderpriority is not null""")
def filter_predicate(t: Tables):
    orders = null_text(null_price(t.orders))
    return orders.where(
        (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") >= 1000)
        & F.col("o_orderpriority").isNotNull()
    ).select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("filter_not_in_list", """select * from (select l_orderkey, l_linenumber,
    case when l_orderkey % 7 = 0 then null else l_quantity end as l_quantity from lineitem)
    where l_quantity is null or l_quantity not in (46, 48)""")
def filter_not_in_list(t: Tables):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 7 == 0, None).otherwise(F.col("l_quantity")).alias("l_quantity"))
    return R.drop_listed(rows, "l_quantity", [46.0, 48.0])


@query("drop_null_rows", f"""select o_orderkey, o_totalprice, o_orderpriority from {NULL_ORDERS}
    where o_totalprice is not null and o_orderpriority is not null""")
def drop_null_rows(t: Tables):
    orders = null_text(null_price(t.orders)).select("o_orderkey", "o_totalprice", "o_orderpriority")
    return orders.na.drop(subset=["o_totalprice", "o_orderpriority"])


@query("case_when_tiers", """select l_orderkey, l_linenumber, case when x <= 1 then 0 when x <= 2 then 1
    when x <= 3 then 2 when x > 3 then 3 end as tier from (select *, case when l_orderkey % 7 = 0
    then null else l_quantity / 10 end as x from lineitem)""")
def case_when_tiers(t: Tables):
    ratio = F.when(F.col("l_orderkey") % 7 == 0, None).otherwise(F.col("l_quantity") / 10)
    return t.lineitem.select("l_orderkey", "l_linenumber", S.tier_code(ratio).alias("tier"))


@query("flag_in_set", """select o_orderkey, case when o_orderpriority in ('1-URGENT', '2-HIGH')
    then 1 else 0 end as is_pressing from """ + NULL_ORDERS)
def flag_in_set(t: Tables):
    return null_text(t.orders).select(
        "o_orderkey", S.in_set_flag("o_orderpriority", ["1-URGENT", "2-HIGH"]).alias("is_pressing"))


@query("snap_near_zero", """select l_orderkey, l_linenumber,
    case when round_even(l_discount / 4000 * 100000, 0) = 0 then 0 else l_discount / 4000 end as snapped
    from lineitem""")
def snap_near_zero(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", S.snap_near_zero(F.col("l_discount") / 4000).alias("snapped"))


@query("add_row_id", """select o_orderkey, row_number() over (order by o_orderkey) as row_id
    from orders""")
def add_row_id(t: Tables):
    return number_rows(t.orders.select("o_orderkey"), "o_orderkey", "row_id", start=1)


@query("tag_source_split", f"""select o_orderkey, o_totalprice,
    {SPLIT.format(key='o_orderkey')} < 0.6 as is_train from orders""")
def tag_source_split(t: Tables):
    part = hash_fraction("o_orderkey", 720) < 0.6
    columns = ["o_orderkey", "o_totalprice"]
    train, test = t.orders.where(part).select(*columns), t.orders.where(~part).select(*columns)
    stacked = R.stack_sources(train, test)
    again_train, again_test = stacked.where("is_train"), stacked.where("not is_train")
    return again_train.unionByName(again_test)


@query("cast_columns", """select cast(l_linenumber as tinyint) as line_byte,
    cast(l_quantity as integer) as quantity_int, cast(l_orderkey as varchar) as order_text,
    cast(l_partkey as double) as part_double from lineitem""")
def cast_columns(t: Tables):
    return t.lineitem.select(
        F.col("l_linenumber").cast("byte").alias("line_byte"),
        F.col("l_quantity").cast("int").alias("quantity_int"),
        F.col("l_orderkey").cast("string").alias("order_text"),
        F.col("l_partkey").cast("double").alias("part_double"))
