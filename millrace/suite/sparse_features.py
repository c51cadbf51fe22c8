"""Queries: device profiles, the device dimension, bags of items, sparse blocks, store features."""

from pyspark.sql import functions as F

from millrace.functions.hashing import hash_fraction
from millrace.operators import selection as X
from millrace.operators import sparse as P
from millrace.plans import devices as D
from millrace.plans import sales as L
from millrace.suite.projections import SPLIT
from millrace.session import cut_lineage
from millrace.suite.registry import Tables, query

HOURS = list(range(24))
PER_HOUR = ", ".join(f"count(*) filter (where hour(ts) = {h}) as h{h}" for h in HOURS)
PER_HOUR_SHARE = ", ".join(f"count(*) filter (where hour(ts) = {h}) / count(*) as h{h}_n" for h in HOURS)
SPREAD = ", ".join(
    f"round_even(count(*) filter (where hour(ts) in ({', '.join(map(str, hours))})) / count(*) * 100, 0) / 100"
    f" as {name}" for name, hours in D.DAY_PARTS.items())


@query("events_per_hour", f"select user_id, {PER_HOUR}, {PER_HOUR_SHARE} from events group by user_id")
def events_per_hour(t: Tables):
    return D.events_per_hour(t.events, "user_id", "ts")


@query("events_day_spread", f"select user_id, {SPREAD} from events group by user_id")
def events_day_spread(t: Tables):
    return D.events_day_spread(t.events, "user_id", "ts")


def device_rows(t: Tables):
    """Every device twice, so the first row has to be picked."""
    return t.part.select((F.floor(F.col("p_partkey") / 2)).alias("device_id"), "p_partkey", "p_brand", "p_type")


def brand_map(t: Tables):
    """The hand-kept brand table: foreign are the brands whose number ends in 5."""
    return t.part.select("p_brand").distinct().withColumn("is_foreign_brand", F.col("p_brand").endswith("5"))


def dimension(t: Tables):
    return D.device_dimension(device_rows(t), brand_map(t), "device_id", "p_partkey", "p_brand", "p_type")


DIMENSION = """(with d as (select p_partkey // 2 as device_id, arg_min(p_brand, p_partkey) as brand,
    arg_min(p_type, p_partkey) as model from part group by p_partkey // 2),
    b as (select p_brand as brand, row_number() over (order by p_brand) - 1 as phone_brand_id
          from (select distinct p_brand from part))
    select device_id, phone_brand_id, dense_rank() over (order by brand || model) - 1 as device_model_id,
    brand like '%5' as is_foreign_brand from d join b using (brand))"""


@query("device_dimension", f"select * from {DIMENSION}")
def device_dimension(t: Tables):
    return dimension(t)


SHARES_BY_DEVICE = ", ".join(f"coalesce(h{h}_n, 0) as h{h}_n" for h in HOURS)
SPREAD_BY_DEVICE = ", ".join(f"coalesce({name}, 0) as {name}" for name in D.DAY_PARTS)


@query("device_training_set", f"""with e as (select user_id as device_id, {PER_HOUR_SHARE}, {SPREAD}
    from events group by user_id), d as {DIMENSION}
    select c_custkey as device_id, c_mktsegment as "group", {SPLIT.format(key='c_custkey')} < 0.6 as is_train,
    {SHARES_BY_DEVICE}, {SPREAD_BY_DEVICE}, coalesce(phone_brand_id, -1) as phone_brand_id,
    coalesce(device_model_id, -1) as device_model_id, coalesce(is_foreign_brand::integer, -1) as is_foreign_brand
    from customer left join e on c_custkey = e.device_id left join d on c_custkey = d.device_id""")
def device_training_set(t: Tables):
    people = t.customer.select(F.col("c_custkey").alias("device_id"), F.col("c_mktsegment").alias("group"),
                               (hash_fraction("c_custkey", 720) < 0.6).alias("is_train"))
    events = t.events.withColumnRenamed("user_id", "device_id")
    return D.training_set(people, events, dimension(t), "device_id", "ts")


def people(t: Tables):
    return t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("phone_brand"),
                             F.col("c_nationkey").cast("string").alias("device_model"))


def event_apps(t: Tables):
    """Apps used by an event: its ``props.k`` number."""
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("app_id"))


def app_labels(t: Tables):
    return t.part.select((F.col("p_partkey") % 100).alias("app_id"), F.col("p_type").alias("label_id")).distinct()


PEOPLE = """people as (select c_custkey as user_id, c_mktsegment as phone_brand, c_nationkey::varchar
    as device_model from customer)"""
DEVICE_APPS = """apps as (select distinct user_id, (props->>'$.k')::bigint as app_id from events),
    labels as (select distinct p_partkey % 100 as app_id, p_type as label_id from part)"""


@query("bag_of_items", f"""with {PEOPLE}, {DEVICE_APPS}, tokens as (
    select user_id, 'phone_brand:' || phone_brand as token from people union
    select user_id, 'device_model:' || device_model from people union
    select user_id, 'label:' || label_id from apps join labels using (app_id) semi join people using (user_id))
    select user_id, string_agg(token, ' ' order by token) as tokens, count(*)::integer as n
    from tokens group by user_id""")
def bag_of_items(t: Tables):
    tokens = D.device_tokens(people(t), t.events, event_apps(t), app_labels(t), "user_id", "event_id",
                             "app_id", "label_id", ["phone_brand", "device_model"])
    return tokens.select("user_id", F.array_join("tokens", " ").alias("tokens"), F.size("tokens").alias("n"))


@query("feature_triples_sparse", f"""with {PEOPLE}, tokens as (
    select user_id, 'phone_brand:' || phone_brand as feature from people union all
    select user_id, 'device_model:' || device_model from people union all
    select distinct user_id, 'app_id:' || (props->>'$.k') from events),
    r as (select user_id, row_number() over (order by user_id) - 1 as row from (select distinct user_id from tokens)),
    c as (select feature, row_number() over (order by feature) - 1 as col
          from (select distinct feature from tokens))
    select user_id, row, col, count(*) as n from tokens join r using (user_id) join c using (feature)
    group by user_id, row, col""")
def feature_triples_sparse(t: Tables):
    owners = people(t)
    device_apps = (event_apps(t).join(t.events.select("event_id", "user_id"), "event_id")
                   .select("user_id", "app_id").distinct())
    tokens = P.stack_tokens([(owners, "phone_brand", "phone_brand"), (owners, "device_model", "device_model"),
                             (device_apps, "app_id", "app_id")], "user_id")
    return P.index_triples(tokens, "user_id")


BLOCKS_SQL = f"""with {PEOPLE}, {DEVICE_APPS},
    brands as (select phone_brand as v, row_number() over (order by v) - 1 as code from
        (select distinct phone_brand from people)),
    models as (select v, row_number() over (order by v) - 1 as code from
        (select distinct phone_brand || device_model as v from people)),
    app_ids as (select app_id as v, row_number() over (order by v) - 1 as code from
        (select distinct app_id from apps)),
    used as (select * from labels semi join apps using (app_id)),
    label_ids as (select label_id as v, row_number() over (order by v) - 1 as code from
        (select distinct label_id from used)),
    pairs as (select user_id, 'brand' as block, code, 0 as start from people join brands on v = phone_brand
      union select user_id, 'model', code, (select count(*) from brands) from people
            join models on v = phone_brand || device_model
      union select user_id, 'app', code, (select count(*) from brands) + (select count(*) from models)
            from apps semi join people using (user_id) join app_ids on v = app_id
      union select user_id, 'label', code, (select count(*) from brands) + (select count(*) from models)
            + (select count(*) from app_ids) from apps semi join people using (user_id)
            join used using (app_id) join label_ids on v = label_id)
    select user_id, block, code + start as col from pairs"""


@query("sparse_block_stack", BLOCKS_SQL)
def sparse_block_stack(t: Tables):
    return D.sparse_blocks(people(t), t.events, event_apps(t), app_labels(t), "user_id", "event_id",
                           "app_id", "label_id", "phone_brand", "device_model")


@query("select_percentile_anova_sparse", f"""with b as ({BLOCKS_SQL}), y as (select distinct user_id, user_id % 4 as class from events),
    n as (select class, count(*) as n from y group by class),
    p as (select col, class, count(*)::double as s from b join y using (user_id) group by all),
    x as (select col, sum(s) as s, sum(s * s / n) as b from p join n using (class) group by col),
    f as (select col, ((b - s * s / (select sum(n) from n)) / 3) / nullif((s - b) / ((select sum(n) from n) - 4), 0) as f from x)
    select col, round(f, 6) as f, coalesce(f > (select quantile_cont(f, 0.77) from f), false) as selected from f""")
def select_percentile_anova_sparse(t: Tables):
    """Scores of the columns of the sparse blocks; only their ones are summed."""
    blocks = sparse_block_stack(t)
    labels = t.events.select("user_id").distinct().withColumn("class", F.col("user_id") % 4)
    cells = blocks.join(labels, "user_id").select("class", F.col("col").alias("feature"), F.lit(1.0).alias("v"))
    scores = cut_lineage(X.anova_of_cells(cells, labels.groupBy("class").agg(F.count("*").alias("n"))))
    selected = t.spark.createDataFrame([(c,) for c in X.select_percentile(scores, 23)], "feature bigint").withColumn("_s", F.lit(True))
    joined = scores.join(selected, "feature", "left")
    return joined.select(F.col("feature").alias("col"), F.round("f", 6).alias("f"), F.coalesce("_s", F.lit(False)).alias("selected"))


def store_table(t: Tables):
    """Store attributes from customers, with gaps on every seventh key."""
    gap = F.col("c_custkey") % 7 == 0
    return t.customer.select(
        F.col("c_custkey").alias("Store"), F.col("c_mktsegment").alias("StoreType"),
        F.substring("c_mktsegment", 1, 1).alias("Assortment"),
        F.when(gap, None).otherwise(F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))).alias("PromoInterval"),
        F.when(gap, None).otherwise(F.abs("c_acctbal")).alias("CompetitionDistance"),
        F.when(gap, None).otherwise(2000 + F.col("c_custkey") % 15).alias("CompetitionOpenSinceYear"),
        (1 + F.col("c_custkey") % 12).alias("CompetitionOpenSinceMonth"),
        F.when(gap, None).otherwise(2009 + F.col("c_custkey") % 7).alias("Promo2SinceYear"),
        (1 + F.col("c_custkey") % 50).alias("Promo2SinceWeek"))


def sales_table(t: Tables):
    """Sales rows from orders: closed where the status is P."""
    return t.orders.select(
        F.col("o_orderkey").alias("Id"), F.col("o_custkey").alias("Store"),
        F.col("o_orderdate").cast("date").alias("Date"), F.col("o_totalprice").alias("Sales"),
        F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("Open"),
        F.lower("o_orderstatus").alias("StateHoliday"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("SchoolHoliday"))


SALES_SQL = """with s as (select c_custkey as Store, c_mktsegment as StoreType,
      substr(c_mktsegment, 1, 1) as Assortment, case when c_custkey % 7 = 0 then null else
      'N' || c_nationkey::varchar end as PromoInterval, case when c_custkey % 7 = 0 then null else
      abs(c_acctbal) end as CompetitionDistance, case when c_custkey % 7 = 0 then null
      else 2000 + c_custkey % 15 end as cy, 1 + c_custkey % 12 as cm, case when c_custkey % 7 = 0 then null
      else make_date(2009 + c_custkey % 7, 1, 1) end as py, 1 + c_custkey % 50 as pw from customer)
    select o_orderkey as Id, o_custkey as Store, o_totalprice as Sales, 1 as "Open",
      substr(o_orderpriority, 1, 1)::integer as SchoolHoliday, day(o_orderdate)::integer as Day,
      month(o_orderdate)::integer as Month, year(o_orderdate)::integer as Year,
      case when o_orderstatus = 'F' then 1 else 0 end as Is_StateHoliday,
      coalesce(CompetitionDistance, (select trunc(avg(CompetitionDistance)) from s)) as CompetitionDistance,
      round(case when cy is null then -1.0::double else 2015.75::double - (cy + (cm - 1) / 12.0::double) end, 6)
      as NumYearsSinceCompetitionOpened, coalesce(date_diff('day', py + cast((7 - dayofweek(py)) % 7 as integer)
      + cast((pw - 1) * 7 + 1 as integer), date '2015-10-01'), -1)::integer as DaysSincePromo2,
      st.code as StoreType, a.code as Assortment, coalesce(p.code, 0) as PromoInterval
    from orders join s on o_custkey = s.Store
    left join (select StoreType as v, row_number() over (order by v) as code from (select distinct StoreType
      from s)) st on st.v = s.StoreType
    left join (select Assortment as v, row_number() over (order by v) as code from (select distinct Assortment
      from s)) a on a.v = s.Assortment
    left join (select PromoInterval as v, row_number() over (order by v) as code from (select distinct
      PromoInterval from s where PromoInterval is not null)) p on p.v = s.PromoInterval
    where o_orderstatus <> 'P' and o_totalprice <> 0"""


@query("store_features", SALES_SQL)
def store_features(t: Tables):
    rows = L.sales_features(sales_table(t), store_table(t), holidays=["f"])
    return rows.withColumn("NumYearsSinceCompetitionOpened", F.round("NumYearsSinceCompetitionOpened", 6))
