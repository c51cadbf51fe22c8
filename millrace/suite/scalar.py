"""Queries: scalar functions."""

from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.sources.readers import spread
from millrace.suite.projections import NULL_ORDERS, null_price, null_text
from millrace.suite.registry import Tables, query


@query("hour_of_day", "select event_id, cast(hour(ts) as integer) as hour_of_day from events")
def hour_of_day(t: Tables):
    return t.events.select("event_id", F.hour("ts").alias("hour_of_day"))


@query("date_parts", """select o_orderkey, cast(day(o_orderdate) as integer) as day,
    cast(month(o_orderdate) as integer) as month, cast(year(o_orderdate) as integer) as year
    from orders""")
def date_parts(t: Tables):
    return t.orders.select("o_orderkey", F.dayofmonth("o_orderdate").alias("day"),
                           F.month("o_orderdate").alias("month"), F.year("o_orderdate").alias("year"))


@query("years_since_yearmon", """select o_orderkey, case when o_orderkey % 7 = 0 then -1.0::double else
    round(2015.75::double - (year(o_orderdate) + (month(o_orderdate) - 1) / 12.0::double), 6) end
    as years_open from orders""")
def years_since_yearmon(t: Tables):
    year = F.when(F.col("o_orderkey") % 7 == 0, None).otherwise(F.year("o_orderdate"))
    return t.orders.select(
        "o_orderkey", F.round(S.years_since_month(year, F.month("o_orderdate")), 6).alias("years_open"))


@query("days_since_year_week", """select o_orderkey, coalesce(cast(date_diff('day', new_year
      + cast((7 - dayofweek(new_year)) % 7 as integer) + cast((week - 1) * 7 + 1 as integer),
      date '2015-10-01') as integer), -1) as days_since
    from (select o_orderkey, case when o_orderkey % 7 = 0 then null else
          make_date(year(o_orderdate), 1, 1) end as new_year, o_custkey % 54 as week from orders)""")
def days_since_year_week(t: Tables):
    year = F.when(F.col("o_orderkey") % 7 == 0, None).otherwise(F.year("o_orderdate"))
    return t.orders.select(
        "o_orderkey", S.days_since_year_week(year, F.col("o_custkey") % 54).alias("days_since"))


@query("log1p_expm1", """select l_orderkey, l_linenumber, round(ln(l_extendedprice + 1), 6) as logged,
    round(exp(ln(l_extendedprice + 1)) - 1, 4) as back from lineitem""")
def log1p_expm1(t: Tables):
    logged = F.log1p("l_extendedprice")
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(logged, 6).alias("logged"),
                             F.round(F.expm1(logged), 4).alias("back"))


@query("round_columns", """select l_orderkey, l_linenumber, l_shipdate,
    round_even(l_quantity / 8 * 100, 0) / 100 as q,
    round_even(l_extendedprice / 16 * 100, 0) / 100 as price from lineitem""")
def round_columns(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate",
                             (F.col("l_quantity") / 8).alias("q"),
                             (F.col("l_extendedprice") / 16).alias("price"))
    return rows.withColumns({c: S.round_half_even(c, 2) for c, kind in rows.dtypes if kind == "double"})


@query("clip_probability", """select l_orderkey, l_linenumber,
    greatest(least(l_discount * 10, 1 - 1e-15::double), 1e-15::double) as p from lineitem""")
def clip_probability(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber",
                             S.clip_probability(F.col("l_discount") * 10).alias("p"))


@query("base26_to_int", """select n_nationkey, cast(list_sum(list_transform(range(1, len(w) + 1),
    lambda i: (ascii(substr(w, i, 1)) - 96) * power(26, len(w) - i))) as bigint) as code
    from (select n_nationkey, substr(regexp_replace(lower(n_name), '[^a-z]', '', 'g'), 1, 10) as w
          from nation)""")
def base26_to_int(t: Tables):
    # ten letters fit a 64-bit number
    word = F.substring(F.regexp_replace(F.lower("n_name"), "[^a-z]", ""), 1, 10)
    return t.nation.select("n_nationkey", S.letters_to_int(word).alias("code"))


@query("concat_key", """select p_partkey, case when p_partkey % 11 = 0 then null
    else p_brand || p_type end as brand_type from part""")
def concat_key(t: Tables):
    brand = F.when(F.col("p_partkey") % 11 == 0, None).otherwise(F.col("p_brand"))
    return t.part.select("p_partkey", S.concat_key(brand, "p_type").alias("brand_type"))


@query("prefix_token", """select p_partkey, 'p_brand:' || case when p_partkey % 11 = 0 then 'nan'
    else p_brand end as token from part""")
def prefix_token(t: Tables):
    brand = F.when(F.col("p_partkey") % 11 == 0, None).otherwise(F.col("p_brand"))
    return t.part.select("p_partkey", S.prefix_token("p_brand", brand).alias("token"))


@query("zero_pad_name", """select p_partkey, 'Prod' || case when p_partkey * 9 < 1000
    then lpad((p_partkey * 9)::varchar, 4, '0') else (p_partkey * 9)::varchar end as wide_name,
    'Dept' || case when p_size < 10 then '0' || p_size::varchar else p_size::varchar end as short_name
    from part""")
def zero_pad_name(t: Tables):
    return t.part.select("p_partkey", S.zero_padded("Prod", F.col("p_partkey") * 9, 4).alias("wide_name"),
                         S.zero_padded("Dept", "p_size", 2).alias("short_name"))


@query("bucket_col_name", """select p_partkey, replace(replace(lower(p_name || '_bucket'), ' ', ''),
    '.0', '') as bucket_name from part""")
def bucket_col_name(t: Tables):
    return t.part.select("p_partkey", S.bucket_name_of("p_name").alias("bucket_name"))


@query("split_explode_tokens", """select token, count(*) as n, count(distinct doc_id) as docs
    from (select doc_id, unnest(string_split(text, ' ')) as token from documents) group by token""")
def split_explode_tokens(t: Tables):
    tokens = spread(t.documents.select("doc_id", "text")).select("doc_id", F.explode(F.split("text", " ")).alias("token"))
    per_document = tokens.groupBy("token", "doc_id").agg(F.count("*").alias("k"))
    return per_document.groupBy("token").agg(F.sum("k").alias("n"), F.count("*").alias("docs"))


@query("tokenize_binary", r"""select doc_id,
    len(list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')))::integer as n_words
    from documents""")
def tokenize_binary(t: Tables):
    documents = spread(t.documents.select("doc_id", "text"))
    return documents.select("doc_id", F.size(S.word_set("text")).alias("n_words"))


@query("multiply_columns", """select l_orderkey, l_linenumber, l_extendedprice * l_quantity as price_x,
    l_tax * l_quantity as tax_x, l_discount * l_quantity as discount_x from lineitem""")
def multiply_columns(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", *[
        (F.col(c) * F.col("l_quantity")).alias(name)
        for c, name in [("l_extendedprice", "price_x"), ("l_tax", "tax_x"), ("l_discount", "discount_x")]])


@query("fill_constant", f"""select o_orderkey, coalesce(o_totalprice, -999) as o_totalprice,
    coalesce(o_orderpriority, 'Missing') as o_orderpriority from {NULL_ORDERS}""")
def fill_constant(t: Tables):
    orders = null_text(null_price(t.orders)).select("o_orderkey", "o_totalprice", "o_orderpriority")
    return orders.na.fill({"o_totalprice": -999.0, "o_orderpriority": "Missing"})
