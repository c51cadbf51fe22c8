"""Queries: splits, samples and folds."""

from pyspark.sql import functions as F

from millrace.functions.hashing import hash_fraction
from millrace.operators import sampling as S
from millrace.suite.projections import SPLIT
from millrace.suite.registry import Tables, query


@query("train_test_split", f"""select o_orderkey, o_totalprice, {SPLIT.format(key='o_orderkey')} < 0.6
    as is_train from orders""")
def train_test_split(t: Tables):
    train, test = S.split_by_fraction(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 0.6, 720)
    return train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))


def random_rank(key, partition=""):
    over = f"partition by {partition} " if partition else ""
    return f"row_number() over ({over}order by md5({key}::varchar || ':720'))"


@query("sample_fixed_n", f"""select o_orderkey, {random_rank('o_orderkey')} <= 1000 as is_validation
    from orders""")
def sample_fixed_n(t: Tables):
    orders = t.orders.select("o_orderkey")
    chosen = S.sample_exact(orders, "o_orderkey", 1000, 720)
    rest = orders.join(chosen, "o_orderkey", "left_anti")
    return chosen.withColumn("is_validation", F.lit(True)).unionByName(
        rest.withColumn("is_validation", F.lit(False)))


@query("sample_percent", f"""select o_orderkey, o_totalprice from orders qualify
    {random_rank('o_orderkey')} <= (select count(*) // 100 * 5 from orders)""")
def sample_percent(t: Tables):
    return S.sample_percent(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 5, 720)


@query("stratified_shuffle_split", f"""select doc_id, quality, {random_rank('doc_id', 'quality')}
    <= floor(0.3::double * count(*) over (partition by quality)) as is_test from labels""")
def stratified_shuffle_split(t: Tables):
    return S.stratified_split(t.labels.select("doc_id", "quality"), "doc_id", "quality", 0.3, 720)


@query("stratified_kfold", f"""select doc_id, quality, (({random_rank('doc_id', 'quality')} - 1) % 5)::integer
    as fold from labels""")
def stratified_kfold(t: Tables):
    return S.stratified_folds(t.labels.select("doc_id", "quality"), "doc_id", "quality", 5, 720)


@query("undersample_majority", f"""select doc_id, toxic from labels qualify {random_rank('doc_id', 'toxic')}
    <= (select min(n) from (select count(*) as n from labels group by toxic))""")
def undersample_majority(t: Tables):
    return S.undersample(t.labels.select("doc_id", "toxic"), "doc_id", "toxic", 720)


@query("shuffle_rows", f"select o_orderkey, {random_rank('o_orderkey')} - 1 as position from orders")
def shuffle_rows(t: Tables):
    return S.random_positions(t.orders.select("o_orderkey"), "o_orderkey", 720, "position")
