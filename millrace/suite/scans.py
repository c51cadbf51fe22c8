"""Queries: sources and sinks. Each writes a given table as files and reads them back."""

import io
import zipfile

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F, types as T

from millrace.session import scratch_folder
from millrace.sources import readers as R
from millrace.sources import sinks as K
from millrace.suite.joining import RUNS, prediction_runs
from millrace.suite.projections import NULL_ORDERS, null_price, null_text
from millrace.suite.registry import Tables, query

ORDER_SCHEMA = "o_orderkey bigint, o_totalprice double, o_orderpriority string"


def order_rows(t: Tables):
    return null_text(null_price(t.orders)).select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("scan_csv_gz", f"select o_orderkey, o_totalprice, o_orderpriority from {NULL_ORDERS}")
def scan_csv_gz(t: Tables):
    folder = scratch_folder(t.spark) + "/orders"
    K.write_csv(order_rows(t), folder)
    return R.read_csv(t.spark, folder, ORDER_SCHEMA, unsplittable=True)


@query("scan_csv_projected", """select event_id::varchar as event_id, ts, value > 100 as is_active from events""")
def scan_csv_projected(t: Tables):
    folder = scratch_folder(t.spark) + "/events"
    K.write_csv(t.events.withColumn("is_active", F.col("value") > 100).withColumn(
        "ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")), folder)
    schema = ("event_id string, ts timestamp_ntz, user_id string, event_type string, value double, "
              "props string, is_active boolean")
    return R.read_csv(t.spark, folder, schema, ["event_id", "ts", "is_active"],
                      timestamp_format="yyyy-MM-dd HH:mm:ss.SSSSSS")


@query("scan_csv_typed", """select o_orderkey::double as id, o_orderdate::date as day, o_orderpriority as name
    from orders""")
def scan_csv_typed(t: Tables):
    folder = scratch_folder(t.spark) + "/orders"
    K.write_csv(t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("day"),
                                F.col("o_orderpriority").alias("name")), folder)
    return R.read_typed_csv(t.spark, folder, ["id", "day", "name"], "nDc")


@query("scan_csv_zip", f"select o_orderkey, o_totalprice, o_orderpriority from {NULL_ORDERS}")
def scan_csv_zip(t: Tables):
    def pack(batches):
        for batch in batches:
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("part.csv", batch.to_csv(index=False))
            yield pd.DataFrame({"path": ["part.zip"], "content": [buffer.getvalue()]})

    packed = order_rows(t).mapInPandas(pack, "path string, content binary")
    return R.unzip_csv(packed, T.StructType.fromDDL(ORDER_SCHEMA))


@query("scan_tsv", f"select o_orderkey, o_totalprice, o_orderpriority from {NULL_ORDERS}")
def scan_tsv(t: Tables):
    folder = scratch_folder(t.spark) + "/orders"
    K.write_stage(order_rows(t), folder, "tsv")
    return R.read_tsv(t.spark, folder, ORDER_SCHEMA)


def write_runs(t: Tables) -> str:
    """The score files of three runs, one folder each."""
    folder = scratch_folder(t.spark)
    for run in (1, 2, 3):
        K.write_csv(prediction_runs(t).where(F.col("run") == run).select("event_id", "p"),
                    f"{folder}/run_{run}")
    return folder


@query("scan_glob_with_provenance", f"select run, count(*) as n, min(event_id) as first_id,"
       f" round(sum(p), 4) as total from {RUNS} group by run")
def scan_glob_with_provenance(t: Tables):
    rows = R.read_with_provenance(t.spark, write_runs(t) + "/run_*/part-*", "event_id bigint, p double")
    run = F.regexp_extract("file", r"/run_(\d+)/", 1).cast("int")
    return rows.groupBy(run.alias("run")).agg(
        F.count("*").alias("n"), F.min("event_id").alias("first_id"), F.round(F.sum("p"), 4).alias("total"))


@query("sink_csv_gz", "select o_orderkey, printf('%.9f', o_totalprice) as o_totalprice, o_orderpriority from orders")
def sink_csv_gz(t: Tables):
    folder = scratch_folder(t.spark) + "/orders"
    K.write_csv(t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority"), folder, float_format="%.9f",
                quoting="nonnumeric", order_by=["o_orderkey"])
    return R.read_csv(t.spark, folder, "o_orderkey bigint, o_totalprice string, o_orderpriority string")


@query("sink_tsv_stage", "select o_orderkey, o_totalprice, o_orderpriority from orders")
def sink_tsv_stage(t: Tables):
    folder = scratch_folder(t.spark) + "/stage"
    K.write_stage(t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority"), folder)
    return t.spark.read.parquet(folder)


@query("materialize_if_absent", """select o_custkey, count(*) as orders, 1 as builds from orders
    group by o_custkey""")
def materialize_if_absent(t: Tables):
    folder, builds = scratch_folder(t.spark) + "/per_customer", []

    def build():
        builds.append(1)
        return t.orders.groupBy("o_custkey").agg(F.count("*").alias("orders"))

    K.materialize(t.spark, folder, build)
    return K.materialize(t.spark, folder, build).withColumn("builds", F.lit(len(builds)))


@query("model_save_load", """select l_orderkey, l_linenumber, round(regr_slope(l_extendedprice, l_quantity) over ()
    * l_quantity + regr_intercept(l_extendedprice, l_quantity) over (), 2) as predicted from lineitem""")
def model_save_load(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    folder = scratch_folder(t.spark) + "/model"

    def fit():
        return Pipeline(stages=[
            VectorAssembler(inputCols=["l_quantity"], outputCol="features"),
            LinearRegression(labelCol="l_extendedprice", solver="normal", standardization=False)]).fit(lines)

    K.load_or_fit(t.spark, folder, fit)
    model = K.load_or_fit(t.spark, folder, lambda: (_ for _ in ()).throw(RuntimeError("was not stored")))
    return model.transform(lines).select("l_orderkey", "l_linenumber", F.round("prediction", 2).alias("predicted"))
