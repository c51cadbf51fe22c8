"""Frames that cost work are computed once, and sums of a pivot are spread over enough tasks."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates as A, selection as X
from millrace.plans import claims, response
from millrace.suite import blending, flows
from millrace.suite.learning import FEATURES
from millrace.operators import models as M


def counted(spark, df, column):
    """The frame with a column that counts, in an accumulator, how many rows were computed."""
    seen = spark.sparkContext.accumulator(0)

    def same(value):
        seen.add(1)
        return value

    passed = F.udf(same, df.schema[column].dataType).asNondeterministic()
    return df.withColumn(column, passed(column)), seen


def rows_of(spark, n=120):
    return spark.range(n).select(
        F.col("id").alias("ID"), (F.col("id") % 2).cast("int").alias("target"), (F.col("id") * 7 % 31).cast("double").alias("a"),
        F.when(F.col("id") % 5 != 0, F.concat(F.lit("v"), F.col("id") % 3)).alias("text"), F.concat(F.lit("w"), F.col("id") % 4).alias("other"), F.lit("x").alias("same"))


@pytest.mark.parametrize("prepare", [
    lambda a, b: response.coded(a, b, "ID"), lambda a, b: claims.encoded(a, b, "ID", "target", 10),
    lambda a, b: claims.filtered(a, b, "ID", "target", 0.99), lambda a, b: claims.unscaled(a, b, "ID", "target", "ID")])
def test_plans_compute_their_inputs_once(spark, prepare):
    rows = rows_of(spark)
    train, n = counted(spark, rows.where("ID < 80"), "a")
    test, m = counted(spark, rows.where("ID >= 80").drop("target"), "a")
    ready, rest = prepare(train, test)
    assert (ready.count(), rest.count()) == (80, 40)
    assert (n.value, m.value) == (80, 40)


def test_halves_are_computed_once(spark):
    rows, n = counted(spark, rows_of(spark), "a")
    train, test = flows.stored_halves(rows, "ID", "target")
    want = [df.collect() for df in flows.halves(rows_of(spark), "ID", "target")]
    assert sorted(train.collect()) == sorted(want[0]) and sorted(test.select(*want[1][0].__fields__).collect()) == sorted(want[1])
    assert n.value == 120


def test_blend_computes_its_rows_once(spark, monkeypatch):
    plain = spark.range(200).select(F.col("id").alias("o_orderkey"), (F.col("id") % 2).cast("double").alias("label"),
                                    *[(F.col("id") * (i + 3) % 17).cast("double").alias(c) for i, c in enumerate(FEATURES)])
    rows, n = counted(spark, plain, "label")
    monkeypatch.setattr(blending, "matrix", lambda t: M.assemble(rows, FEATURES, ["o_orderkey", "label"]))
    assert blending.choose_single_or_blend(None).count() > 0
    assert n.value == 200


def test_pivot_tasks_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(A, "PIVOT_ROWS", 50)
    rows = spark.range(1_000).select((F.col("id") % 90).alias("k"), F.when(F.col("id") % 11 != 0, F.concat(F.lit("c"), F.col("id") % 3)).alias("c"), F.col("id").cast("double").alias("v"))
    wide = A.pivot_sum(rows, ["k"], "c", {"c0": "a", "c1": "b"}, "v")
    assert wide.rdd.getNumPartitions() == 20
    want = {}
    for r in rows.collect():
        line = want.setdefault(r.k, [0.0, 0.0])
        if r.c in ("c0", "c1"):
            line[int(r.c[1])] += r.v
    assert {r.k: [r.a, r.b] for r in wide.collect()} == want


def test_columns_that_vary_late_are_not_constant(spark, monkeypatch):
    monkeypatch.setattr(X, "FIRST_ROWS", 3)
    rows = spark.createDataFrame([(1, "x", None, 0.0, {"k": 1}, None, 5)] * 6 + [(1, "y", None, -0.0, {"k": 2}, "z", 5)],
                                 "a int, b string, c string, d double, e map<string, int>, f string, g int")
    assert X.constant_columns(rows) == ["a", "c", "g"]
    assert X.constant_columns(rows.where("false")) == []
