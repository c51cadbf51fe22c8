"""Order statistics, running totals and numbering against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import ordered as O


@pytest.fixture(scope="module")
def values():
    draw = random.Random(3)
    # one value holds a third of the rows
    return [5.0 if i % 3 == 0 else round(draw.expovariate(0.1), 3) for i in range(5000)]


@pytest.fixture(scope="module")
def frame(spark, values):
    rows = [(i, v, f"g{i % 4}", int(v)) for i, v in enumerate(values)] + [(-1, None, "g0", None)]
    return spark.createDataFrame(rows, "id bigint, x double, g string, k bigint").repartition(7)


@pytest.mark.parametrize("direct", [10, 50_000])
@pytest.mark.parametrize("exact", [5, 2_000_000])
def test_quantiles_equal_numpy(frame, values, monkeypatch, direct, exact):
    monkeypatch.setattr(O, "DIRECT_LIMIT", direct)
    monkeypatch.setattr(O, "EXACT_LIMIT", exact)
    shares = [0.0, 0.025, 0.3, 0.5, 0.77, 1.0]
    found = O.quantiles(frame, {"x": shares, "k": [0.5]})
    assert np.allclose(found["x"], np.quantile(values, shares), rtol=0, atol=1e-12)
    assert found["k"] == [float(np.median([int(v) for v in values]))]


def test_order_statistics_all_null(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert O.order_statistics(empty, {"x": lambda n: [0]})["x"] == (0, [])
    assert O.medians(empty, ["x"]) == {"x": None}


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(frame, values, descending):
    counts = frame.where("x is not null").groupBy("g", "x").agg(F.count("*").alias("n"))
    rows = O.running_totals(counts, "x", ["n"], by=["g"], descending=descending).collect()
    for row in rows:
        same = [v for i, v in enumerate(values) if f"g{i % 4}" == row["g"]]
        assert row["n_before"] == sum((v > row["x"]) if descending else (v < row["x"]) for v in same)


@pytest.mark.parametrize("order", ["id", "text", "day"])
def test_numbers_are_contiguous(spark, order):
    df = spark.range(1000).select(
        "id", F.md5(F.col("id").cast("string")).alias("text"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    rows = O.number_rows(df, order, "n", start=1).orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(1, 1001))
    assert [r[order] for r in rows] == sorted(r[order] for r in rows)


def test_numbers_restart_per_group(frame):
    rows = O.number_rows(frame, "id", "n", by=["g"]).collect()
    for g in ("g0", "g1", "g2", "g3"):
        mine = sorted((r["id"], r["n"]) for r in rows if r["g"] == g)
        assert [n for _, n in mine] == list(range(len(mine)))


def test_no_single_partition_sort_of_raw_rows(frame):
    """The only exchanges to one partition carry per-range totals."""
    plan = O.number_rows(frame, "id", "n")._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert "BatchEvalPython" not in physical
    for part in physical.split("SinglePartition")[1:]:
        assert "HashAggregate" in part[:600]
