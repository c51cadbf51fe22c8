"""Sparse ANOVA, factors of groups and very wide tables against plain versions."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.operators import aggregates as A, models as L, selection as X, sparse as P


def test_anova_of_sparse_rows_equals_dense(spark):
    draw = np.random.default_rng(2)
    x = draw.normal(size=(300, 9)) * (draw.random((300, 9)) < 0.3)
    x[:, 8] = 0
    y = draw.integers(0, 4, 300)
    x[:, 1] += 2 * (y == 1)
    rows = []
    for i in range(300):
        v = Vectors.dense(x[i]) if i % 3 else Vectors.sparse(9, [(j, float(x[i, j])) for j in range(9) if x[i, j]])
        rows.append((i, v, x[i].tolist(), int(y[i])))
    df = spark.createDataFrame(rows, ["id", "s", "d", "y"])
    want = {}
    for j in range(8):
        groups = [x[y == k, j] for k in range(4)]
        b = sum(len(g) * (g.mean() - x[:, j].mean()) ** 2 for g in groups) / 3
        w = sum(((g - g.mean()) ** 2).sum() for g in groups) / 296
        want[j] = b / w
    for column in ("s", "d"):
        got = {r["feature"]: r["f"] for r in X.anova_scores(df, column, "y").collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[j], want[j], rel_tol=1e-9) for j in want)
    assert X.select_percentile(X.anova_scores(df, "s", "y"), 12) == [1]


def test_anova_of_blocks(spark):
    """Triples, the sparse vectors made of them and the dense form agree."""
    triples = spark.createDataFrame([(i, c, 1.0) for i in range(200) for c in ((i * 7) % 5, 5 + (i * i) % 11, 16 + i % 3)], "key bigint, col int, n double")
    y = F.col("key") % 3
    vectors = P.sparse_vectors(triples, "key", 19).withColumn("y", y)
    dense = vectors.select("y", L.vector_to_array("features").alias("features"))
    forms = [X.anova_scores(vectors, "features", "y"), X.anova_scores(dense, "features", "y"),
             X.anova_of_cells(triples.select(y.alias("class"), F.col("col").alias("feature"), F.col("n").alias("v")),
                              vectors.groupBy(F.col("y").alias("class")).agg(F.count("*").alias("n")))]
    one, two, three = ({r["feature"]: r["f"] and round(r["f"], 9) for r in f.collect()} for f in forms)
    assert one == two == three and one[16] is None and len(one) > 10  # column 16 tells the class, no spread inside


def test_factors_keep_the_digits_of_nearly_collinear_groups(spark):
    draw = np.random.default_rng(7)
    rows, want = [], {}
    for g in range(6):
        a = draw.normal(size=400)
        x = np.column_stack([a, a + 1e-8 * draw.normal(size=400), draw.normal(size=400)])
        y = 3 + x @ [1.0, 2.0, -1.0] + 1e-9 * draw.normal(size=400)
        assert 1e7 < np.linalg.cond(x) < 1e9
        want[g] = np.linalg.lstsq(np.column_stack([np.ones(400), x]), y, rcond=None)[0]
        rows += [(g, *map(float, r), float(v)) for r, v in zip(x, y)]
    df = spark.createDataFrame(rows, "g int, a double, b double, c double, y double").repartition(9)
    got = {r["g"]: [r["intercept"], *r["coefficients"]] for r in L.fit_group_ols(df, "g", ["a", "b", "c"], F.col("y")).collect()}
    for g in want:
        assert np.allclose(got[g], want[g], atol=2e-3) and abs(got[g][1] + got[g][2] - 3) < 1e-6
        x = np.array([r[1:4] for r in rows if r[0] == g])
        y = np.array([r[4] for r in rows if r[0] == g])
        # sums of products lose the difference of the two columns altogether
        c = x - x.mean(axis=0)
        normal = np.linalg.lstsq(c.T @ c, c.T @ (y - y.mean()), rcond=None)[0]
        assert np.abs(normal - want[g][1:]).max() > 100 * np.abs(np.array(got[g][1:]) - want[g][1:]).max()


def test_factors_in_small_parts(spark, monkeypatch):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").cast("double").alias("a"), (F.col("id") * F.col("id") % 13).cast("double").alias("b"))
    one = L.fit_group_ols(df, "g", ["a", "b"], F.col("a") * 2 - F.col("b") + 5).orderBy("g").collect()
    monkeypatch.setattr(L, "FACTOR_ROWS", 1)
    two = L.fit_group_ols(df.repartition(4), "g", ["a", "b"], F.col("a") * 2 - F.col("b") + 5).orderBy("g").collect()
    for x, y in zip(one, two):
        assert x["n"] == y["n"] and np.allclose(x["coefficients"], [2, -1]) and np.allclose(y["coefficients"], [2, -1]) and math.isclose(y["intercept"], 5, abs_tol=1e-8)


@pytest.mark.parametrize("batch", [1_000_000, 12_000])
def test_five_thousand_columns(spark, monkeypatch, batch, tmp_path):
    monkeypatch.setattr(A, "WIDE_CELLS", batch)
    long = spark.range(20_000).select((F.col("id") % 61).alias("visit"), F.when(F.col("id") % 97 > 0, F.col("id") * 7919 % 5003).alias("code"), (F.col("id") % 5).alias("v"))
    names = {c: f"Prod{c:04d}" for c in range(5000)}  # codes 5000 to 5002 and null have no column
    A.wide_sums(long, "visit", "code", names, F.col("v")).write.parquet(str(tmp_path / "wide"))
    wide = spark.read.parquet(str(tmp_path / "wide"))
    assert len(wide.columns) == 5001
    assert A.pivot_sum(long.limit(50), ["visit"], "code", names, "v").columns == wide.columns
    rows = wide.toPandas().set_index("visit")
    sparse = long.where("code < 5000").groupBy("visit", "code").agg(F.sum("v").alias("s")).where("s <> 0").collect()
    cells = {(r["visit"], r["code"]): float(r["s"]) for r in sparse}
    values = rows.to_numpy()
    found = {(int(rows.index[i]), int(j)): float(values[i, j]) for i, j in zip(*np.nonzero(values))}
    assert found == cells and len(rows) == 61
