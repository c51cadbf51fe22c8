"""Small hand-computed cases: ties, nulls, constants, unseen levels, one row."""

import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import aggregates as A, binning as B, cleaning as C, encoding as E
from millrace.operators import relational as R, selection as X, sparse as P, windows as W
from millrace.plans import devices, trips


@pytest.fixture(scope="module")
def ties(spark):
    values = [1.0, 1.0, 1.0, 2.0, 2.0, 3.0, 4.0, 5.0, 100.0, None]
    return spark.createDataFrame(list(enumerate(values)), "id bigint, x double")


def column(df, name, order="id"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_quantile_edges_must_differ(ties):
    with pytest.raises(ValueError, match="unique"):
        B.quantile_edges(ties, {"x": 9})


def test_buckets_are_right_closed_and_keep_null(ties):
    edges = B.quantile_edges(ties, {"x": 2})["x"]
    assert edges == [1.0, 2.0, 100.0]
    assert column(ties.withColumn("b", B.bucket_code("x", edges)), "b") == [0, 0, 0, 0, 0, 1, 1, 1, 1, None]


def test_buckets_of_test_rows_use_train_edges(spark, ties):
    other = spark.createDataFrame([(0, -5.0), (1, 1000.0), (2, None)], "id bigint, x double")
    train, test = B.split_into_buckets(ties, other, "x", 2)
    assert train.columns == test.columns == ["id", "x_bucket_0", "x_bucket_1"]
    assert [tuple(r) for r in test.orderBy("id").collect()] == [(0, 1, 0), (1, 0, 1), (2, 0, 0)]


def test_empty_buckets_stay_in_the_summary(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (9.0, 2)], "x double, b int")
    rows = [tuple(r) for r in B.bucket_summary(df, "x", F.col("b"), 4).orderBy("bucket").collect()]
    assert rows == [(0, 1.0, 2.0, 2), (1, None, None, 0), (2, 9.0, 9.0, 1), (3, None, None, 0)]


def test_winsorize(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(40)] + [(99, None)], "id bigint, x double")
    got = column(C.winsorize(df, ["x"], 0.05), "x")
    assert got == [2.0, 2.0, *map(float, range(2, 38)), 37.0, 37.0, None]


def test_outliers_with_no_spread(spark):
    df = spark.createDataFrame([(i, 7.0) for i in range(9)] + [(9, 8.0)], "id bigint, x double")
    assert column(df.withColumn("f", C.mad_outlier(df, "x")), "f") == [False] * 9 + [True]


def test_outlier_votes_need_all_three(ties):
    known = ties.where("x is not null")
    rows = C.outlier_votes(known, "x").orderBy("id").collect()
    assert rows[-1]["votes"] == 3 and rows[-1]["is_outlier"]
    assert not any(r["is_outlier"] for r in rows[:-1])


def test_minmax_of_a_constant_and_back(spark):
    df = spark.createDataFrame([(0, 7.0, 10.0), (1, 7.0, 30.0), (2, 7.0, 20.0)], "id bigint, a double, b double")
    model = C.MinMaxModel.fit(df, ["a", "b"])
    scaled = model.transform(df)
    assert column(scaled, "a") == [0.0, 0.0, 0.0]
    assert column(scaled, "b") == [0.0, 1.0, 0.5]
    assert column(scaled.withColumn("c", model.inverse(F.col("b"), "b")), "c") == [10, 30, 20]


def test_mixed_imputer_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(0, 1.0, "b"), (1, None, "a"), (2, 3.0, None), (3, 2.0, "b")],
                               "id bigint, x double, s string")
    model = C.MixedImputer(inputCols=["x", "s"]).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = C.MixedImputerModel.load(str(tmp_path / "m")).transform(df)
    assert column(again, "x") == [1.0, 2.0, 3.0, 2.0]
    assert column(again, "s") == ["b", "a", "b", "b"]


def test_fill_by_regression_keeps_known(spark):
    rows = [(i, float(i % 5), None if i % 4 == 0 else float(10 * (i % 5))) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, a double, y double")
    model = C.fit_column_regressor(df, "y", ["a"], trees=5, depth=4, seed=1)
    out = C.fill_by_regression(df, model, "y").collect()
    assert all(r["y_Imputed"] is not None for r in out)
    assert all(r["y_Imputed"] == r["y"] for r in out if r["y"] is not None)


def test_onehot_null_and_unseen(spark):
    train = spark.createDataFrame([(0, "b"), (1, "a"), (2, None)], "id bigint, c string")
    test = spark.createDataFrame([(0, "z"), (1, "a")], "id bigint, c string")
    model = E.OneHotModel.fit(train, ["c"])
    assert model.transform(train).columns == model.transform(test).columns == ["id", "c_a", "c_b"]
    assert [tuple(r) for r in model.transform(test).orderBy("id").collect()] == [(0, 0, 0), (1, 1, 0)]
    assert len(E.OneHotModel.fit(train, ["c"], drop_one_seed=1).transform(train).columns) == 2


def test_codes(spark, monkeypatch):
    train = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, None)], "id bigint, c string")
    test = spark.createDataFrame([(0, "a"), (1, "z"), (2, None)], "id bigint, c string")
    for limit in (0, 20_000):
        monkeypatch.setattr(E, "SMALL_LEVELS", limit)
        by_name, by_time = E.sorted_levels(train, "c"), E.first_seen_levels(train, "c", "id")
        assert column(E.encode(train, by_name, "c", "n"), "n") == [1, 0, 1, None]
        assert column(E.encode(test, by_time, "c", "n", unseen=-1), "n") == [1, -1, -1]
    with pytest.raises(PySparkException, match="unseen value"):
        E.encode(test, by_name, "c", "n").collect()


def test_constant_and_rare_columns(spark):
    rows = [(i, 7, None, 1 if i == 0 else 0, i % 10) for i in range(100)]
    df = spark.createDataFrame(rows, "id bigint, a int, b string, c int, d int")
    assert X.constant_columns(df) == ["a", "b"]
    flags = {r["column"]: (r["freq_ratio"], r["nzv"]) for r in
             X.near_zero_variance(df, ["a", "c", "d"]).collect()}
    assert flags == {"a": (0.0, True), "c": (99.0, True), "d": (1.0, False)}


def test_highly_correlated():
    matrix = np.array([[1.0, 0.95, 0.1, 0.2], [0.95, 1.0, 0.3, 0.4], [0.1, 0.3, 1.0, 0.0], [0.2, 0.4, 0.0, 1.0]])
    assert X.highly_correlated(matrix, list("abcd"), 0.9) == ["b"]
    assert X.highly_correlated(matrix, list("abcd"), 0.99) == []


def test_scale_steps(spark):
    rows = [(i, 0.0371 * k + 1e-10, 0.5 * k) for i, k in enumerate([0, 1, 2, 3, 5, 8, 9, 3, 2])]
    df = spark.createDataFrame(rows, "id bigint, x double, y double")
    steps = {r["column"]: r["step"] for r in W.scale_steps(df, ["x", "y"]).collect()}
    assert steps == {"x": pytest.approx(0.0371, abs=1e-8), "y": 0.5}
    assert [round(v, 4) for v in column(W.undo_scaling(df, steps), "y")] == [0, 1, 2, 3, 5, 8, 9, 3, 2]


def test_gaps_cross_range_borders(spark):
    values = [1, 2, 4, 8, 16, 32, 64, 128, 256, 512]
    df = spark.createDataFrame([(float(v),) for v in values * 3], "x double")
    gaps = {r["x"]: r["gap"] for r in W.value_gaps(df, "x").collect()}
    assert gaps == {float(b): (float(b - a) if a else None) for a, b in zip([None, *values], values)}


def test_scalar_edges(spark):
    row = spark.range(1).select(
        S.letters_to_int(F.lit("AZ")).alias("az"), S.letters_to_int(F.lit("bca")).alias("bca"),
        S.years_since_month(F.lit(2014), F.lit(10)).alias("one"),
        S.years_since_month(F.lit(None).cast("int"), F.lit(1)).alias("none"),
        S.days_since_year_week(F.lit(2015), F.lit(39)).alias("days"),
        S.days_since_year_week(F.lit(2015), F.lit(None).cast("int")).alias("no_days"),
        S.round_half_even(F.lit(0.125), 2).alias("even"),
        S.row_median([F.lit(3.0), F.lit(None).cast("double"), F.lit(1.0)]).alias("median"),
        S.row_mean([F.lit(None).cast("double")]).alias("nothing"),
        S.zero_padded("Prod", F.lit(7), 4).alias("short"), S.zero_padded("Prod", F.lit(123456), 4).alias("long"),
    ).first()
    assert (row["az"], row["bca"]) == (52, 1431)
    assert (row["one"], row["none"]) == (1.0, -1.0)
    # Monday of Sunday-based week 39 of 2015 is 28 September
    assert (row["days"], row["no_days"]) == (3, -1)
    assert (row["even"], row["median"], row["nothing"]) == (0.12, 2.0, None)
    assert (row["short"], row["long"]) == ("Prod0007", "Prod123456")
    assert S.bucket_name("Num OCLL1.0") == "numocll1_bucket"


def test_join_text_in_blocks(spark):
    df = spark.createDataFrame([(1, i, f"w{i}") for i in range(7)] + [(2, 0, "x")], "k int, o bigint, v string")
    rows = {(r["k"], r["block"]): r["text"] for r in A.join_text(df, "k", "v", "o", block=3).collect()}
    assert rows == {(1, 0): "w0 w1 w2", (1, 1): "w3 w4 w5", (1, 2): "w6", (2, 0): "x"}


def test_hot_split_join_keeps_every_row(spark):
    fact = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None)
                                    .otherwise(F.col("id") % 900).alias("k"))
    dim = spark.range(0, 900, 2).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    fact = fact.withColumn("k", F.col("k").cast("int"))
    assert R.hot_keys(fact, ["k"], 0.1) == [(0,)]
    for how in ("left", "inner"):
        split = R.hot_split_join(fact, dim, ["k"], how, share=0.1)
        plain = fact.join(dim, ["k"], how)
        assert split.exceptAll(plain.select(split.columns)).count() == 0
        assert split.count() == plain.count()


def test_merge_and_complete(spark):
    runs = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.7), (2, 1, 0.1)], "id int, run int, p double")
    assert [tuple(r) for r in R.merge_runs(runs, "id", "run", "p", [1, 2]).collect()] == [(1, 0.5, 0.7)]
    scores = spark.createDataFrame([(2, 0.9)], "id int, p double")
    template = spark.createDataFrame([(1, 0.5), (2, 0.5), (3, 0.5)], "id int, p double")
    assert [tuple(r) for r in R.complete_keys(scores, template, "id").collect()] == [(1, 0.5), (2, 0.9), (3, 0.5)]


def test_repeated_columns_and_row_totals(spark):
    df = spark.range(1).select(F.lit(1).alias("a"), F.lit(2).alias("b"), F.lit(3).alias("a"))
    assert R.first_of_repeated_columns(df).first().asDict() == {"a": 1, "b": 2}
    empty = spark.createDataFrame([(0, 0), (1, 3)], "a int, b int").select(*A.normalise_row(["a", "b"]))
    assert sorted(tuple(r) for r in empty.collect() if r[0] is not None) == [(0.25, 0.75)]


def test_day_parts(spark):
    times = ["00:00:00", "04:59:00", "05:00:00", "13:59:00", "14:00:00", "21:59:00", "22:00:00", "23:59:00"]
    df = spark.createDataFrame([("d", f"2024-01-01 {x}") for x in times], "device string, t string").select(
        "device", F.col("t").cast("timestamp_ntz").alias("t"))
    row = devices.events_day_spread(df, "device", "t").first().asDict()
    assert row == {"device": "d", "h_morning": 0.12, "h_midday": 0.12, "h_afternoon": 0.12, "h_evening": 0.12,
                   "h_night": 0.38, "h_nightowl": 0.12}
    assert {k: v for k, v in devices.profiles(df, "device", "t").first().asDict().items() if k in row} == row


def test_departments_keep_gaps_and_returns(spark):
    df = spark.createDataFrame([(1, "Monday", "a", 2), (1, "Monday", "a", -3), (1, "Monday", "c", 1),
                                (2, "Friday", "c", 4)], "visit int, day string, dept string, scans int")
    wide = trips.department_table(df, "visit", "day", "dept", "scans", ["a", "b", "c"])
    assert [tuple(r) for r in wide.collect()] == [(1, 1, -1, 0, 1), (2, 0, 0, 0, 4)]
    with pytest.raises(PySparkException, match="unknown department"):
        trips.department_table(df, "visit", "day", "dept", "scans", ["a", "b"]).collect()


def test_product_vectors(spark):
    train = spark.createDataFrame([(1, 7), (1, 7), (1, None), (2, 12345)], "visit int, product bigint")
    test = spark.createDataFrame([(9, 8)], "visit int, product bigint")
    (left, right), size = trips.product_vectors(train, test, "visit", "product")
    assert size == 4  # Prod0007, Prod0008, Prod12345, Prod999999
    assert {r["visit"]: r["features"].toArray().tolist() for r in left.collect()} == {
        1: [2.0, 0.0, 0.0, 1.0], 2: [0.0, 0.0, 1.0, 0.0]}
    assert right.first()["features"].toArray().tolist() == [0.0, 1.0, 0.0, 0.0]


def test_token_vectors_are_binary(spark):
    tokens = spark.createDataFrame([(1, ["a", "b"]), (2, ["b"])], "k int, tokens array<string>")
    vectors = P.fit_token_vectors(tokens).transform(tokens).collect()
    assert sorted(v["features"].numNonzeros() for v in vectors) == [1, 2]
    assert all(set(v["features"].values) == {1.0} for v in vectors)


def test_anova_against_definition(spark):
    draw = np.random.default_rng(5)
    x, y = draw.normal(size=(60, 3)), np.arange(60) % 3
    x[:, 1] += y
    df = spark.createDataFrame([(int(c), [float(v) for v in r]) for r, c in zip(x, y)], "y int, v array<double>")
    got = {r["feature"]: r["f"] for r in X.anova_scores(df, "v", "y").collect()}
    for j in range(3):
        groups = [x[y == k, j] for k in range(3)]
        between = sum(len(g) * (g.mean() - x[:, j].mean()) ** 2 for g in groups) / 2
        within = sum(((g - g.mean()) ** 2).sum() for g in groups) / 57
        assert math.isclose(got[j], between / within, rel_tol=1e-9)
    assert X.select_percentile(X.anova_scores(df, "v", "y"), 34) == [1]
