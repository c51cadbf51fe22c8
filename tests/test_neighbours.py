"""Nearest neighbours by pivot cells against all distances."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import neighbours as N


def frames(spark, train, queries):
    def frame(x):
        return spark.createDataFrame([(i, [float(v) for v in r], i % 7) for i, r in enumerate(x)], "id bigint, v array<double>, c int").repartition(3)
    return frame(train), frame(queries)


def plain(train, queries, k):
    out = {}
    for i, q in enumerate(queries):
        d = np.sqrt(((train - q) ** 2).sum(axis=1))
        order = sorted(range(len(train)), key=lambda j: (d[j], j))[:k]
        out[i] = [(j, round(float(d[j]), 9), j % 7) for j in order]
    return out


def got(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query, r.distance, r.neighbour)):
        out.setdefault(r.query, []).append((r.neighbour, round(r.distance, 9), r.carry))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_equal_to_all_distances(spark, monkeypatch, small):
    if small:  # several parts of a cell and blocks of queries
        monkeypatch.setattr(N, "PART", 20)
        monkeypatch.setattr(N, "QUERIES", 9)
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(12, 6)) * 20
    train = centres[draw.integers(0, 12, 700)] + draw.normal(size=(700, 6))
    queries = centres[draw.integers(0, 12, 90)] + draw.normal(size=(90, 6))
    t, q = frames(spark, train, queries)
    found, counts = N.pivot_search(t, q, "id", "v", "c", 5, 6, pivots=26)
    assert got(found) == plain(train, queries, 5)
    assert counts["pairs"] == 700 * 90 and counts["compared"] < 0.5 * counts["pairs"]  # cells far away are never looked at


def test_one_cell(spark):
    draw = np.random.default_rng(8)
    train, queries = draw.normal(size=(200, 3)), draw.normal(size=(40, 3))
    t, q = frames(spark, train, queries)
    found, counts = N.pivot_search(t, q, "id", "v", "c", 3, 3)
    assert got(found) == plain(train, queries, 3) and counts["compared"] == counts["pairs"] == 8000


def test_ties_and_copies(spark):
    grid = np.array([[a, b] for a in range(8) for b in range(8)] * 3, float)  # every vector three times
    t, q = frames(spark, grid, grid[:64] + [0.5, 0.0])
    found, _ = N.pivot_search(t, q, "id", "v", "c", 4, 2, pivots=9)
    assert got(found) == plain(grid, grid[:64] + [0.5, 0.0], 4)


def test_small_inputs(spark):
    t, q = frames(spark, np.zeros((3, 2)), np.ones((2, 2)))
    found, _ = N.pivot_search(t, q, "id", "v", "c", 5, 2)
    assert {k: len(v) for k, v in got(found).items()} == {0: 3, 1: 3}  # fewer rows than wanted
    assert N.pivot_search(t.where("false"), q, "id", "v", "c", 5, 2)[0].count() == 0
    assert N.pivot_search(t, q.where("false"), "id", "v", "c", 5, 2)[0].count() == 0
    gaps = t.withColumn("v", F.when(F.col("id") > 0, F.col("v")))
    assert N.pivot_search(gaps, q, "id", "v", "c", 5, 2)[0].count() == 4


def test_queries_stay_on_the_executors(spark, monkeypatch):
    """Only pivots and counts by cell come to the driver."""
    draw = np.random.default_rng(6)
    t, q = frames(spark, draw.normal(size=(300, 3)), draw.normal(size=(200, 3)))
    seen = []
    collect = type(q).collect
    monkeypatch.setattr(type(q), "collect", lambda self: seen.append(len(rows := collect(self))) or rows)
    N.pivot_search(t, q, "id", "v", "c", 3, 3, pivots=8)
    assert seen and max(seen) <= 32


def test_copies_do_not_fill_memory():
    """Pairs of copies are compared again some at a time, not with all their vectors copied at once."""
    import tracemalloc

    copies = np.tile(np.arange(64.0), (1_000, 1))
    tracemalloc.start()
    assert N.distances(copies, copies).max() == 0
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6


def test_same_with_few_distances_at_once(spark, monkeypatch):
    """Batches, blocks and open cells are worked on in slices; copies make more ties than a slice has places."""
    monkeypatch.setattr(N, "CELLS", 60)
    draw = np.random.default_rng(4)
    train, queries = np.repeat(draw.normal(size=(100, 6)), 8, axis=0), draw.normal(size=(50, 6))
    t, q = frames(spark, train, queries)
    found, counts = N.pivot_search(t, q, "id", "v", "c", 5, 6, pivots=20)
    assert got(found) == plain(train, queries, 5) and counts["compared"] > 0.5 * counts["pairs"]
