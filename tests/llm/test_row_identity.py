"""Repeated and null ids, clashing column names, ties and missing labels."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import chats, decontamination, near_copies, toxicity

A = " ".join(f"alpha{i}" for i in range(60))
B = " ".join(f"beta{i}" for i in range(60))
NEAR_B = B + " more"
ITEM = "Which of the rivers in the north crosses the old border twice before it meets the sea? It is the Arn."


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("_gone", "_id", "_mark", "id", "mark", "text_")})


@pytest.mark.parametrize("order", list(itertools.permutations([(1, A), (1, B), (4, NEAR_B)])))
def test_repeated_ids_lose_no_link(spark, order):
    got = sorted((r.id, r.component_id, r.kept) for r in near_copies.near_copies(frame(spark, list(order)).coalesce(1), 3, 85).collect())
    assert got == [(1, 1, True), (1, 1, True), (4, 1, False)]
    kept = near_copies.without_copies(frame(spark, list(order)), 3, 85)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, A), (1, B)]


def test_only_copies_go(spark):
    rows = [(1, A), (1, B), (1, A), (2, A), (None, A), (None, A), (3, ""), (3, None), (5, NEAR_B), (0, NEAR_B + " again")]
    kept = near_copies.without_copies(frame(spark, rows), 3, 85)
    assert kept.columns == frame(spark, rows).columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(str, [(1, A), (None, A), (None, A), (3, ""), (3, None), (0, NEAR_B + " again")]))


def test_many_unlike_texts_under_one_id(spark):
    texts = [" ".join(f"t{k}w{i}" for i in range(30)) for k in range(40)]
    rows = [(7, t) for t in texts] + [(9, t + " end") for t in texts[:5]]
    got = near_copies.near_copies(frame(spark, rows), 3, 85).collect()
    assert sum(r.kept for r in got) == 40 and {r.component_id for r in got} == {7}
    assert near_copies.without_copies(frame(spark, rows), 3, 85).count() == 40


def test_clean_rows_under_a_contaminated_id_stay(spark):
    rows = [(1, f"{A} {ITEM} {B}"), (1, A), (None, ITEM), (None, B), (2, None), (2, ITEM)]
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    left = decontamination.clean(frame(spark, rows), bench)
    assert left.columns == frame(spark, rows).columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in left.collect()))) == sorted(map(str, [(1, A), (None, B), (2, None)]))


def test_turns_of_one_number_are_ordered_as_given(spark):
    turns = spark.createDataFrame([(1, 0, "user", "<|"), (1, 0, "user", "<a"), (1, 0, "user", "<\\|")], "conv_id bigint, turn int, role string, text string")
    read = chats.read_back(chats.format_chats(turns)).first()
    assert [t.text for t in read.turns] == sorted(["<|", "<a", "<\\|"])


def test_missing_labels_are_not_learned_from():
    rng = np.random.default_rng(3)
    usual, bad = rng.integers(1, 1 << 60, 300).astype(np.uint64), rng.integers(1, 1 << 60, 6).astype(np.uint64)
    words = []
    for k in range(240):
        own = rng.choice(usual, 40, replace=False)
        words.append(np.unique(np.concatenate([own, bad])) if k % 4 == 0 else np.unique(own))
    toxic = np.array([1.0 if k % 4 == 0 else 0.0 for k in range(240)])
    quality = np.ones(240)
    hidden = toxic.copy()
    hidden[100:] = np.nan  # toxic texts among them
    some = toxicity.fit_rows(np.arange(240), hidden, quality, words)
    alone = toxicity.fit_rows(np.arange(100), toxic[:100], quality[:100], words[:100])
    at = some.categories.index("toxic")
    assert set(some.features.tolist()) == set(alone.features.tolist())
    assert np.allclose(some.weights[at], alone.weights[at], atol=0.05)
