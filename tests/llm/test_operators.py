"""Each operator against a plain version, on edge cases and on the smallest tables."""

import random
import re
import textwrap
import time

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from brute import base_spans, edited, mixing_targets, near_components, sha, subsequence
from paths import SMALL
from pyspark.sql import functions as F

from millrace.llm import (arrays, chats, decontamination, fingerprints, languages, licenses, mixing, near_copies,
                          private_data, quality, queries, toxicity)

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "Ünder the quick tree " * 4000
EDGES = [
    (1, "", "en", "a", 0), (2, None, None, None, None), (3, "   \n\t", "en", "a", 5), (4, "one two", "en", "b", 7),
    (5, "one two", "en", "b", 7), (5, "one two", "en", "b", 7), (None, "one two three four", "de", None, 18),
    (6, LONG, "en", "a", len(LONG)), (7, LONG + "end", "fr", "a", len(LONG) + 3), (8, "🙂 é ß 12345", "fr", "c", 11), (9, "x", "de", "", 1)]


@pytest.fixture(scope="module")
def edges(spark):
    # columns whose names the operators use themselves
    return spark.createDataFrame(EDGES, DOCS).withColumns({"id": F.lit("x"), "row": F.lit(1), "key": F.lit("k"), "size": F.lit(None).cast("int")})


@pytest.fixture(scope="module")
def none(edges):
    return edges.where("false")


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{SMALL}/documents.parquet").to_pandas()


def empty_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")


# --- near copies

def noisy(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_copies_equal_all_pairs(spark):
    rng, texts = random.Random(3), {}
    for g in range(12):
        base = [f"g{g}v{rng.randrange(200)}" for _ in range(rng.choice([4, 20, 60, 200]))]
        for _ in range(rng.choice([1, 2, 5, 25])):
            texts[len(texts)] = noisy(rng, base, rng.randrange(4)) if rng.random() < 0.8 else " ".join(base)
    for width, percent in ((3, 85), (5, 80)):
        want, sizes = near_components(texts, width, percent)
        frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
        got = near_copies.near_copies(frame, width, percent).collect()
        assert {r.id: r.component_id for r in got} == want
        assert {r.id: r.n_shingles for r in got} == sizes
        assert all(r.kept == (r.id == r.component_id) for r in got)


def test_blocks_compare_what_the_first_class_did_not_link(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK", 2)
    rng, texts = random.Random(5), {}
    common = [f"c{i}" for i in range(120)]
    for g in range(8):  # families share most words, so buckets mix them
        base = common[: 100 - g] + [f"f{g}x{i}" for i in range(8 + 2 * g)]
        for _ in range(4):
            texts[len(texts)] = noisy(rng, base, rng.randrange(3))
    want, _ = near_components(texts, 3, 85)
    got = near_copies.near_copies(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), 3, 85).collect()
    assert {r.id: r.component_id for r in got} == want


def test_near_copies_query(spark, docs):
    got = queries.op5_near_copies(spark, SMALL).toPandas().set_index("doc_id")
    want, sizes = near_components(dict(zip(docs.doc_id, docs.text)), 3, 85)
    assert got.component_id.to_dict() == want and got.n_shingles.to_dict() == sizes


@pytest.mark.parametrize("folder", [SMALL, SMALL.replace("sf0.001", "sf0.01")])
def test_near_copies_query_is_its_sql(spark, folder):
    from oracle import compare, connect

    assert compare(queries.op5_near_copies(spark, folder).toPandas(), connect(folder).execute(queries.OP5_SQL).df()) is None


def test_estimate_is_near_the_similarity(spark):
    a = np.unique(arrays.factors(800, 1))
    b = np.concatenate([a[:720], arrays.factors(80, 9)])
    rows = spark.createDataFrame([(near_copies._signature(a)[0].tolist(), near_copies._signature(np.unique(b))[0].tolist())], "a array<bigint>, b array<bigint>")
    found = rows.select(near_copies.estimate(F.col("a"), F.col("b"))).first()[0]
    assert abs(found - 720 / 880) < 0.13


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    got = {r.id: r.component for r in near_copies.components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}
    assert near_copies.components(edges.where("false")).count() == 0


def test_near_copies_edges(spark, edges, none):
    got = {r.id: (r.n_shingles, r.component_id, r.kept) for r in near_copies.near_copies(edges).collect()}
    assert got[1] == got[3] == (0, got[1][1], True) or got[1][2] and got[3][2]
    assert got[2] == (0, 2, True) and got[5] == (1, 4, False) and got[None] == (1, None, True)
    assert got[7][1] == 6
    left = near_copies.without_copies(edges)
    assert left.columns == edges.columns and sorted(r.doc_id or -1 for r in left.collect()) == [-1, 1, 2, 3, 4, 6, 8, 9]
    assert near_copies.near_copies(none).count() == 0 and near_copies.without_copies(none).count() == 0


# --- decontamination

def test_bit_parallel_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 40))] for _ in range(2))
        assert decontamination.common_run(np.array(a), np.array(b)) == subsequence(a, b)


def test_best_stretch_equals_a_search_of_all_its_words():
    rng = random.Random(4)
    for case in range(300):
        letters = rng.choice([3, 12, 60])
        item = np.array([rng.randrange(letters) for _ in range(rng.randrange(1, 40))])
        text = np.array([rng.randrange(letters * rng.choice([1, 3])) for _ in range(rng.randrange(0, 130))], np.int64)
        span, step = max(4, len(item) * 3 // 2), max(1, len(item) // 4)
        runs = [(subsequence(item.tolist(), text[k: k + span].tolist()) / len(item), -k) for k in range(0, max(1, len(text) - span + step), step)]
        share, at = max(runs)
        least = rng.choice([0.0, 0.4])
        got = decontamination.best_run(item, text, np.isin(text, item), least)
        if share and share >= least:
            assert got == (share, -at), case
        else:
            assert got[0] == 0 or got[0] < least, case


def test_sums_of_segments():
    rng = np.random.default_rng(6)
    basis = rng.standard_normal((50, 7)).astype(np.float32)
    for size in (1, 2, 40):
        length = rng.integers(1, 33, size)
        first = np.cumsum(length) - length
        word = rng.integers(0, 50, int(length.sum()))
        weight = rng.random(len(word)).astype(np.float32)
        plain = np.stack([weight[a: a + n] @ basis[word[a: a + n]] for a, n in zip(first, length)])
        assert np.allclose(decontamination._summed(basis, word, weight, first), plain, atol=1e-5)


def test_leaks_copies_and_paraphrases(spark, docs):
    rng = random.Random(2)
    bench = pq.read_table(f"{SMALL}/benchmark.parquet").to_pandas()
    long_item = " ".join(f"term{rng.randrange(5000)}" for _ in range(150))
    items = [*zip(bench.item_id.tolist(), bench.text.tolist()), (900, long_item), (901, None), (902, ""), (903, "the of")]
    clean = [t for t in docs.text if len(t.split()) > 150][:20]
    rows, want = [], set()
    for k, (i, t) in enumerate(items[:20]):
        host, words = clean[k % len(clean)].split(), t.split()
        cut = rng.randrange(len(host))
        rows.append((k, " ".join(host[:cut] + words + host[cut:])))
        want.add((k, i))
        dropped = [w for j, w in enumerate(words) if j % 6 != 5]  # every sixth word left out
        rows.append((100 + k, " ".join(host[:cut] + dropped + host[cut:])))
        want.add((100 + k, i))
    rows.append((300, "intro " + " ".join(long_item.split()[64:140]) + " outro"))
    want.add((300, 900))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = decontamination.leaks(frame, spark.createDataFrame(items, "item_id bigint, text string"))
    got = {(r.id, r.item_id) for r in found.collect()}
    plain = lambda t: " ".join(__import__("re").findall(r"\w+", t.lower()))
    hosted = {(d, i) for d, t in rows for i, b in items if b and f" {plain(b)} " in f" {plain(t)} "}  # also the short one
    assert want <= got and got <= want | hosted


def test_leaks_retold(spark, docs):
    """Items with a share of their words replaced, the answer kept or not, in clean texts."""
    rng = random.Random(7)
    bench = pq.read_table(f"{SMALL}/benchmark.parquet").to_pandas()
    items = list(zip(bench.item_id.tolist(), bench.text.tolist()))
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    clean = [t for t in docs.text if t and len(t.split()) > 150 and not any(plain(b) in plain(t) for _, b in items)]
    pool = [w for t in clean for w in t.split()]
    rows, made = [(-1 - k, t) for k, t in enumerate(clean)], {}
    for replaced in (0.2, 0.35, 0.5):
        for answered in (True, False):
            for i, t in items:
                words = t.split()
                last = len(re.split(r"(?<=[.!?:])\s+", t.strip())[-1].split()) if answered else 0
                for j in rng.sample(range(len(words) - last), round(replaced * (len(words) - last))):
                    words[j] = rng.choice(pool)
                host = rng.choice(clean).split()
                cut = rng.randrange(len(host))
                made[len(made)] = replaced, answered, i
                rows.append((len(made) - 1, " ".join(host[:cut] + words + host[cut:])))
    found = decontamination.leaks(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8),
                                  spark.createDataFrame(items, "item_id bigint, text string"))
    got = {(r.id, r.item_id) for r in found.collect()}
    assert not {d for d, i in got if d < 0 or made[d][2] != i}
    for replaced, answered, least in ((0.2, True, 0.95), (0.2, False, 0.95), (0.35, True, 0.9), (0.35, False, 0.9), (0.5, True, 0.9)):
        wanted = {(d, i) for d, (r, a, i) in made.items() if (r, a) == (replaced, answered)}
        assert len(wanted & got) >= least * len(wanted), (replaced, answered)


def test_leaks_short_unspaced_and_other_case(spark):
    items = [(1, "\u5317\u4eac\u662f\u4e2d\u56fd\u7684\u9996\u90fd\u4e5f\u662f\u5927\u57ce\u5e02\u4e4b\u4e00\u5427\u554a"), (2, "Golden Ratio Forty"),
             (3, "\u0421\u0442\u043e\u043b\u0438\u0446\u0430 \u0424\u0440\u0430\u043d\u0446\u0438\u0438 \u0433\u043e\u0440\u043e\u0434 \u041f\u0430\u0440\u0438\u0436 \u0438 \u0401\u043b\u043a\u0430"), (4, "single"), (5, "?! ."),
             (6, "\u0391\u0398\u0397\u039d\u0391 \u03a0\u039f\u039b\u0397 \u0395\u039b\u039b\u0391\u0394\u0391 \u03a3\u0399\u03a4\u039f\u03a3 \u039a\u0391\u0399")]
    rows = [(1, "\u4ed6\u8bf4" + items[0][1] + "\u4ed6\u4e0d\u77e5\u9053"), (2, "the GOLDEN ratio forty here"), (3, "golden forty ratio"), (4, "so " + items[2][1].upper() + " da"),
            (5, "a single word"), (6, "Single."), (7, "x " + items[5][1].lower() + " y"), (8, "\u4ed6\u4e0d\u77e5\u9053\u4e2d\u56fd\u5728\u54ea\u91cc"), (9, None), (10, ""), (11, "golden"), (12, "ratio forty")]
    found = decontamination.leaks(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r.id, r.item_id) for r in found.collect()} == {(1, 1), (2, 2), (4, 3), (6, 4), (7, 6)}


def test_latent_cosines_of_windows():
    rng = np.random.default_rng(3)
    value, basis = rng.uniform(0.5, 3, 30).astype(np.float32), np.linalg.qr(rng.standard_normal((30, 8)))[0].astype(np.float32)
    value[::7] = 0
    parts = rng.standard_normal((5, 8)).astype(np.float32)
    parts /= np.linalg.norm(parts, axis=1, keepdims=True)
    space = decontamination.Space(value, basis, parts)
    slot, word = np.sort(rng.integers(0, 12, 300)), rng.integers(0, 30, 300)
    dense = np.zeros((12, 30))
    np.add.at(dense, (slot, word), 1)
    dense = np.where(dense > 0, 1 + np.log(np.maximum(dense, 1)), 0) * value @ basis
    windows = dense[:11] + dense[1:]
    want = windows @ parts.T / np.linalg.norm(windows, axis=1, keepdims=True)
    got = space.cosines(space.blocks(slot, word, 12), 2, 11, np.arange(5))
    assert np.allclose(got, want, atol=1e-4)
    assert abs(space.cosine(word[slot == 4], 2) - dense[4] @ parts[2] / np.linalg.norm(dense[4])) < 1e-4


def test_leaks_of_many_short_items(spark, docs):
    rng = random.Random(4)
    pool = [re.findall(r"\w+", t) for t in docs.text if t and len(t.split()) > 150]
    items = []
    for k in range(1000):
        words, size = rng.choice(pool), rng.randrange(5, 11)
        at = rng.randrange(len(words) - size)
        items.append((k, " ".join(words[at:at + size])))
    rows, want = [], set()
    for k, text in items:  # each one once, verbatim, in a text of common letters
        host = rng.choice(pool)[:120]
        cut = rng.randrange(len(host))
        rows.append((k, " ".join(host[:cut] + [text] + host[cut:])))
        want.add((k, k))
    found = decontamination.leaks(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    got = {(r.id, r.item_id) for r in found.where("share = 1").collect()}
    assert not want - got


def test_leaks_query(spark, docs):
    import re

    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [plain(t) for t in pq.read_table(f"{SMALL}/benchmark.parquet")["text"].to_pylist()]
    want = {i for i, t in zip(docs.doc_id, docs.text) if any(b in plain(t) for b in items)}
    got = queries.op1_decontaminate(spark, SMALL).toPandas()
    assert len(got) == len(docs) and set(got.doc_id[got.contaminated]) == want


def test_leaks_edges(spark, edges, none):
    bench = spark.createDataFrame([(1, "quick tree ünder the quick tree under"), (None, "one two three four five six"), (2, None)], "item_id bigint, text string")
    got = decontamination.flagged(edges, bench)
    assert got.count() == len(EDGES)
    assert decontamination.clean(edges, bench).columns == edges.columns
    assert decontamination.flagged(none, bench).count() == 0 and decontamination.clean(none, bench).count() == 0
    assert decontamination.clean(edges, bench.where("false")).count() == len(EDGES)


def test_stretches_of_many_texts_equal_single_subsequences():
    rng = random.Random(9)
    found, want = decontamination.Stretches(), []
    for length in (1, 5, 40, 64, 64):
        item = np.array([rng.randrange(12) for _ in range(length)])
        texts = [np.array([rng.randrange(18) for _ in range(rng.randrange(1, 129))]) for _ in range(40)]
        words, bits = decontamination._bits(item)
        marks = np.zeros((len(texts), 128), np.uint64)
        for row, text in zip(marks, texts):
            held = np.flatnonzero(np.isin(text, item))
            row[held] = bits[np.searchsorted(words, text[held])]
        found.add(marks, np.array([len(t) for t in texts]), length, 0.4)
        span, step, own = max(4, length * 3 // 2), max(1, length // 4), []
        for k, text in enumerate(texts):
            begins = range(0, max(1, len(text) - span + step), step)
            share, at = max((subsequence(item.tolist(), text[b: b + span].tolist()) / length, -b) for b in begins)
            if share >= 0.4:
                own.append((k, share, -at))
        want.append(own)
    got = [[(int(k), float(s), int(b)) for k, s, b in zip(*of) if s >= 0.4] for of in found.best()]
    assert got == want and sum(map(len, want)) > 40


def test_numbers_of_words():
    rng = np.random.default_rng(8)
    for size in (1, 3, 5000):
        known = np.unique(arrays.factors(size, 5))
        hashes = rng.permutation(np.concatenate([np.repeat(known, 2), arrays.factors(300, 6)]))
        hit, place = decontamination.Lookup(known)(hashes)
        assert sorted(hit.tolist()) == np.flatnonzero(np.isin(hashes, known)).tolist() and (known[place] == hashes[hit]).all()
    # the last sentence begins within a word of the item
    items = decontamination._items([1], ["\u6211\u4eec\u53bb\u5427\uff01alpha beta gamma delta"])
    assert len(items.extra) == 1
    numbers = items.numbers(decontamination.tokens(pa.array(["alpha beta other"]))[0], items.lookups())
    assert numbers[0] == len(items.vocabulary) and numbers[1] < numbers[0] and numbers[2] == items.unknown


def test_texts_are_cut_into_words_once(spark, docs):
    bench = pq.read_table(f"{SMALL}/benchmark.parquet").to_pandas()
    seen = spark.sparkContext.accumulator(0)

    def read(text):
        seen.add(1)
        return text

    rows = spark.createDataFrame([(k, t) for k, t in enumerate(docs.text[:50].tolist() + [bench.text[0]])], "doc_id bigint, text string")
    frame = rows.withColumn("text", F.udf(read, "string")("text"))
    found = decontamination.leaks(frame, spark.createDataFrame(list(zip(bench.item_id.tolist(), bench.text.tolist())), "item_id bigint, text string"))
    assert (50, int(bench.item_id[0])) in {(r.id, r.item_id) for r in found.collect()}
    assert seen.value == 51


def test_latent_basis_spans_the_leading_directions(spark):
    rng = np.random.default_rng(0)
    a = rng.standard_normal((200, 6)) @ rng.standard_normal((6, 40)) + 0.01 * rng.standard_normal((200, 40))
    rows = [(np.arange(40, dtype=np.int32).tobytes(), r.astype(np.float32).tobytes()) for r in a]
    basis = decontamination.latent_basis(spark.createDataFrame(rows, "words binary, weights binary").repartition(4), 40, rank=6)
    exact = np.linalg.svd(a)[2][:6]
    assert basis.shape == (40, 6) and np.linalg.svd(exact @ basis)[1].min() > 0.999


# --- mixing

def check_mix(rows):
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = mixing_targets(sizes)
    for s, t in want.items():
        own = [r for r in rows if r.source == s]
        assert all(abs(r.target - t) <= 1e-6 * max(t, 1) and r.source_size == sizes[s] for r in own)
        assert abs(sum(r.taken for r in own) - t) <= max([r.size for r in own])
        assert all(0 <= r.copies <= 3 and r.taken == r.copies * r.size for r in own)
    return want


def test_mixing_query(spark):
    got = queries.op2_mix(spark, SMALL)
    rows = sorted(got.collect(), key=lambda r: r.doc_id)
    check_mix(rows)
    assert rows == sorted(queries.op2_mix(spark, SMALL).collect(), key=lambda r: r.doc_id)


def test_mixing_rates_are_balanced(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(["w"] * rng.choice([1, 3, 3, 3, 50, 400])), rng.choice("aaaaaabbcd")) for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix(frame).collect()
    for s, t in check_mix(got).items():
        own = [r for r in got if r.source == s]
        assert abs(sum(r.rate * r.size for r in own) - t) <= 1e-5 * t
    mixed = mixing.mixture(frame)
    assert mixed.count() == sum(r.copies for r in got) and set(frame.columns) < set(mixed.columns)


def test_mixing_hot_cell(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CELL", 5)
    frame = spark.createDataFrame([(i % 90, "a b c", "hot") for i in range(100)] + [(1000, "a b", None), (1001, "a b c", "z")], "doc_id bigint, text string, source string")
    check_mix(mixing.mix(frame).collect())


def test_mixing_edges(edges, none):
    got = mixing.mix(edges).collect()
    assert len(got) == len(EDGES)
    check_mix(got)
    assert mixing.mix(none).count() == 0 and mixing.mixture(none).count() == 0
    assert mixing.mixture(edges).where("doc_id = 2").count() == 1


# --- languages

def test_languages_held_out(spark, docs):
    got = queries.op3_languages(spark, SMALL).toPandas().set_index("doc_id")
    held = got[got.held_out]
    truth = docs.set_index("doc_id").lang
    assert len(got) == len(docs) and (held.lang_pred == truth[held.index]).mean() >= 0.97
    assert got.score.between(0, 1).all()


def test_languages_mixture(spark, docs):
    model = languages.learn(spark.read.parquet(f"{SMALL}/documents.parquet"))
    pick = {n: " ".join(docs.text[docs.lang == n].iloc[:6]).split()[:400] for n in ("en", "fr", "de")}
    both = " ".join(pick["en"][:300] + pick["fr"][:100])
    share = languages.mixtures(pa.array([both, " ".join(pick["de"]), "", None, "123 !!"]), model)
    place = {n: i for i, n in enumerate(model.names)}
    assert abs(share[0, place["en"]] - 0.75) < 0.1 and abs(share[0, place["fr"]] - 0.25) < 0.1
    assert share[1, place["de"]] > 0.9 and not share[2:].any()


def test_languages_edges(edges, none):
    model = languages.learn(edges)
    got = {r.row.doc_id: r for r in languages.predict(edges, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[2].score == 0
    assert languages.predict(none, model).count() == 0
    unlearned = languages.predict(edges, languages.learn(none)).collect()
    assert {r.lang_pred for r in unlearned} == {"und"}


# --- chats

def test_chats_round_trip(spark):
    hard = ["<|im_end|>", r"<\|im_start|>", r"a<\\|b", "<<|", "\n", "", "<|im_sep|>x<|nl|>", None, "é🙂 <|im_end|>\n<|im_start|>assistant\nx"]
    roles = ["user", "assistant", "assistant", "ro\nle", "<|im_end|>", None]
    rng, rows = random.Random(4), []
    for c in range(40):
        rows += [(c, t, rng.choice(roles), rng.choice(hard)) for t in range(rng.randrange(1, 7))]
    rows += [(None, 1, "user", "x"), (None, None, "user", "first"), (70, 1, "user", "b"), (70, 1, "user", "a"), (70, 1, "user", "a")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("id", F.lit(1))
    got = chats.read_back(chats.format_chats(frame.repartition(5))).collect()
    want = {}
    for c, t, r, x in rows:
        want.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    assert {r.id: [tuple(t) for t in r.turns] for r in got} == {c: [t[2:] for t in sorted(v, key=lambda t: (t[0], t[1], t[2], t[3]))] for c, v in want.items() if c not in (0,)} | (
        {0: [t[2:] for t in sorted(want[0])]})
    for r in got:
        assert r.loss_text == "".join(t.text for t in r.turns if t.role == "assistant")
    assert chats.format_chats(frame.where("false")).count() == 0


def test_neighbours_of_a_role_are_merged(spark):
    frame = spark.createDataFrame([(1, 2, "user", "b"), (1, 1, "user", "a"), (1, 3, "assistant", "c")], "conv_id bigint, turn bigint, role string, text string")
    row = chats.format_chats(frame).first()
    assert row.formatted == "<|im_start|>user\na<|im_sep|>b<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n"
    assert [row.formatted[s.start:s.end] for s in row.loss_spans] == ["c"]


def test_chats_query_is_its_sql(spark):
    from oracle import compare, connect

    assert compare(queries.op4_chats(spark, SMALL).toPandas(), connect(SMALL).execute(queries.OP4_SQL).df()) is None


# --- personal data

HARD = ["a@b.c@d.e", "x@y", "me.you+1@sub.ex-am.co.uk. next", "1.2.3.4.5.6.7.8", "999.1.1.1", "10.0.0.256 10.0.0.255", "4111 1111 1111 1111",
        "4111-1111-1111-1112", "1 2 3 4", "+49 (0)30 123456-78.", "+1", "+12+34 567 890 12", "é🙂 a@b.io 🙂 127.0.0.1", "00000.1.2.3", "1.2.3", "1..2.3.4.5",
        "4785380592391139$$$", "+" * 50, "1" * 50, "@@a@b.c", "a@b.c.", "a@-.x_", "5500 0000 0000 0004 5500 0000 0000 0004"]


def test_private_data_base_spans(spark):
    rng = random.Random(6)
    texts = HARD + ["".join(rng.choice("0123456789.+- ()@ab") for _ in range(rng.randrange(80))) for _ in range(400)] + ["x" * 200_000 + " q@w.e", "0" * 5000 + "7.0.0.1", "1.2.3." + "9" * 5000, None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in private_data.detect(frame).select("row.doc_id", "spans", *[c.alias("d" + str(k)) for k, c in enumerate(private_data.digest())]).collect()}
    for i, t in enumerate(texts):
        base = ",".join(f"{s.kind}:{s.start}:{s.end}" for s in got[i]["spans"] if s.kind in private_data.BASE)
        assert base == base_spans(t), t


def test_long_runs_of_blanks_take_linear_time():
    anchors, begin = private_data.automaton(), time.perf_counter()
    assert not any(private_data.spans_of("password" + " " * 300_000 + "!", anchors).values())
    assert time.perf_counter() - begin < 5
    text = "passport no.\n  : AB1234567 acct   number 00012345"
    assert [text[a:b] for a, b in private_data.spans_of(text, anchors)["account"]] == ["AB1234567", "00012345"]


def test_private_data_query(spark, docs):
    got = queries.op6_private_data(spark, SMALL).toPandas().set_index("doc_id").base_sha256
    assert got.to_dict() == {i: sha(base_spans(t)) for i, t in zip(docs.doc_id, docs.text)}


def test_private_data_masked(spark, edges, none):
    text = "Write a@b.io or IBAN DE89 3704 0044 0532 0130 00, token = \"abcd12345678\", see https://x.example.com/a?b=1."
    frame = spark.createDataFrame([(1, text, "en", "s", len(text)), (2, None, "en", "s", 3)], DOCS)
    rows = {r.doc_id: r for r in private_data.masked(frame).collect()}
    assert rows[1].text == 'Write [EMAIL] or IBAN [IBAN], token = "[ACCOUNT]", see [URL].' and rows[1].n_chars == len(rows[1].text)
    assert rows[2].text is None and rows[2].n_chars == 3
    out = private_data.masked(edges)
    assert out.columns == edges.columns and out.count() == len(EDGES) and private_data.masked(none).count() == 0


# --- toxicity

def test_toxicity_held_out(spark, docs):
    sf = SMALL.replace("sf0.001", "sf0.01")
    table, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    chain = toxicity.fit(table, labels.where("doc_id % 4 <> 0"))
    got = toxicity.predict(table, chain).select("row.doc_id", "rejected").join(labels.where("doc_id % 4 = 0"), "doc_id").toPandas()
    toxic = got[got.toxic == 1]
    assert (got[got.toxic == 0].rejected).mean() <= 0.02 and toxic.rejected.mean() >= 0.5


def test_copies_are_learned_from_once():
    rng = np.random.default_rng(8)
    base = [np.unique(rng.integers(0, 1 << 62, 200).astype(np.uint64)) for _ in range(3)]
    near = np.union1d(base[0][:-6], rng.integers(0, 1 << 62, 6).astype(np.uint64))
    none = np.zeros(0, np.uint64)
    words, labels = [base[0], base[1], near, near, base[2], none, none], [(1, 0), (0, 1), (1, 0), (0, 1), (1, 0), (0, 1), (0, 1)]
    # a copy with other labels is a text of its own; texts without words are copies of each other
    assert toxicity.distinct_texts(words, labels).tolist() == [0, 1, 3, 4, 5]
    assert len(toxicity.distinct_texts([], [])) == 0


def test_beginnings_that_words_share():
    texts = pa.array(["bomentera bomentera", "bomentera bomente", "bomentera bomente bomentemi", None, ""])
    text, _ = toxicity.words_of(texts)
    # words, beginnings of 5 and 6 bytes, those that two words share, those that three share
    assert np.bincount(text, minlength=5).tolist() == [1 + 2, 2 + 2 + 2, 3 + 2 + 2 + 2, 0, 0]


def test_toxicity_edges(spark, edges, none):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, 0, 1), (None, 1, 1), (77, 1, 1), (6, None, None), (8, None, 1)], "doc_id bigint, quality int, toxic int")
    for given in (labels, empty_labels(spark)):
        chain = toxicity.fit(edges, given)
        got = toxicity.predict(edges, chain)
        assert got.count() == len(EDGES) and not [r for r in got.where("row.text is null or row.text = ''").collect() if r.rejected]
        assert toxicity.predict(none, chain).count() == 0


# --- quality

def test_quality_shrinks_sparse_sites(spark):
    rows = [(i, "big", "big/a", 0.9 if i % 10 else 0.2) for i in range(400)] + [(1000 + i, "bad", "bad/a", 0.1 + 0.001 * (i % 7)) for i in range(200)] + [(5000, "rare", "rare/x", 0.05)]
    got = {r.id: r for r in quality.combine(spark.createDataFrame(rows, "id bigint, host string, path string, evidence double")).collect()}
    prior = sum(r[3] for r in rows) / len(rows)
    assert abs(got[5000].host_prior - prior) < 1e-9  # its own evidence is left out
    assert got[1].host_prior > 0.75 and got[1000].host_prior < 0.2 and got[1].quality > 0.9


def test_quality_held_out(spark):
    sf = SMALL.replace("sf0.001", "sf0.01")
    table, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.quality(table, labels.where("doc_id % 4 <> 0"), F.col("source"), F.concat_ws("/", "source", "lang"))
    both = got.withColumnRenamed("quality", "p").join(labels.where("doc_id % 4 = 0"), got.id == labels.doc_id).toPandas()
    assert ((both.p >= 0.5) == (both.quality == 1)).mean() >= 0.93


def test_quality_edges(spark, edges, none):
    for frame, n in ((edges, len(EDGES)), (none, 0)):
        assert quality.quality(frame, empty_labels(spark), F.col("source"), F.col("lang")).count() == n


# --- licences

def test_licenses(spark, edges, none):
    texts = ["Foo.\nReleased under the MIT License.\nBar", "Licensed under CC BY-NC 4.0. Than the on of ereat thes.", "This work is licensed under the GNU General Public License, version 3.",
             "Licensed under the Apache License, Version 2.0.", "He lost his driving license in May.", "No word of it.", None, "", "License\nlicense\n\n",
             "Licensed under the Mozilla Public License, version 2.0.\nReleased under the MIT License.",
             "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n1. ...",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
             "to deal in the Software without restriction, including without limitation the rights to use, copy, modify and sell",
             "Redistribution of wealth was debated.", "The heat is redistributed by fans."]
    model = licenses.LicenseModel(spark)
    found = model.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    by = {}
    for r in found:
        by.setdefault(r.id, set()).add(r.family)
    assert by == {0: {"mit"}, 1: {"cc-by-nc"}, 2: {"gpl"}, 3: {"apache"}, 4: {"unknown"}, 8: {"unknown"}, 9: {"mpl", "mit"}, 10: {"bsd"}, 11: {"mit"},
                  12: {"unknown"}, 13: {"unknown"}}
    assert model.scan(edges).count() == 0 and model.scan(none).count() == 0
    assert not [t for family in licenses.TEMPLATES.values() for t in family if not re.search(licenses.CUES, t)]


GPL = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
       "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.")


def test_wrapped_licenses(spark):
    notices = {"gpl": GPL, **{f: max(licenses.TEMPLATES[f], key=len) for f in ("apache", "bsd", "lgpl", "mit", "mpl")}}
    rows, want = [], {}
    for width in (40, 60, 72, 80):
        for mark in ("", "# ", " * ", "// "):
            for family, notice in notices.items():
                rows.append((len(rows), "Some words first.\n" + "\n".join(mark + t for t in textwrap.wrap(notice, width)) + "\nMore of it.\nAnd the end."))
                want[rows[-1][0]] = family
    rows.append((len(rows), "Released under the MIT License.\n" + "\n".join(textwrap.wrap(GPL, 72))))
    want[rows[-1][0]] = "gpl,mit"
    model = licenses.LicenseModel(spark)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = model.scan(frame).where(F.col("family") != licenses.UNKNOWN).collect()
    got = {}
    for r in known:
        got.setdefault(r.id, []).append(r.family)
    assert {i: ",".join(sorted(f)) for i, f in got.items()} == want  # each notice once


def test_licenses_without_a_cue(spark):
    texts = ["Text available under CC BY-SA 4.0.", "Photographs are under CC\nBY-NC 4.0 as ever.", "The terms of the peace were hard.", "Under CC rules."]
    found = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert {r.id: r.families for r in found} == {0: "cc-by-sa", 1: "cc-by-nc"}


# --- fingerprints

def test_fingerprint_query(spark, docs):
    got = queries.op10_fingerprints(spark, SMALL).toPandas().set_index("doc_id").sort_index(ascending=False)
    texts = docs.set_index("doc_id").text.sort_index(ascending=False)
    want = edited(texts.tolist())
    assert got.edited_sha256.tolist() == [sha(t) for t in want] and got.n_chars.tolist() == [len(t) for t in texts]
    assert got.groupby(texts).fingerprint.nunique().max() == 1
    long = got.n_chars > 1000
    assert got.near_edited[long].mean() > 0.35 and got.near_edited[long].mean() > got.near_next[long].mean() + 0.3


def test_next_over_many_ranges(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i * i - 500, f"text {i}") for i in rng.sample(range(300), 200)]
    ordered = [t for _, t in sorted(rows, reverse=True)]
    for most in (4096, 3):  # with few ranges they are cut again
        monkeypatch.setattr(fingerprints, "RANGE_ROWS", 7)
        monkeypatch.setattr(fingerprints, "MOST_RANGES", most)
        got = {r.text: r.next_text for r in fingerprints.with_next(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
        assert got == {t: ordered[(k + 1) % len(ordered)] for k, t in enumerate(ordered)}


def test_features_are_local_maxima():
    rng = np.random.default_rng(1)
    table = rng.integers(1, 500, (256, 256)).astype(np.int32)
    data = rng.integers(97, 105, 3000).astype(np.uint8)
    each = np.concatenate([[0], table[data[:-1], data[1:]]])
    rare = [int(each[i + 1: i + fingerprints.WINDOW].sum()) for i in range(len(data) - fingerprints.WINDOW + 1)]
    want = [i for i, r in enumerate(rare) if all(r > x for x in rare[max(0, i - 16): i]) and all(r >= x for x in rare[i + 1: i + 17])]
    assert len(fingerprints.features(data, table)) == len(want)
    assert (fingerprints.read(fingerprints.written(fingerprints.chain(arrays.factors(300)))) == fingerprints.chain(arrays.factors(300))).all()


def test_fingerprint_edges(spark, edges, none):
    got = fingerprints.edits(edges).collect()
    assert len(got) == len(EDGES) and {r.fingerprint for r in got if r.n_chars == 0} == {""}
    assert fingerprints.edits(none).count() == 0
    one = fingerprints.edits(spark.createDataFrame([(1, "alone in the world")], "doc_id bigint, text string")).first()
    assert one.near_next == 1.0
