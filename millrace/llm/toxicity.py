"""Toxic text by a classifier chain.

Categories are predicted one after the other by linear models over words and word beginnings (and
whether several words share one, as inflected forms do);
each model also gets the probabilities of the categories before it. In training those are
out-of-fold predictions, so a model never sees what its predecessors memorised.

The models are fitted on at most ``sample`` labelled documents, taken in hash order of their
ids, of near copies with the same labels on one; features are the words that differ most between
the classes of a category. Every whole text is scored. Null and empty texts have no features and are never toxic. Null labels, null ids
and ids without a document are not learned from; a repeated labelled row counts once. Without
labels of a category its probability is that of the class seen, near 0 if there is none.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm import arrays
from millrace.llm.shared import chance, fit_logistic, prepared

CATEGORIES = ("junk", "toxic", "severe")
SAMPLE = 8_000
FEATURES = 1_200
FOLDS = 3
LEAST_TEXTS = 4
"""Texts a word must be in to become a feature."""
FALSE_WORDS = 0.05
"""Words expected to become features by chance, of all that are tested."""
COPY_BANDS, COPY_ROWS, COPIES = 8, 4, 0.7
"""Labelled texts that share this much of their words are copies and learned from once."""
SEVERE = 4
"""Toxic texts with so many different telling words count as severe."""


@dataclass
class Chain:
    categories: tuple[str, ...]
    features: np.ndarray
    weights: list[np.ndarray]
    threshold: float = 0.5
    """Probability of ``toxic`` from which a text is rejected."""


def _counted(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct (text, hash), and how often it occurs."""
    order = np.lexsort((hashes, text))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (text[order][1:] != text[order][:-1])
    begin = np.flatnonzero(new)
    return order[begin], np.diff(np.append(begin, len(order)))


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, hash) of the words, of their first 5 and 6 bytes, and of such a
    beginning with 2 and with 3 where so many different words of the text have it."""
    data, offsets = arrays.flat(column)
    data = arrays.lower_latin(data)
    starts, ends, text = arrays.word_spans(data, offsets, arrays.NOT_WORD)
    whole = arrays.span_hashes(data, starts, ends, 21)
    place, _ = _counted(text, whole)
    starts, ends, text = starts[place], ends[place], text[place]
    hashes, texts = [whole[place]], [text]
    for width in (5, 6):
        long = ends - starts > width
        begin = arrays.span_hashes(data, starts[long], starts[long] + width, 21 + width)
        place, count = _counted(text[long], begin)
        for least in (1, 2, 3):
            some = place[count >= least]
            hashes.append(begin[some] if least == 1 else arrays.mix(begin[some] + np.uint64(least)))
            texts.append(text[long][some])
    hashes, texts = np.concatenate(hashes), np.concatenate(texts)
    order = np.lexsort((hashes, texts))
    return texts[order], hashes[order]


def _dense(text: np.ndarray, hashes: np.ndarray, rows: int, features: np.ndarray) -> np.ndarray:
    x = np.zeros((rows, len(features)), np.float32)
    if len(features) and len(hashes):
        place = np.minimum(np.searchsorted(features, hashes), len(features) - 1)
        hit = features[place] == hashes
        x[text[hit], place[hit]] = 1.0
    return x


def _telling(names: np.ndarray, place: np.ndarray, text: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words (``names``, at ``place`` of each text) whose share differs clearly between the classes, and the signed root of its likelihood ratio."""
    n, n1 = len(y), float(y.sum())
    if not 0 < n1 < n:
        return names[:0], np.zeros(0)
    all_of = np.bincount(place, minlength=len(names)).astype(np.float64)
    pos = np.bincount(place[y[text] > 0], minlength=len(names)).astype(np.float64)
    neg = all_of - pos
    # a log-likelihood ratio, as rare words are far from normal
    gain = sum(seen * np.log(np.maximum(seen, 1e-12) / np.maximum(usual, 1e-12)) for seen, usual in (
        (pos, all_of * n1 / n), (neg, all_of * (n - n1) / n), (n1 - pos, (n - all_of) * n1 / n), (n - n1 - neg, (n - all_of) * (n - n1) / n)))
    z = np.where(pos * n >= all_of * n1, 1.0, -1.0) * np.sqrt(2.0 * np.maximum(gain, 0.0))
    tested = all_of >= LEAST_TEXTS
    keep = tested & (gain >= np.log(max(int(tested.sum()), 1) / FALSE_WORDS))
    return names[keep], z[keep]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    """Learn the chain from ``labels`` (doc_id, quality, toxic) of ``docs`` (doc_id, text)."""
    prepared(docs.sparkSession)
    chosen = (labels.where("doc_id is not null and (toxic is not null or quality is not null)")
              .groupBy(F.col("doc_id").cast("bigint").alias("id"))
              .agg(F.max("toxic").cast("double").alias("toxic"), F.min("quality").cast("double").alias("quality"))
              .orderBy(F.xxhash64("id"), "id").limit(sample))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text")).where("text is not null")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrays.pieces(batches, "text"):
            text, hashes = words_of(piece.column("text"))
            bounds = np.searchsorted(text, np.arange(piece.num_rows + 1))
            found = [hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), piece.column(2), pa.array(found, pa.binary())],
                                             ["id", "toxic", "quality", "words"])

    # at most ``sample`` rows of three numbers, so sending them to every task is bounded
    rows = (texts.join(F.broadcast(chosen), "id").select("id", "toxic", "quality", "text")
            .mapInArrow(work, "id bigint, toxic double, quality double, words binary")
            .dropDuplicates(["id"]).orderBy("id").toArrow())
    return fit_rows(rows["id"].to_numpy(), rows["toxic"].to_numpy(zero_copy_only=False) if rows.num_rows else np.zeros(0),
                    rows["quality"].to_numpy(zero_copy_only=False) if rows.num_rows else np.zeros(0),
                    [np.frombuffer(w, np.uint64) for w in rows["words"].to_pylist()])


def distinct_texts(words: Sequence[np.ndarray], labels: Sequence[tuple]) -> np.ndarray:
    """Places of the texts that are no near copy of an earlier one with the same labels.

    Copies are no evidence of their own: a word that only one group of copies has tells nothing.
    Texts without words are copies of each other.
    """
    factors = arrays.factors(COPY_BANDS * COPY_ROWS, 23)
    heads: dict[tuple, int] = {}
    kept = []
    for k, (own, label) in enumerate(zip(words, labels)):
        keys: list[tuple] = [(label,)]
        if len(own):
            least = np.array([arrays.mix(own * f).min() for f in factors]).reshape(COPY_BANDS, COPY_ROWS)
            keys = [(label, b, *row.tolist()) for b, row in enumerate(least)]
        near = {heads[key] for key in keys if key in heads}
        if any(len(np.intersect1d(own, words[h], True)) >= COPIES * len(np.union1d(own, words[h])) for h in near):
            continue
        for key in keys:
            heads.setdefault(key, k)
        kept.append(k)
    return np.array(kept, np.int64)


def fit_rows(ids: np.ndarray, toxic: np.ndarray, quality: np.ndarray, words: Sequence[np.ndarray]) -> Chain:
    """Each category is learned from the rows that have its label."""
    toxic, quality = np.asarray(toxic, float), np.asarray(quality, float)
    single = distinct_texts(words, list(zip(np.nan_to_num(toxic, nan=-1.0).tolist(), np.nan_to_num(quality, nan=-1.0).tolist())))
    ids, toxic, quality, words = np.asarray(ids)[single], toxic[single], quality[single], [words[k] for k in single]
    n = len(ids)
    text = np.repeat(np.arange(n, dtype=np.int32), [len(w) for w in words]) if n else np.zeros(0, np.int32)
    hashes = np.concatenate(words) if n else np.zeros(0, np.uint64)
    has = {"junk": ~np.isnan(quality), "toxic": ~np.isnan(toxic), "severe": ~np.isnan(toxic)}
    labels = {"junk": (np.nan_to_num(quality, nan=1.0) < 0.5).astype(np.float32), "toxic": (np.nan_to_num(toxic) > 0.5).astype(np.float32)}
    chosen: dict[int, float] = {}
    telling: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    known, place = np.unique(hashes, return_inverse=True)
    place = place.astype(np.int32)
    for name, y in labels.items():
        rows = has[name]
        inside, number = rows[text], np.cumsum(rows) - 1
        telling[name] = names, z = _telling(known, place[inside], number[text[inside]], y[rows])
        top = np.argsort(-np.abs(z), kind="stable")[: FEATURES // 2]
        chosen.update({int(h): 0.0 for h in names[top]})
    features = np.array(sorted(chosen), np.uint64)
    x = _dense(text, hashes, n, features)
    marks = telling["toxic"][0][telling["toxic"][1] > 0]
    strong = np.isin(features, marks)
    labels["severe"] = ((labels["toxic"] > 0) & (x[:, strong].sum(axis=1) >= SEVERE)).astype(np.float32)
    fold = arrays.mix(np.asarray(ids, np.int64).view(np.uint64)) % np.uint64(FOLDS)
    earlier: list[np.ndarray] = []
    weights = []
    for name in CATEGORIES:
        y, rows = labels[name], has[name]
        full = np.column_stack([x, *earlier]).astype(np.float32) if earlier else x
        out = np.zeros(n, np.float32)
        for k in range(FOLDS):
            inside = fold == k
            if inside.any():
                out[inside] = chance(full[inside], fit_logistic(full[~inside & rows], y[~inside & rows], penalty=0.02))
        weights.append(fit_logistic(full[rows], y[rows], penalty=0.02))
        earlier.append(out)
    at = CATEGORIES.index("toxic")
    marked = (x[:, weights[at][: len(features)] > 0].sum(axis=1) > 0) & has["toxic"] if n else np.zeros(0, bool)
    return Chain(CATEGORIES, features, weights, _best_threshold(earlier[at][marked], labels["toxic"][marked]))


def _best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Where the out-of-fold predictions separate best (F1), half way to the next lower one."""
    if not y.any():
        return 0.5
    order = np.argsort(-p, kind="stable")
    p, hits = p[order], np.cumsum(y[order])
    score = 2 * hits / (np.arange(1, len(p) + 1) + float(y.sum()))
    score[:-1][p[:-1] == p[1:]] = 0  # equal probabilities are on one side
    best = int(score.argmax())
    lower = p[best + 1] if best + 1 < len(p) else 0.0
    return float(min(0.5, (p[best] + lower) / 2))


def predict_rows(column: pa.Array, chain: Chain) -> list[np.ndarray]:
    text, hashes = words_of(column)
    x = _dense(text, hashes, len(column), chain.features)
    out: list[np.ndarray] = []
    for w in chain.weights:
        out.append(chance(np.column_stack([x, *out]), w))
    return out


def predict(docs: DataFrame, chain: Chain, threshold: float | None = None) -> DataFrame:
    """Every row with its probabilities ``p_<category>`` and the decision ``rejected``.

    A text without a telling word has nothing to be rejected for and is kept.
    """
    prepared(docs.sparkSession)
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"))
    schema = kept.select("row").schema.add("p", T.ArrayType(T.DoubleType())).add("marks", T.LongType())
    threshold = chain.threshold if threshold is None else threshold
    strong = chain.features[chain.weights[1][: len(chain.features)] > 0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrays.pieces(batches, "text"):
            p = predict_rows(piece.column("text"), chain)
            text, hashes = words_of(piece.column("text"))
            marks = np.bincount(text[np.isin(hashes, strong)], minlength=piece.num_rows)
            yield pa.RecordBatch.from_arrays(
                [piece.column("row"), pa.array(np.column_stack(p).tolist(), pa.list_(pa.float64())), pa.array(marks, pa.int64())],
                ["row", "p", "marks"])

    scored = kept.mapInArrow(work, schema)
    at = chain.categories.index("toxic")
    return scored.select("row", *[F.col("p")[i].alias(f"p_{c}") for i, c in enumerate(chain.categories)],
                         ((F.col("p")[at] >= threshold) & (F.col("marks") > 0)).alias("rejected"))
