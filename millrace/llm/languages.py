"""Languages of a text as a mixture.

Letter trigrams of labelled texts give each language a smoothed likelihood. A text's words are
drawn from a mixture of languages: expectation-maximisation estimates the proportions from the
words' trigram likelihoods, and languages are taken out one by one as long as the penalised
likelihood (half the logarithm of the words, times the languages) gets better. The language with
the largest proportion is the prediction, the proportion its score.

Texts that are null or hold no letter are ``und`` with score 0, and so is everything if nothing
could be learned. Rows with a null text or language are not learned from. Whole texts are read
when learning and when predicting; ids and labels are no inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm import arrays
from millrace.llm.shared import prepared

BUCKETS = 1 << 16
MOST_LANGUAGES = 400
SMOOTHING = 0.1
STEPS, FEWER_STEPS = 12, 4
MOST_GAIN = 25.0
"""A word counts for at most so much (log) in favour of one language."""

_LETTERS = np.zeros(0x110000, np.int32)
_SPACE = 32


def _tables() -> np.ndarray:
    """Code point to its lower-case letter, everything else to a space."""
    if not _LETTERS[ord("a")]:
        for c in range(0x30000):
            s = chr(c)
            _LETTERS[c] = ord(low) if s.isalpha() and len(low := s.lower()) == 1 else c if s.isalpha() else _SPACE
        _LETTERS[0x30000:] = np.arange(0x30000, 0x110000)
        _LETTERS[0xE0000:] = _SPACE
    return _LETTERS


@dataclass
class Languages:
    names: list[str]
    log_p: np.ndarray
    """Buckets x languages."""


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every trigram of every word (with its borders), first trigram of each word, the words' texts."""
    joined = [(" " + t + " ") if t else "  " for t in column.to_pylist()]
    points = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(joined)), [len(t) for t in joined])
    letters = _tables()[points].astype(np.uint32)
    solid = letters != _SPACE
    middle = np.flatnonzero(solid)
    h = letters[middle - 1] * np.uint32(0x9E3779B1) ^ letters[middle] * np.uint32(0x85EBCA77) ^ letters[middle + 1] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    first = np.flatnonzero(~solid[middle - 1])
    return (h & np.uint32(BUCKETS - 1)).astype(np.int64), first, text[middle[first]]


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Languages:
    """Count trigrams by language over all rows given; counts meet in one row per bucket and language."""
    prepared(docs.sparkSession)
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    names = sorted(r[0] for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), BUCKETS), np.int64)
        place = {n: i for i, n in enumerate(names)}
        for piece in arrays.pieces(batches, "text"):
            bucket, first, text = trigrams(piece.column("text"))
            if not len(bucket):
                continue
            lang = np.array([place[x] for x in piece.column("lang").to_pylist()])
            of = np.repeat(lang[text], np.diff(np.append(first, len(bucket))))
            total += np.bincount(of * BUCKETS + bucket, minlength=total.size).reshape(total.shape)
        lang, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()), pa.array(total[lang, bucket], pa.int64())],
                                         ["lang", "bucket", "n"])

    counts = np.zeros((BUCKETS, len(names)))
    if names:
        found = rows.mapInArrow(work, "lang int, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
        counts[found["bucket"].to_numpy(), found["lang"].to_numpy()] = found["n"].to_numpy()
    seen = counts.sum(axis=0) > 0
    counts, names = counts[:, seen], [n for n, s in zip(names, seen) if s]
    log_p = np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS))
    return Languages(names, log_p.astype(np.float32))


def _expect(gain: np.ndarray, cut: np.ndarray, words: np.ndarray, share: np.ndarray, steps: int) -> np.ndarray:
    """Steps of expectation-maximisation for all texts at once; a share of 0 stays 0."""
    for _ in range(steps):
        part = gain * np.repeat(share, words, axis=0)
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-300)
        share = np.add.reduceat(part, cut, axis=0) / words[:, None]
    return share


def _score(gain: np.ndarray, cut: np.ndarray, words: np.ndarray, share: np.ndarray) -> np.ndarray:
    p = (gain * np.repeat(share, words, axis=0)).sum(axis=1)
    return np.add.reduceat(np.log(np.maximum(p, 1e-300)), cut)


def mixtures(column: pa.Array, model: Languages) -> np.ndarray:
    """Proportions (texts x languages); a row of zeros where a text has no letter."""
    out = np.zeros((len(column), len(model.names)))
    bucket, first, text = trigrams(column)
    if not len(first) or not model.names:
        return out
    log_p = np.add.reduceat(model.log_p[bucket].astype(np.float64), first, axis=0)
    gain = np.exp(np.maximum(log_p - log_p.max(axis=1, keepdims=True), -MOST_GAIN))
    some, cut, words = np.unique(text, return_index=True, return_counts=True)
    share = _expect(gain, cut, words, np.full((len(some), gain.shape[1]), 1.0 / gain.shape[1]), STEPS)
    likelihood = _score(gain, cut, words, share)
    open_ = np.arange(len(some))
    while len(open_) and gain.shape[1] > 1:
        pick = np.concatenate([np.arange(cut[k], cut[k] + words[k]) for k in open_])
        g, w = gain[pick], words[open_]
        c = np.cumsum(w) - w
        less = share[open_].copy()
        weak = np.where(less > 0, less, np.inf).argmin(axis=1)
        less[np.arange(len(less)), weak] = 0
        alive = less.sum(axis=1) > 0
        less[alive] /= less[alive].sum(axis=1, keepdims=True)
        less = _expect(g, c, w, less, FEWER_STEPS)
        new = _score(g, c, w, less)
        better = alive & (new + 0.5 * np.log(w + 1.0) >= likelihood[open_])
        share[open_[better]], likelihood[open_[better]] = less[better], new[better]
        open_ = open_[better]
    out[some] = share
    return out


def predict(docs: DataFrame, model: Languages, text_col: str = "text") -> DataFrame:
    """(row, lang_pred, score, langs): the row without its text, the main language, all selected ones."""
    spark = prepared(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c != text_col]
    frame = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = frame.select("row").schema.add("lang_pred", "string").add("score", "double").add("langs", "string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for piece in arrays.pieces(batches, "text"):
            share = mixtures(piece.column("text"), model)
            if not share.shape[1]:
                share = np.zeros((piece.num_rows, 1))
            best, main = share.argmax(axis=1), share.max(axis=1)
            names = [model.names[b] if m > 0 else "und" for b, m in zip(best, main)]
            langs = [",".join(model.names[i] for i in np.argsort(-s, kind="stable") if s[i] > 0) if m > 0 else "und" for s, m in zip(share, main)]
            yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(names, pa.string()), pa.array(np.minimum(main, 1.0)), pa.array(langs, pa.string())],
                                             ["row", "lang_pred", "score", "langs"])

    return frame.mapInArrow(work, schema)
