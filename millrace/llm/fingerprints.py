"""Document fingerprints from improbable features.

Every byte window of ``WINDOW`` bytes has an information content: the sum of the surprisals of its
bytes after their predecessors, under byte-pair frequencies counted over the whole corpus. Windows
that are rarer than all within ``NEAR`` bytes around them are the features of a text; they depend on
nearby bytes only, so an edit changes the features around it. Features go, in order, into a chain of
Bloom filters of bounded load. Two chains are compared by their common bits, over what chance
gives, each filter with its best partner.

Null and empty texts have the empty fingerprint, alike (1) to each other and unlike (0) to others.
A text shorter than a window is one feature, itself. Equal texts have equal fingerprints under one
model; without any pair counted all pairs are equally likely. Rows with a null id come last in the
descending order; rows that repeat an id are ordered by text. A single row is its own next one.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm import arrays
from millrace.llm.shared import prepared, stored
from millrace.operators.ordered import split_points, tag_range

WINDOW = 32
NEAR = 16
FILTER_BYTES = 256
HASHES = 5
LOAD = 128
"""Features in one filter before the next is opened."""
RANGE_ROWS = 2_000
MOST_RANGES = 4_096

_BYTE_FACTORS = arrays.factors(WINDOW, 41)


def learn(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Surprisal of each byte after each other, in 1/64 bit, over all texts."""
    prepared(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for piece in arrays.pieces(batches, "text"):
            data, offsets = arrays.flat(piece.column("text"))
            if len(data) > 1:
                inside = np.ones(len(data) - 1, bool)
                ends = offsets[1:-1]
                inside[ends[(ends > 0) & (ends < len(data))] - 1] = False
                pairs = data[:-1].astype(np.int32) * 256 + data[1:]
                total += np.bincount(pairs[inside], minlength=1 << 16)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["pair", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(work, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    counts = np.full(1 << 16, 0.5)
    counts[rows["pair"].to_numpy()] += rows["n"].to_numpy()
    counts = counts.reshape(256, 256)
    return np.round(-64.0 * np.log2(counts / counts.sum(axis=1, keepdims=True))).astype(np.int32)


def _slide(x: np.ndarray, width: int) -> np.ndarray:
    """Largest of each ``width`` neighbours."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.maximum(x[:-step], x[step:])
        have += step
    return x


def features(data: np.ndarray, surprisal: np.ndarray) -> np.ndarray:
    """Hashes of the selected windows, in order of the text."""
    if len(data) == 0:
        return np.zeros(0, np.uint64)
    if len(data) < WINDOW:
        value = (data.astype(np.uint64) + np.uint64(1)) * _BYTE_FACTORS[: len(data)]
        return arrays.mix(np.array([value.sum(dtype=np.uint64) + np.uint64(len(data))], np.uint64))
    each = np.zeros(len(data), np.int64)
    np.cumsum(surprisal[data[:-1], data[1:]], out=each[1:])
    rare = each[WINDOW - 1:] - each[: len(data) - WINDOW + 1]
    edge = np.full(NEAR, -1, rare.dtype)
    around = _slide(np.concatenate([edge, rare, edge]), NEAR)
    n = len(rare)
    # the first of equally rare neighbours is taken
    chosen = np.flatnonzero((rare > around[:n]) & (rare >= around[NEAR + 1: NEAR + 1 + n]))
    if not len(chosen):
        chosen = np.array([int(rare.argmax())])
    out = np.empty(len(chosen), np.uint64)
    for begin in range(0, len(chosen), 1 << 14):
        spots = chosen[begin: begin + (1 << 14)]
        windows = data[spots[:, None] + np.arange(WINDOW)].astype(np.uint64) + np.uint64(1)
        out[begin: begin + len(spots)] = (windows * _BYTE_FACTORS).sum(axis=1, dtype=np.uint64)
    return arrays.mix(out)


def chain(found: np.ndarray) -> np.ndarray:
    """Bloom filters (filters x bytes) of the features."""
    count = -(-len(found) // LOAD)
    bits = np.zeros((count, FILTER_BYTES * 8), np.uint8)
    place = np.arange(len(found)) // LOAD
    for k in range(HASHES):
        bits[place, (found >> np.uint64(11 * k)) & np.uint64(FILTER_BYTES * 8 - 1)] = 1
    return np.packbits(bits, axis=1)


def fingerprint(text: str, surprisal: np.ndarray) -> np.ndarray:
    return chain(features(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), surprisal))


def written(filters: np.ndarray) -> str:
    return base64.b64encode(filters.tobytes()).decode("ascii")


def read(value: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(value), np.uint8).reshape(-1, FILTER_BYTES)


def _best(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    ones_b = np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    out = np.zeros(len(a))
    for i, row in enumerate(a):
        ones = int(np.bitwise_count(row).sum(dtype=np.int64))
        common = np.bitwise_count(b & row).sum(axis=1, dtype=np.int64)
        chance = ones * ones_b / (FILTER_BYTES * 8)
        most = np.minimum(ones, ones_b)
        out[i] = np.max((common - chance) / np.maximum(most - chance, 1e-9))
    return np.clip(out, 0, 1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: mean share of common bits over chance, of each filter with its best partner, both ways."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if a.shape == b.shape and (a == b).all():
        return 1.0
    return float((_best(a, b).sum() + _best(b, a).sum()) / (len(a) + len(b)))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, next_text): the following text in descending order of ids, around in a ring.

    Ids are cut into ranges of bounded size. The first text of a range is also sent to the range
    before it, so texts are shuffled once and no task sees more than a range.
    """
    spark = prepared(docs.sparkSession)
    ids = docs.select(F.col(id_col).cast("bigint").alias("id"))
    rows = ids.count()
    ranges = min(MOST_RANGES, max(1, rows // RANGE_ROWS))
    points = split_points(ids.where("id is not null"), "id", ranges) if ranges > 1 else []
    finer = max(1, math.ceil(rows / RANGE_ROWS / MOST_RANGES))

    def tagged(frame: DataFrame) -> DataFrame:
        out = tag_range(frame, "id", points)
        out = out.withColumn("bucket", F.when(F.col("id").isNull(), -1).otherwise(F.col("_range")).cast("bigint") * finer)
        if finer > 1:  # very many rows: ranges are cut again, evenly by id
            ends = tag_range(ids, "id", points).where("id is not null").groupBy("_range").agg(F.min("id").alias("_low"), F.max("id").alias("_high"))
            out = out.join(ends, "_range", "left").withColumn("bucket", F.col("bucket") + F.coalesce(
                F.floor((F.col("id") - F.col("_low")) * F.lit(float(finer)) / (F.col("_high") - F.col("_low") + 1)), F.lit(0)))
        return out

    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    base = tagged(docs.select(F.col(id_col).cast("bigint").alias("id"), text)).select("id", "text", "bucket")
    tops = tagged(ids).groupBy("bucket").agg(F.max("id").alias("top"))
    order = Window.orderBy(F.desc("bucket"))  # one row per range
    first = F.max("bucket").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    lowest = F.min("bucket").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    tops = stored(tops.select("bucket", "top", F.when(F.col("bucket") == first, lowest).otherwise(F.lag("bucket").over(order)).alias("to")))
    guests = base.join(tops.withColumnRenamed("bucket", "_b"), (F.col("bucket") == F.col("_b")) & F.col("id").eqNullSafe(F.col("top"))).select(
        "id", "text", F.col("to").alias("bucket"), F.lit(1).alias("guest"))
    both = base.withColumn("guest", F.lit(0)).unionByName(guests)
    following = Window.partitionBy("bucket").orderBy("guest", F.desc_nulls_last("id"), "text")
    return both.withColumn("next_text", F.lead("text").over(following)).where("guest = 0").select("id", "text", "next_text")


def edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: np.ndarray | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likenesses.

    The edited form has its last half replaced by the beginning of the next text.
    """
    spark = prepared(docs.sparkSession)
    shared = spark.sparkContext.broadcast(learn(docs, text_col) if model is None else model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surprisal = shared.value
        known: tuple[str, np.ndarray] | None = None
        for batch in batches:
            out: list[tuple] = []
            for text, after in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = known[1] if known and known[0] == text else fingerprint(text, surprisal)
                half = len(text) // 2
                edited = text[: len(text) - half] + after[:half]
                other = fingerprint(edited, surprisal)
                following = own if after == text else fingerprint(after, surprisal)
                known = after, following
                out.append((len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), written(own), written(other),
                            likeness(own, other), likeness(own, following)))
            columns = list(zip(*out)) if out else [()] * 6
            kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                                             ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return with_next(docs, id_col, text_col).mapInArrow(
        work, "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
