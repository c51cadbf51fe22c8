"""Text quality by hierarchical empirical Bayes.

A logistic model over shape features of the whole text gives each document's evidence. The mean
evidence of each host and of each path of a host, over all documents, is shrunk toward the level
above: path to host, host to the global prior. How strongly is learned from the spread between
the groups (method of moments). A document's evidence is then combined with the prior of its
path, from which its own evidence is left out.

The model is fitted on at most ``SAMPLE`` labelled documents in hash order of their ids. Null and
empty texts have all features 0 and are scored so; null hosts and paths are groups of their own;
null labels are not learned from; rows that repeat an id are scored each. Without labels the
evidence is the same everywhere; without rows there are none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm import arrays
from millrace.llm.shared import chance, fit_logistic, prepared, stored

SAMPLE = 20_000
GROUPS = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!", b"|", b"#$%&*", b".,;:?", b"\n")


@dataclass
class Shape:
    weights: np.ndarray
    center: np.ndarray
    spread: np.ndarray


def shape_of(column: pa.Array) -> np.ndarray:
    """Logarithm of the words, mean word length and shares of kinds of bytes, with their squares."""
    data, offsets = arrays.flat(column)
    size = np.maximum(np.diff(offsets), 1)
    starts, ends, text = arrays.word_spans(data, offsets)
    words = np.bincount(text, minlength=len(column))
    parts = [np.log1p(words), np.bincount(text, weights=ends - starts, minlength=len(column)) / np.maximum(words, 1)]
    for group in GROUPS:
        inside = np.zeros(256, bool)
        inside[list(group)] = True
        parts.append(np.sqrt(arrays.sums(inside[data], offsets) / size))
    parts.append(arrays.sums(data >= 128, offsets) / size)
    x = np.column_stack(parts)
    return np.column_stack([x, x * x])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Shape:
    prepared(docs.sparkSession)
    chosen = (labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("bigint").alias("id"))
              .agg(F.min("quality").cast("double").alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrays.pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(shape_of(piece.column("text")).tolist(), pa.list_(pa.float64()))],
                                             ["id", "y", "x"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text")).where("text is not null")
    # at most ``sample`` rows of two numbers, so sending them to every task is bounded
    rows = texts.join(F.broadcast(chosen), "id").select("id", "y", "text").mapInArrow(work, "id bigint, y double, x array<double>").dropDuplicates(["id"]).orderBy("id").toArrow()
    width = 2 * (len(GROUPS) + 3)
    x = np.array(rows["x"].to_pylist(), float).reshape(-1, width)
    y = rows["y"].to_numpy(zero_copy_only=False) if rows.num_rows else np.zeros(0)
    center = x.mean(axis=0) if len(x) else np.zeros(width)
    spread = np.maximum(x.std(axis=0), 1e-6) if len(x) else np.ones(width)
    if len(x) == 0:
        return Shape(np.zeros(width + 1), center, spread)
    return Shape(fit_logistic(((x - center) / spread).astype(np.float32), (np.asarray(y) > 0.5).astype(np.float32), 0.1, 400, even=False), center, spread)


def evidence(docs: DataFrame, shape: Shape, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, host, path, evidence) of every row."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in arrays.pieces(batches, "text"):
            p = chance((shape_of(piece.column("text")) - shape.center) / shape.spread, shape.weights)
            yield pa.RecordBatch.from_arrays([*piece.columns[:3], pa.array(np.clip(p, 0.001, 0.999))], ["id", "host", "path", "evidence"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.concat(F.lit("s"), host.cast("string")), F.lit("n")).alias("host"),
                       F.coalesce(F.concat(F.lit("s"), path.cast("string")), F.lit("n")).alias("path"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, "id bigint, host string, path string, evidence double")


def _strength(groups: DataFrame, mean: str) -> Column | float:
    """Documents that the level above counts as: variance within groups over variance between them."""
    found = groups.agg(F.sum("within").alias("w"), F.sum("n").alias("n"), F.count("*").alias("g"),
                       F.sum(F.col("n") * (F.col("sum") / F.col("n") - F.col(mean)) ** 2).alias("b"), F.sum(F.col("n") * F.col("n")).alias("nn")).first()
    if not found["g"] or found["g"] < 2 or found["n"] <= found["g"]:
        return 10.0
    within = max(found["w"] / (found["n"] - found["g"]), 1e-9)
    between = (found["b"] - (found["g"] - 1) * within) / max(found["n"] - found["nn"] / found["n"], 1e-9)
    return float(min(max(within / between, 1.0), 1e6)) if between > 0 else 1e6


def combine(scored: DataFrame) -> DataFrame:
    """(id, evidence, host_prior, path_prior, quality) from (id, host, path, evidence).

    Groups are aggregated, never gathered: a host with a third of all rows is one row of sums.
    """
    square = F.col("evidence") * F.col("evidence")
    paths = stored(scored.groupBy("host", "path").agg(F.sum("evidence").alias("sum"), F.count("*").alias("n"), F.sum(square).alias("squares"))
                   .withColumn("within", F.col("squares") - F.col("sum") * F.col("sum") / F.col("n")))
    hosts = paths.groupBy("host").agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"), F.sum("squares").alias("squares")).withColumn(
        "within", F.col("squares") - F.col("sum") * F.col("sum") / F.col("n"))
    whole = hosts.agg(F.sum("sum").alias("s"), F.sum("n").alias("n")).first()
    prior = whole["s"] / whole["n"] if whole["n"] else 0.5
    at_host = _strength(hosts.withColumn("mean", F.lit(prior)), "mean")
    named = hosts.select("host", F.col("sum").alias("host_sum"), F.col("n").alias("host_n"))
    both = paths.join(named, "host").withColumn("mean", F.col("host_sum") / F.col("host_n"))
    at_path = _strength(both, "mean")
    sums = stored(both.select("host", "path", "sum", "n", "host_sum", "host_n"))
    rows = scored.join(sums, ["host", "path"])
    own = F.col("evidence")
    host = (F.col("host_sum") - own + at_host * prior) / (F.col("host_n") - 1 + at_host)
    rows = rows.withColumn("host_prior", host).withColumn(
        "path_prior", (F.col("sum") - own + at_path * F.col("host_prior")) / (F.col("n") - 1 + at_path))
    odds = lambda p: F.log(p / (1.0 - p))
    level = odds(own) + odds(F.least(F.greatest("path_prior", F.lit(0.001)), F.lit(0.999))) - odds(F.lit(min(max(prior, 0.001), 0.999)))
    return rows.select("id", "evidence", "host_prior", "path_prior", (1.0 / (1.0 + F.exp(-level))).alias("quality"))


def quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id with its evidence, the priors of its site and the combined probability of good text."""
    prepared(docs.sparkSession)
    return combine(stored(evidence(docs, fit(docs, labels), host, path, id_col, text_col)))
