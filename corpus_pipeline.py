"""Corpus pipeline: toxic text, near copies, benchmark passages, personal data, source mixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import decontamination, mixing, near_copies, private_data, toxicity
from millrace.llm.shared import prepared
from millrace.session import scratch_folder


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    prepared(spark)
    chain = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = toxicity.predict(docs, chain).where(~F.col("rejected"))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    return near_copies.without_copies(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepared(spark)
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind."""
    return private_data.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mixture takes each document."""
    return mixing.mix(docs).select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "rate", "copies", "taken")


STAGES = [("toxicity", reject_toxic), ("near_copies", drop_near_copies), ("decontamination", decontaminate),
          ("private_data", mask_private_data), ("mixing", mix_sources)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again by the next."""
    prepared(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k + 1 == len(STAGES):
            return out
        path = scratch_folder(spark)
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
