"""Reading delimited files: plain, gzip, zip; typed, projected, with provenance."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Letters of a positional type string.
TYPE_LETTERS = {"n": T.DoubleType(), "D": T.DateType(), "c": T.StringType(),
                "i": T.LongType(), "l": T.BooleanType(), "T": T.TimestampNTZType()}

BATCH_ROWS = 50_000


def spread(df: DataFrame) -> DataFrame:
    """Even partitions after a scan with fewer splits than the cluster has cores.

    Meant for files that cannot be split (gzip, zip archives, single row groups) and for scans
    followed by heavy work per row; a scan that already fills the cluster is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             columns: Sequence[str] | None = None, separator: str = ",", null_text: str = "",
             timestamp_format: str | None = None, unsplittable: bool = False) -> DataFrame:
    """CSV or TSV with a header, an empty field being null; gzip is told by the file name.

    Give a schema wherever it is known: without one the files are read twice to infer it.
    ``columns`` is passed down to the parser, which skips the other fields.
    """
    reader = (spark.read.option("header", True).option("sep", separator)
              .option("nullValue", null_text).option("encoding", "UTF-8"))
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema).option("enforceSchema", False)
    frame = reader.csv(path)
    if columns:
        frame = frame.select(*columns)
    return spread(frame) if unsplittable else frame


def positional_schema(names: Sequence[str], letters: str) -> T.StructType:
    """Schema from column names and a type string such as ``nnDnnnncc``."""
    if len(names) != len(letters):
        raise ValueError(f"{len(names)} columns but {len(letters)} type letters")
    return T.StructType([T.StructField(n, TYPE_LETTERS[k]) for n, k in zip(names, letters)])


def read_typed_csv(spark: SparkSession, path: str, names: Sequence[str], letters: str) -> DataFrame:
    """CSV with a positional type string; a field that does not fit its type is an error."""
    return (spark.read.schema(positional_schema(names, letters))
            .option("header", True).option("mode", "FAILFAST").csv(path))


def read_tsv(spark: SparkSession, path: str, schema=None, columns=None) -> DataFrame:
    return read_csv(spark, path, schema, columns, separator="\t")


def archives(spark: SparkSession, path: str) -> DataFrame:
    """Zip archives matched by ``path`` as (path, content) rows."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def unzip_csv(packed: DataFrame, schema: T.StructType, separator: str = ",") -> DataFrame:
    """Rows of every CSV inside (path, content) zip archives, cast to ``schema``.

    One task unpacks one archive and passes its rows on in batches, never whole.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.namelist():
                        if member.endswith("/"):
                            continue
                        with archive.open(member) as lines:
                            yield from pd.read_csv(lines, sep=separator, dtype=str, chunksize=BATCH_ROWS,
                                                   encoding="utf-8-sig", usecols=list(texts.names),
                                                   keep_default_na=False, na_values=[""])

    def ordered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in unpack(batches):
            yield chunk[list(texts.names)].astype(object).where(chunk[list(texts.names)].notna(), None)

    rows = packed.select("content").mapInPandas(ordered, texts)
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_zip_csv(spark: SparkSession, path: str, schema: T.StructType, separator: str = ",") -> DataFrame:
    packed = archives(spark, path)
    return spread(unzip_csv(packed, schema, separator))


def read_with_provenance(spark: SparkSession, glob: str, schema: T.StructType | str) -> DataFrame:
    """All files matched by a glob, each row with the ``file`` it came from."""
    frame = spark.read.schema(schema).option("header", True).csv(glob)
    return frame.select("*", F.col("_metadata.file_path").alias("file"))
