"""One-hot columns and integer codes for categories."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from millrace.operators.aggregates import distinct_counts, small_levels
from millrace.operators.ordered import number_rows
from millrace.operators.relational import columns_of


class OneHotModel:
    """0/1 column ``column_value`` per learned value; nulls and unseen values are all 0."""

    def __init__(self, levels: Mapping[str, Sequence]):
        self.levels = {c: list(v) for c, v in levels.items()}

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], drop_one_seed: int | None = None) -> OneHotModel:
        """``drop_one_seed`` leaves one value out per column, to avoid collinear columns."""
        levels = {c: small_levels(df, c) for c in columns}
        if drop_one_seed is not None:
            draw = random.Random(drop_one_seed)
            for c, values in levels.items():
                values.remove(draw.choice(values))
        return cls(levels)

    def transform(self, df: DataFrame) -> DataFrame:
        columns = {f"{c}_{v}": F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0))
                   for c, values in self.levels.items() for v in values}
        return df.withColumns(columns).drop(*self.levels)


def onehot_low_cardinality(df: DataFrame, max_values: int) -> tuple[OneHotModel, list[str]]:
    """Model for the text columns with few values, and the text columns to drop."""
    texts = columns_of(df, "string")
    few = {row["column"] for row in
           distinct_counts(df, texts).where(F.col("n_unique") <= max_values).collect()}
    return OneHotModel.fit(df, [c for c in texts if c in few]), [c for c in texts if c not in few]


SMALL_LEVELS = 20_000
"""Up to about this many distinct values are numbered by one sort in one task."""


def _number(levels: DataFrame, size: int, order: str, start: int) -> DataFrame:
    if size > SMALL_LEVELS:
        return number_rows(levels, order, "code", start=start)
    place = F.row_number().over(Window.orderBy(order)) - 1 + start
    return levels.withColumn("code", place.cast("bigint"))


def sorted_levels(df: DataFrame, column: str, start: int = 0) -> DataFrame:
    """(column, code): codes in sorted (byte) order of the distinct values."""
    size = df.agg(F.approx_count_distinct(column)).first()[0]
    return _number(df.select(column).where(F.col(column).isNotNull()).distinct(), size, column, start)


def first_seen_levels(df: DataFrame, column: str, order: str, start: int = 0) -> DataFrame:
    """(column, code): codes in order of first appearance along a unique ``order``."""
    size = df.agg(F.approx_count_distinct(column)).first()[0]
    first = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(order).alias("_first"))
    return _number(first, size, "_first", start).select(column, "code")


def encode(df: DataFrame, levels: DataFrame, column: str, name: str, unseen: int | None = None) -> DataFrame:
    """Add ``name``, the code of ``column``. An unseen value fails unless ``unseen`` is given."""
    coded = df.join(levels.withColumnRenamed("code", name), column, "left")
    if unseen is not None:
        return coded.withColumn(name, F.coalesce(F.col(name), F.lit(unseen)))
    failure = F.raise_error(F.concat(F.lit(f"unseen value of {column}: "), F.col(column).cast("string")))
    return coded.withColumn(
        name, F.when(F.col(name).isNull() & F.col(column).isNotNull(), failure.cast("bigint"))
        .otherwise(F.col(name)))
