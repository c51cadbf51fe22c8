"""Splits, folds and samples drawn by hashing the row key.

A draw depends on key and seed only: it is the same after a repartition, a retry or a
restart. Exact sizes come from counting hash prefixes, not from sorting the rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from millrace.functions.hashing import hash_fraction, hash_number, hash_points, hash_text
from millrace.operators.ordered import default_ranges, number_rows

HALF = 1 << 16


def split_by_fraction(df: DataFrame, key: str, fraction: float, seed: int | str) -> tuple[DataFrame, DataFrame]:
    """About ``fraction`` of the rows, and the rest; needs no shuffle.

    A split of a split needs another seed, or the second one finds only rows of one side.
    """
    chosen = hash_fraction(key, seed) < fraction
    return df.where(chosen), df.where(~chosen)


def random_positions(df: DataFrame, key: str, seed: int, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Position of every row in a random order, per ``by`` group if given."""
    ordered = df.withColumn("_random", hash_text(key, seed))
    points = hash_points(default_ranges(df))
    return number_rows(ordered, "_random", name, by=by, points=points).drop("_random")


def _cut(counts: list[tuple], wanted: Mapping) -> dict:
    """Per class: the prefix where the running count reaches the wanted size, and what is left."""
    reached, cuts = {}, {}
    for group, prefix, n in sorted(counts, key=lambda c: (str(c[0]), c[1])):
        before = reached.get(group, 0)
        reached[group] = before + n
        if group in wanted and before < wanted[group] <= reached[group]:
            cuts[group] = (prefix, wanted[group] - before)
    return cuts


def sample_exact(df: DataFrame, key: str, wanted: int | Mapping, seed: int | str, by: str | None = None) -> DataFrame:
    """Exactly ``wanted`` rows (per class of ``by`` if a mapping), those first in hash order.

    The 32-bit border of every class is found by counting the upper, then the lower 16 bits;
    at most 65 536 counts per class reach the driver. All rows below the border pass a plain
    filter; the few that share the border value are ordered by the full hash.
    """
    sizes = dict(wanted) if by else {None: wanted}
    group = F.col(by) if by else F.lit(None).cast("string")
    drawn = df.select("*", group.alias("_group"), hash_number(key, seed).alias("_draw"))

    def counted(rows: DataFrame, prefix) -> list[tuple]:
        return [tuple(r) for r in rows.groupBy("_group", prefix.alias("_prefix")).count().collect()]

    totals: dict = {}
    upper = counted(drawn, F.floor(F.col("_draw") / HALF))
    for g, _, n in upper:
        totals[g] = totals.get(g, 0) + n
    whole = [g for g in sizes if g in totals and sizes[g] >= totals[g]]
    cuts = _cut(upper, {g: n for g, n in sizes.items() if g not in whole and n > 0})

    def of(g):
        return F.col("_group").eqNullSafe(F.lit(g))

    taken = F.lit(False)
    for g in whole:
        taken = taken | of(g)
    parts = []
    if cuts:
        border = F.lit(False)
        for g, (prefix, _) in cuts.items():
            border = border | (of(g) & (F.floor(F.col("_draw") / HALF) == prefix))
        lower = _cut(counted(drawn.where(border), F.col("_draw") % HALF), {g: r for g, (_, r) in cuts.items()})
        for g, (prefix, _) in cuts.items():
            low, rest = lower[g]
            value = prefix * HALF + low
            taken = taken | (of(g) & (F.col("_draw") < value))
            parts.append(drawn.where(of(g) & (F.col("_draw") == value))
                         .orderBy(hash_text(key, seed)).limit(rest))
    sample = drawn.where(taken)
    for part in parts:
        sample = sample.unionByName(part)
    return sample.drop("_group", "_draw")


def class_sizes(df: DataFrame, label: str) -> dict:
    return {row[0]: row[1] for row in df.groupBy(label).count().collect()}


def sample_percent(df: DataFrame, key: str, percent: int, seed: int) -> DataFrame:
    """``percent`` rows of every full hundred."""
    return sample_exact(df, key, df.count() // 100 * percent, seed)


def stratified_split(df: DataFrame, key: str, label: str, test_size: float, seed: int) -> DataFrame:
    """Add ``is_test``: floor(test_size * n) rows of every class."""
    sizes = {g: int(test_size * n) for g, n in class_sizes(df, label).items()}
    test = sample_exact(df.select(key, label), key, sizes, seed, by=label).select(key, F.lit(True).alias("is_test"))
    return df.join(test, key, "left").na.fill({"is_test": False})


def stratified_folds(df: DataFrame, key: str, label: str, folds: int, seed: int, name: str = "fold") -> DataFrame:
    """Fold number per row; the folds of a class differ by at most one row."""
    placed = random_positions(df, key, seed, "_place", by=(label,))
    return placed.withColumn(name, (F.col("_place") % folds).cast("int")).drop("_place")


def undersample(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    """Every class cut to the size of the smallest one."""
    sizes = class_sizes(df, label)
    smallest = min(sizes.values())
    return sample_exact(df, key, {g: smallest for g in sizes}, seed, by=label)
