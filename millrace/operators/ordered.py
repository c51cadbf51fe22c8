"""Work that needs a global order: exact order statistics, running totals, row numbers.

None of it sorts an un-aggregated input in one task. The order is cut into ranges by
split points found beforehand; each range is sorted on its own and the totals of the
ranges before it are added. Split points are literals, so they affect balance only and
every re-run of a task puts a row in the same range.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

RANGES = 512
"""Ranges a column is cut into when order statistics are looked up."""
DIRECT_LIMIT = 50_000
"""Up to this many values a column is put in order without cutting it first."""
EXACT_LIMIT = 2_000_000
"""Rows a wanted range may hold before its order is spread over tasks as well."""

SAMPLE_PER_RANGE = 64
"""Rows sampled per range to place its borders."""
LEVELS_PER_RANGE = 16
"""Distinct texts sampled per range; these reach the driver (65 536 at most)."""


def default_ranges(df: DataFrame) -> int:
    """As many ranges as a shuffle has partitions, within bounds the driver can hold."""
    return min(4096, max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))))


def split_points(df: DataFrame, column: str, ranges: int | None = None) -> list:
    """Values that cut ``column`` into about ``ranges`` equally filled ranges."""
    ranges = ranges or default_ranges(df)
    kind = df.schema[column].dataType
    if isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        shares = [i / ranges for i in range(1, ranges)]
        found = df.agg(F.percentile_approx(column, shares, 10 * ranges)).first()[0] or []
    else:
        # A hash order picks a repeatable uniform sample of the distinct values.
        sample = (
            df.select(column).where(F.col(column).isNotNull()).distinct()
            .orderBy(F.xxhash64(column)).limit(LEVELS_PER_RANGE * ranges)
        )
        values = sorted((row[0] for row in sample.collect()),
                        key=lambda v: v.encode("utf-8") if isinstance(v, str) else v)
        step = max(1, len(values) // ranges)
        found = values[step::step]
    points = []
    for value in found:
        if value is not None and (not points or value != points[-1]):
            points.append(value)
    return points


def tag_range(df: DataFrame, column: str, points: Sequence, name: str = "_range") -> DataFrame:
    """Add the number of the range a value falls into; ranges keep the order of the values."""
    if not points:
        return df.withColumn(name, F.lit(0))
    if isinstance(df.schema[column].dataType, T.NumericType):
        borders = [-float("inf"), *sorted({float(p) for p in points}), float("inf")]
        if len(borders) > 3:
            cut = Bucketizer(splits=borders, inputCol="_as_double", outputCol="_cut", handleInvalid="keep")
            tagged = cut.transform(df.withColumn("_as_double", F.col(column).cast("double")))
            return tagged.withColumn(name, F.col("_cut").cast("int")).drop("_as_double", "_cut")
    return df.withColumn(name, _points_below(F.col(column), points))


def _points_below(column: Column, points: Sequence) -> Column:
    """Number of split points below a value of any ordered type, by binary search."""
    table = F.array(*[F.lit(p) for p in points])
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(points)).alias("hi"))

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
        inside = state["lo"] < state["hi"]
        right = inside & (F.get(table, middle) < column)
        return F.struct(
            F.when(right, middle + 1).otherwise(state["lo"]).alias("lo"),
            F.when(inside & ~F.coalesce(right, F.lit(False)), middle).otherwise(state["hi"]).alias("hi"),
        )

    rounds = F.sequence(F.lit(1), F.lit(len(points).bit_length()))
    return F.aggregate(rounds, start, halve, lambda state: state["lo"])


def running_totals(
    df: DataFrame,
    order: str,
    totals: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    points: Sequence | None = None,
) -> DataFrame:
    """Add ``<c>_before``: the sum of ``c`` over the rows ordered earlier in the same ``by``.

    ``order`` must be unique within ``by``. A ``by`` group of any size is spread over the
    ranges; the second window runs on one row per (group, range). ``points`` are the range
    borders where they are known beforehand.
    """
    by = list(by)
    points = split_points(df, order) if points is None else points
    tagged = tag_range(df, order, points)
    direction = F.desc if descending else F.asc
    blocks = tagged.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in totals])
    earlier_blocks = (
        Window.partitionBy(*by).orderBy(direction("_range"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = blocks.select(
        *[F.col(b).alias(f"_by_{b}") for b in by],
        F.col("_range").alias("_block"),
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier_blocks), F.lit(0)).alias(f"_offset_{c}")
          for c in totals],
    )
    earlier_rows = (
        Window.partitionBy(*by, "_range").orderBy(direction(order))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = tagged.select("*", *[
        F.coalesce(F.sum(c).over(earlier_rows), F.lit(0)).alias(f"_inside_{c}") for c in totals])
    match = F.col("_range") == F.col("_block")
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    return inside.join(offsets, match).select(
        *df.columns,
        *[(F.col(f"_inside_{c}") + F.col(f"_offset_{c}")).alias(f"{c}_before") for c in totals],
    )


def number_rows(
    df: DataFrame,
    order: str,
    name: str,
    by: Sequence[str] = (),
    start: int = 0,
    points: Sequence | None = None,
) -> DataFrame:
    """Contiguous numbers along a unique ``order`` column, per ``by`` group if given."""
    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    numbered = running_totals(ones, order, ["_one"], by, points=points)
    return numbered.select(*df.columns, (F.col("_one_before") + F.lit(start)).cast("bigint").alias(name))


def order_statistics(
    df: DataFrame, ranks: Mapping[str, Callable[[int], Sequence[int]]]
) -> dict[str, tuple[int, list]]:
    """Exact values at 0-based ranks of several numeric columns, nulls left out.

    ``ranks[c]`` maps the number of known values of ``c`` to the ranks wanted. The result
    holds, per column, that number and the values as doubles. All columns share a few jobs:
    percentiles of a sample cut each column into ranges, the rows per range are counted, and
    only the ranges that hold a wanted rank are put in order, as (value, count) pairs.
    """
    names = list(ranks)
    known = df.agg(*[F.count(c).alias(f"n_{i}") for i, c in enumerate(names)]).first()
    counts = {c: known[f"n_{i}"] for i, c in enumerate(names)}
    wanted = {c: list(ranks[c](counts[c])) if counts[c] else [] for c in names}

    doubles = df.select([F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(names)])
    large = [i for i, c in enumerate(names) if counts[c] > DIRECT_LIMIT]
    borders: dict[int, list] = {}
    if large:
        # a sample is enough: the borders decide how even the ranges are, not what is found
        part = min(1.0, RANGES * SAMPLE_PER_RANGE / max(counts[names[i]] for i in large))
        shares = [i / RANGES for i in range(1, RANGES)]
        cuts = doubles.sample(part, 0).agg(*[
            F.percentile_approx(f"_v{i}", shares, 10 * RANGES).alias(f"q_{i}") for i in large]).first()
        borders = {i: sorted(set(cuts[f"q_{i}"] or [])) for i in large}
    for i in range(len(names)):
        doubles = tag_range(doubles, f"_v{i}", borders.get(i, []), f"_r{i}")
    spans = [F.struct(F.lit(i).alias("span"), F.col(f"_r{i}").alias("range"), F.col(f"_v{i}").alias("v"))
             for i in range(len(names))]
    if len(names) == 1:
        rows = doubles.select(spans[0].alias("e")).select("e.*")
    else:
        rows = doubles.select(F.explode(F.array(*spans)).alias("e")).select("e.*")
    rows = rows.where(F.col("v").isNotNull())

    before: dict[tuple[int, int], int] = {}
    sizes: dict[tuple[int, int], int] = {}
    if large:
        running: dict[int, int] = {}
        for span, part, n in sorted(tuple(r) for r in rows.groupBy("span", "range").count().collect()):
            before[span, part], sizes[span, part] = running.get(span, 0), n
            running[span] = running.get(span, 0) + n
    else:
        for i, c in enumerate(names):
            before[i, 0], sizes[i, 0] = 0, counts[c]

    targets: dict[tuple[int, int], list[int]] = {}
    for i, c in enumerate(names):
        for rank in sorted(set(wanted[c])):
            cell = next(k for k in before if k[0] == i and before[k] <= rank < before[k] + sizes[k])
            targets.setdefault(cell, []).append(rank - before[cell])
    if not targets:
        return {c: (counts[c], []) for c in names}

    def any_of(tests: list[Column]) -> Column:
        return functools.reduce(lambda a, b: a | b, tests)

    inside = any_of([(F.col("span") == s) & F.col("range").isin([r for t, r in targets if t == s])
                     for s in {k[0] for k in targets}])
    histogram = rows.where(inside).groupBy("span", "range", "v").agg(F.count("*").alias("n"))
    if max(sizes[k] for k in targets) > EXACT_LIMIT:
        summed = running_totals(histogram, "v", ["n"], by=["span", "range"])
    else:
        earlier = Window.partitionBy("span", "range").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
        summed = histogram.withColumn("n_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    found = summed.where(any_of([
        (F.col("span") == span) & (F.col("range") == part)
        & any_of([(F.col("n_before") <= p) & (F.col("n_before") + F.col("n") > p) for p in places])
        for (span, part), places in targets.items()])).collect()
    values = {}
    for (span, part), places in targets.items():
        for row in found:
            if (row["span"], row["range"]) == (span, part):
                for p in places:
                    if row["n_before"] <= p < row["n_before"] + row["n"]:
                        values[names[span], before[span, part] + p] = row["v"]
    return {c: (counts[c], [values[c, rank] for rank in wanted[c]]) for c in names}


def quantiles(df: DataFrame, shares: Mapping[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """Exact linear-interpolation quantiles of several columns in the same few jobs."""

    def around(probabilities):
        def ranks(n):
            places = [p * (n - 1) for p in probabilities]
            return [r for x in places for r in (math.floor(x), math.ceil(x))]
        return ranks

    found = order_statistics(df, {c: around(p) for c, p in shares.items()})
    result = {}
    for c, probabilities in shares.items():
        n, values = found[c]
        if not n:
            result[c] = [None] * len(probabilities)
            continue
        line = []
        for i, p in enumerate(probabilities):
            low, high = float(values[2 * i]), float(values[2 * i + 1])
            place = p * (n - 1)
            line.append(low if low == high else low + (high - low) * (place - math.floor(place)))
        result[c] = line
    return result


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    return {c: q[0] for c, q in quantiles(df, {c: [0.5] for c in columns}).items()}
