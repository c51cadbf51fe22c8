"""Column functions: numbers, dates, text. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# numbers

def tier_code(c: Column | str) -> Column:
    """0, 1, 2, 3 for values up to 1, up to 2, up to 3 and above; null stays null."""
    c = _col(c)
    return F.when(c <= 1, 0).when(c <= 2, 1).when(c <= 3, 2).when(c > 3, 3)


def in_set_flag(c: Column | str, members: Sequence) -> Column:
    """1 for members, 0 for everything else including null."""
    return F.coalesce(_col(c).isin(list(members)), F.lit(False)).cast("int")


def snap_near_zero(c: Column | str, decimals: int = 5) -> Column:
    """Exactly 0 where the value rounds to 0, the value itself elsewhere."""
    c = _col(c)
    return F.when(round_half_even(c, decimals) == 0, F.lit(0.0)).otherwise(c)


def round_half_even(c: Column | str, decimals: int = 5) -> Column:
    """Scale, round to the nearest integer with ties to even, scale back (binary doubles)."""
    scale = F.lit(float(10 ** decimals))
    return F.rint(_col(c) * scale) / scale


def clip(c: Column | str, low: float, high: float) -> Column:
    return F.greatest(F.least(_col(c), F.lit(high)), F.lit(low))


def clip_probability(c: Column | str, eps: float = 1e-15) -> Column:
    return clip(c, eps, 1.0 - eps)


def letters_to_int(c: Column | str) -> Column:
    """Base-26 value of a word, a or A = 1 ... z or Z = 26."""
    digits = F.transform(F.split(F.lower(_col(c)), ""), lambda ch: F.ascii(ch).cast("bigint") - 96)
    return F.aggregate(digits, F.lit(0).cast("bigint"), lambda value, digit: value * 26 + digit)


def row_total(columns: Sequence[Column | str]) -> Column:
    """Sum over columns of one row, nulls counted as 0."""
    total = F.lit(0)
    for c in columns:
        total = total + F.coalesce(_col(c), F.lit(0))
    return total


def row_mean(columns: Sequence[Column | str]) -> Column:
    """Mean over the known values of one row; null when none is known."""
    known = F.array_compact(F.array(*[_col(c).cast("double") for c in columns]))
    total = F.aggregate(known, F.lit(0.0), lambda a, v: a + v)
    return F.try_divide(total, F.size(known))


def row_median(columns: Sequence[Column | str]) -> Column:
    """Median over the known values of one row; null when none is known."""
    known = F.array_sort(F.array_compact(F.array(*[_col(c).cast("double") for c in columns])))
    n = F.size(known)
    low = F.get(known, F.floor((n - 1) / 2).cast("int"))
    high = F.get(known, F.floor(n / 2).cast("int"))
    return (low + high) / 2


# dates

def years_since_month(year: Column | str, month: Column | str,
                      reference: float = 2015.75, missing: float = -1.0) -> Column:
    """Fractional years from the first of a month to ``reference`` (2015.75 = October 2015)."""
    start = _col(year) + (_col(month) - 1) / F.lit(12.0)
    return F.coalesce(F.lit(reference) - start, F.lit(missing))


def monday_of_week(year: Column | str, week: Column | str) -> Column:
    """Monday of a Sunday-based week: week 1 starts at the first Sunday of the year."""
    new_year = F.make_date(_col(year).cast("int"), F.lit(1), F.lit(1))
    first_sunday = F.date_add(new_year, (F.lit(8) - F.dayofweek(new_year)) % 7)
    return F.date_add(first_sunday, (_col(week).cast("int") - 1) * 7 + 1)


def days_since_year_week(year: Column | str, week: Column | str,
                         reference: str = "2015-10-01", missing: int = -1) -> Column:
    """Days from the Monday of that week to ``reference``."""
    days = F.datediff(F.lit(reference).cast("date"), monday_of_week(year, week))
    return F.coalesce(days, F.lit(missing))


# text

def concat_key(*columns: Column | str) -> Column:
    """Composite category; null when any part is null."""
    return F.concat(*[_col(c).cast("string") for c in columns])


def prefix_token(prefix: str, c: Column | str) -> Column:
    """``prefix:value``, with ``nan`` in place of null."""
    return F.concat(F.lit(prefix + ":"), F.coalesce(_col(c).cast("string"), F.lit("nan")))


def zero_padded(prefix: str, c: Column | str, width: int) -> Column:
    """``prefix`` and the number, padded with zeros up to ``width`` digits."""
    digits = _col(c).cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) < width, F.lpad(digits, width, "0"))
                    .otherwise(digits))


def bucket_name(name: str) -> str:
    """Name of the bucket column derived from ``name``."""
    return f"{name}_bucket".lower().replace(" ", "").replace(".0", "")


def bucket_name_of(c: Column | str) -> Column:
    """The same derivation for names held in a column."""
    lowered = F.lower(F.concat(_col(c), F.lit("_bucket")))
    return F.replace(F.replace(lowered, F.lit(" "), F.lit("")), F.lit(".0"), F.lit(""))


def word_set(c: Column | str) -> Column:
    """Distinct lower-case words of two or more letters, digits or underscores."""
    return F.array_distinct(F.regexp_extract_all(F.lower(_col(c)), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0)))
