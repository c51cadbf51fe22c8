"""Seeded numbers that depend on the row key only, so a re-run task draws the same ones."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_RANGE = 1 << 32


def hash_text(key: Column | str, seed: int | str) -> Column:
    """md5("<key>:<seed>") as text: a random order, unique for unique keys."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def hash_points(ranges: int) -> list[str]:
    """Borders that cut ``hash_text`` into equally likely ranges."""
    return [f"{i * HASH_RANGE // ranges:08x}" for i in range(1, ranges)]


def hash_number(key: Column | str, seed: int | str) -> Column:
    """First 32 bits of md5("<key>:<seed>") as a number in 0 .. 2^32-1."""
    return F.conv(F.substring(hash_text(key, seed), 1, 8), 16, 10).cast("bigint")


def hash_fraction(key: Column | str, seed: int | str) -> Column:
    """The same draw scaled to [0, 1)."""
    return hash_number(key, seed) / F.lit(float(HASH_RANGE))
