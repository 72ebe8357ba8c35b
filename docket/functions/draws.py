"""Seeded draws from md5, so every engine and every retry draws the same."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def hash_order(key: Column | str, seed) -> Column:
    """Hex text whose order is a random permutation of the keys for one seed."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def uniform(text: Column) -> Column:
    """A number in [0, 1) from the first eight hex digits of a text's md5."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def loguniform(u: Column, low: float, high: float) -> Column:
    """exp of a number even between log(low) and log(high)."""
    lo, hi = math.log(low), math.log(high)
    return F.exp(F.lit(lo) + u * F.lit(hi - lo))


def quniform(u: Column, low: float, high: float, step: float) -> Column:
    """An even draw rounded to whole steps."""
    return F.round((F.lit(float(low)) + u * F.lit(float(high - low))) / F.lit(float(step))) * F.lit(float(step))


def poisson_one(u: Column, largest: int = 12) -> Column:
    """A Poisson(1) count by inversion; the tail beyond ``largest`` has weight below 1e-10."""
    total, term = 0.0, math.exp(-1.0)
    count = F.lit(0)
    for k in range(largest):
        total += term
        count = count + F.when(u >= F.lit(total), 1).otherwise(0)
        term /= k + 1
    return count
