"""Repeatable pseudo-random values from a key, identical on every engine that has MD5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = 1 << 32


def hash_number(key: Column, seed: int | str) -> Column:
    """A 32-bit number from ``seed`` and ``key``; null for a null key."""
    text = F.concat(F.lit(f"{seed}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_bucket(key: Column, buckets: int, seed: int | str) -> Column:
    """Bucket ``0..buckets-1`` of a key."""
    return F.pmod(hash_number(key, seed), F.lit(buckets))


def hash_fraction(key: Column, seed: int | str) -> Column:
    """A value in ``[0, 1)`` that depends only on the key and the seed."""
    return hash_number(key, seed) / F.lit(float(SPAN))
