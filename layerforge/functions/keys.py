"""Hashed surrogate keys.

`murmur3` is a non-negative 31-bit key; about 1 in 20,000 of a million ids
collides with another, so joins that must be exact also carry the natural id
and `operators.contracts.key_collisions` reports what a table really holds.
`xxhash64` is the wide option for dimensions with many members.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ALGORITHMS = ("murmur3", "xxhash64")


def surrogate_key(*parts: Column, algorithm: str = "murmur3") -> Column:
    """Bigint key of one or more columns. The type counts: an int and a bigint 1 differ.

    The 32-bit hash is widened before `abs`, so the smallest int does not overflow.
    """
    if algorithm == "murmur3":
        return F.abs(F.hash(*parts).cast("bigint"))
    if algorithm == "xxhash64":
        return F.xxhash64(*parts)
    raise ValueError(f"unknown key algorithm {algorithm!r}, expected one of {ALGORITHMS}")


def null_as_empty(c: Column) -> Column:
    """Text key part: NULL and `''` share a key."""
    return F.coalesce(c, F.lit(""))
