"""Integrity contracts as counted violations.

A contract frame has one row per rule: `contract` and `violations`. Row rules of
one table are counted in a single pass; uniqueness takes one hash aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerforge.functions.numeric import RATE_HIGH, RATE_LOW


class ContractViolation(RuntimeError):
    """At least one integrity contract does not hold."""


def not_null(column: str) -> Column:
    return F.col(column).isNotNull()


def rate_in_range(column: str = "rating_rate") -> Column:
    c = F.col(column)
    return c.isNull() | c.between(RATE_LOW, RATE_HIGH)


def row_contracts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Count the rows for which a check is false (an undecided check passes, as in SQL)."""
    names = list(checks)
    counted = df.agg(*[F.count_if(~checks[n]).alias(f"v{i}") for i, n in enumerate(names)])
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("contract"), F.col(f"v{i}").alias("violations"))
            for i, n in enumerate(names)
        ]
    )
    return counted.select(F.inline(pairs))


def unique_contract(df: DataFrame, name: str, grain: Sequence[str]) -> DataFrame:
    """Count the grain values that occur more than once."""
    return (
        df.groupBy(*grain)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("violations"))
        .select(F.lit(name).alias("contract"), "violations")
    )


def key_collisions(df: DataFrame, name: str, key: str, natural: Sequence[str]) -> DataFrame:
    """Count the surrogate keys that stand for more than one natural id.

    Ids differ exactly when one of their columns takes two values, or a value
    and NULL, so one aggregation by key decides it without listing the ids.
    """

    def varies(c: str) -> Column:
        some_null = (F.count(c) > 0) & (F.count(c) < F.count(F.lit(1)))
        return F.coalesce(F.min(c) != F.max(c), F.lit(False)) | some_null

    return (
        df.groupBy(key)
        .agg(reduce(or_, [varies(c) for c in natural]).alias("several"))
        .agg(F.count_if("several").alias("violations"))
        .select(F.lit(name).alias("contract"), "violations")
    )


def not_emptied(df: DataFrame, source: DataFrame, name: str) -> DataFrame:
    """One violation when `df` has no row although its source has one."""
    some = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    given = source.limit(1).agg(F.count(F.lit(1)).alias("m"))
    lost = some.select((F.col("n") == 0).alias("empty"), given.scalar().alias("m"))
    return lost.select(
        F.lit(name).alias("contract"), (F.col("empty") & (F.col("m") > 0)).cast("bigint").alias("violations")
    )


def all_contracts(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def enforce(contracts: DataFrame) -> None:
    """Run the checks and raise when one fails. The frame has one row per rule."""
    broken = contracts.where(F.col("violations") > 0).collect()
    if broken:
        listed = ", ".join(f"{r['contract']}: {r['violations']}" for r in broken)
        raise ContractViolation(f"contracts violated ({listed})")
