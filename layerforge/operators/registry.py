"""Surrogate keys from a registry: dense numbers that are given once and never collide.

A hashed key is a function of the row and needs no join, but two ids may share it. A registry keeps
the number of every natural id that was ever seen; a run numbers only those that are new.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Ids that one task numbers, on average.
PER_BUCKET = 1 << 20


def new_keys(ids: DataFrame, natural: Sequence[str], known: DataFrame | None = None, key: str = "key") -> DataFrame:
    """`natural..., key` of the ids that `known` does not hold, numbered on from its largest key.

    Ids are dealt into buckets by their hash, and each bucket is numbered by one task from
    where the buckets before it end, so no task sees all ids. The number of buckets follows the number of new ids. Repeated
    ids count once; rows whose natural id has only NULLs have no key; other NULLs are values, equal to each other. The
    same ids and registry give the same keys.
    """
    columns = list(natural)
    named = reduce(or_, [F.col(c).isNotNull() for c in columns])
    fresh = ids.where(named).select(*columns).distinct().withColumn("__id", F.struct(*columns))
    last = F.lit(0).cast("bigint")
    if known is not None:
        held = known.select(F.struct(*[F.col(c) for c in columns]).alias("__id"))
        fresh = fresh.join(held, "__id", "left_anti")
        last = known.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("last")).scalar()
    # One number, as a scalar subquery: the plan stays lazy and nothing comes to the driver.
    buckets = fresh.agg(F.greatest(F.ceil(F.count(F.lit(1)) / PER_BUCKET), F.lit(1)).cast("bigint").alias("n")).scalar()
    dealt = fresh.withColumn("__bucket", F.pmod(F.xxhash64(*columns), buckets))
    earlier = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("__bucket")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__bucket", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) + last).alias("__before"))
    )
    place = F.row_number().over(Window.partitionBy("__bucket").orderBy("__id"))
    return dealt.withColumn("__place", place).join(starts, "__bucket").select(*columns, (F.col("__before") + F.col("__place")).alias(key))


def rekeyed(df: DataFrame, column: str, natural: Sequence[str], registry: DataFrame, names: Sequence[str], key: str = "key") -> DataFrame:
    """Put the registry's key into `column`, by the columns `natural` of `df`, called `names` in the registry.

    A row without a registered id has no key. The columns keep their order.
    """
    held = registry.select(*[F.col(n).alias(f"__n{i}") for i, n in enumerate(names)], F.col(key).alias("__key"))
    match = [F.col(c).eqNullSafe(F.col(f"__n{i}")) for i, c in enumerate(natural)]
    joined = df.join(held, match, "left")
    return joined.select(*[F.col("__key").alias(c) if c == column else F.col(c) for c in df.columns])
