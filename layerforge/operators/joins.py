"""Outer joins whose rows without a key do not meet in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Places that rows without a key are dealt to.
PLACES = 1024


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[Column, Column]], spread: Sequence[str]) -> DataFrame:
    """Left outer equality join; rows of `left` with a NULL key find nothing, as in SQL, and are spread by the columns `spread`.

    A shuffle deals all NULL keys to the same task, which holds them all when many rows lack the key. Here the place is part of the
    join key: it is 0 for rows with a key, and follows a hash of `spread` for the others, so each
    source is still read once and no row is moved twice.
    """
    without = reduce(or_, [a.isNull() for a, _ in keys])
    place = F.when(without, F.pmod(F.xxhash64(*spread), F.lit(PLACES)) + 1).otherwise(F.lit(0).cast("bigint"))
    # A plain literal on the right would leave the join key.
    none = F.when(reduce(or_, [b.isNull() for _, b in keys]), F.lit(-1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    match = reduce(and_, [a == b for a, b in keys])
    joined = left.withColumn("__place", place).join(right.withColumn("__none", none), match & (F.col("__place") == F.col("__none")), "left")
    return joined.drop("__place", "__none")
