"""Running aggregates, previous values and scalar statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sum(value: Column, key: str, order: str) -> Column:
    """Sum of all rows of the key up to and including this one (ROWS frame)."""
    w = Window.partitionBy(key).orderBy(order)
    return F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def previous_value(column: str, key: str, order: str) -> Column:
    return F.lag(column).over(Window.partitionBy(key).orderBy(order))


def increment(current: Column, previous: Column) -> Column:
    """Change since the previous row; the first row counts in full."""
    return F.coalesce(current - previous, current)


def global_mean(df: DataFrame, column: str) -> DataFrame:
    """One row, one column `m_global`: the mean of the non-NULL values, 0.0 without any."""
    return df.agg(F.coalesce(F.avg(column), F.lit(0.0)).alias("m_global"))


def daily_grain(
    df: DataFrame, key: str, day: str, *, total: str, closing: Sequence[str], at: Column
) -> DataFrame:
    """One row per key and day: the sum of `total` and the closing values of the day.

    The closing row is the one with the largest `at`, which has to tell the rows
    of one key and day apart. A single fixed-width `at` (a timestamp, a number)
    keeps every buffer fixed-width too, so this is a hash aggregation with a
    map-side partial step and no sort. Aggregating on (key, day) bounds every
    later per-key window by the number of days, however many rows a hot key has.
    """
    return df.groupBy(key, day).agg(
        *[F.max_by(F.col(c), at).alias(c) for c in closing],
        F.sum(F.coalesce(F.col(total), F.lit(0))).alias(total),
    )


def latest_day(df: DataFrame, key: str, day: str, *values: str) -> DataFrame:
    """Values of the latest day per key, by aggregation instead of a sort.

    `max_by` over a date keeps fixed-width buffers, so this is a hash
    aggregation with a map-side partial step. `(key, day)` must be unique.
    """
    return df.groupBy(key).agg(
        *[F.max_by(v, day).alias(v) for v in values], F.max(day).alias(day)
    )
