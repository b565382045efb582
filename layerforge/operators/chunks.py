"""Fixed-size chunk numbers without a global (or per-batch) single-task numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerforge.operators.contracts import unique_contract
from layerforge.sources.staging import written

# monotonically_increasing_id holds the partition above this many bits, and the row below.
_ROW_BITS = 33


def order_contract(df: DataFrame, batch: Sequence[str], order: str) -> DataFrame:
    """Contract row: places of a batch that two rows claim."""
    return unique_contract(df, "chunks.order is unique", [*batch, order])


def _in_ranges(df: DataFrame, batch: Sequence[str], order: str) -> tuple[DataFrame, Column, Column]:
    """Rows in physical ranges of (batch, order), the range of a row, and its place there, up to a constant.

    Spark draws the ranges from a sample. The rows are sorted in them and written, so that the ranges hold for all later steps.
    """
    # The number is stated: coalesced ranges would make one task of a table that is small only by its bytes.
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = [F.col(c).asc_nulls_first() for c in (*batch, order)]
    dealt = df.repartitionByRange(ranges, *sort).sortWithinPartitions(*sort)
    staged = written(dealt.withColumn("__row", F.monotonically_increasing_id()), "ranges")
    return staged, F.shiftright("__row", _ROW_BITS), F.col("__row")


def row_positions(
    df: DataFrame, batch: Sequence[str], order: str, bucket: Column | None = None
) -> DataFrame:
    """Append `position`: the 1-based place of every row in its batch by `order`.

    Same result as `row_number` over the whole batch, in two levels: rows have a place in their
    range, and a range knows, per batch, its first place and the rows of the ranges before it. Only one
    row per batch and range meets in a batch's window, so a batch that is the whole table is
    still numbered by all tasks, and no row carries a list of bounds.

    `order` must be unique per batch (`order_contract` counts where it is not); NULLs come first. Where the data has a column
    that does not decrease as `order` grows, such as a day, give it as `bucket`: it then makes the ranges, and nothing is written.
    """
    if bucket is None:
        source, bucket, place = _in_ranges(df, batch, order)
    else:
        source, place = df, None
    # A struct compares NULL fields as equal, so it is one null-safe key for the
    # aggregation, the join and the window.
    grouped = source.withColumn("__group", F.struct(*batch, bucket.alias("__bucket")))
    if place is None:
        inside = Window.partitionBy("__group").orderBy(F.col(order).asc_nulls_first())
        grouped, place = grouped.withColumn("__row", F.row_number().over(inside).cast("bigint")), F.col("__row")
    before = (
        Window.partitionBy(*[F.col(f"__group.{b}") for b in batch])
        .orderBy("__group.__bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = (
        grouped.groupBy("__group")
        .agg(F.count(F.lit(1)).alias("__n"), F.min(place).alias("__first"))
        .select("__group", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1).alias("__shift"))
    )
    return grouped.join(shifts, "__group").select(*df.columns, (place + F.col("__shift")).alias("position"))


def chunk_numbers(
    df: DataFrame,
    batch: Sequence[str],
    order: str,
    max_rows: int,
    bucket: Column | None = None,
) -> DataFrame:
    """Append `seq`, the 1-based chunk of at most `max_rows` rows inside the batch."""
    if max_rows < 1:
        raise ValueError("max_rows must be positive")
    placed = row_positions(df, batch, order, bucket)
    return placed.withColumn("seq", F.expr(f"(position - 1) div {int(max_rows)} + 1")).drop("position")
