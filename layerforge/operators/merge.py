"""Upserts and schema evolution on plain columnar tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerforge.operators.dedup import latest_per_key


def evolved_union(older: DataFrame, newer: DataFrame) -> DataFrame:
    """All rows of both; a column that one side lacks is NULL there."""
    return older.unionByName(newer, allowMissingColumns=True)


def upsert(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    order_by: Sequence[Column] | None = None,
    ties: Sequence[str] | None = None,
    keys: DataFrame | None = None,
    clustered: bool = False,
) -> DataFrame:
    """SCD1 merge: one row per key, the first of target and updates under `order_by`.

    An update that is older than the row it meets does not replace it, so late
    and repeated updates are harmless. Without `order_by`, updates always win.
    Rows of `target` that no update touches pass by an anti join on the key
    alone: when the keys are few the optimizer broadcasts them and those rows are not
    shuffled; only the touched rows meet the updates. `keys` gives the keys of
    the updates from a cheaper plan. Updates without a key are left out.

    `clustered` says that the files of `target` hold ranges of the key (see `by_range`): the rows that meet the updates are then
    looked for between the smallest and the largest touched key, so that
    files and row groups outside are not read a second time. The two keys come to the driver first, because a scan takes only
    plain values as bounds.
    """
    touched = (updates if keys is None else keys).select(key).where(F.col(key).isNotNull())
    kept = target.join(touched, key, "left_anti")
    if order_by is None:
        return evolved_union(kept, updates)
    near = target
    if clustered:
        ends = touched.agg(F.min(key).alias("least"), F.max(key).alias("most")).first()
        near = target.where(F.col(key).between(F.lit(ends["least"]), F.lit(ends["most"])))
    met = near.join(touched, key, "left_semi")
    return evolved_union(kept, latest_per_key(evolved_union(met, updates), key, order_by, ties=ties))


def by_range(df: DataFrame, key: str) -> DataFrame:
    """Rows in ranges of the key, sorted in each: files and row groups written from it hold few keys each."""
    return df.repartitionByRange(F.col(key)).sortWithinPartitions(key)
