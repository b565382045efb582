"""Duplicate elimination with a stated, total order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "__rank"
_OWN_GROUP = "__own_group"


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    return not isinstance(t, (T.MapType, T.VariantType))


def tie_break(df: DataFrame, but: Sequence[str] = ()) -> list[Column]:
    """Every orderable column, largest first: what is left equal is an identical row."""
    return [
        F.col(f"`{f.name}`").desc_nulls_last()
        for f in df.schema.fields
        if f.name not in but and _orderable(f.dataType)
    ]


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: Sequence[Column],
    *,
    null_keys: str = "drop",
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """The first row of every key under `order_by`.

    The filter on `row_number` lets Catalyst plan a group limit below the
    exchange: a task ships at most one row per key, so a key that holds a third
    of the table costs its reducer no more than one row per map task.

    `ties` are the columns that make the order total, largest first: name the
    ones that identify a version, so that the shuffle carries nothing else that
    the result does not need. Without it every column breaks ties.

    `null_keys="drop"` leaves rows without a key to the quarantine (see
    `operators.quality.without_key`), `"keep"` passes each of them through as
    its own group, so that they neither collapse into one row nor meet in one
    task. Use it on a scan, whose rows come in the same order when a lost task
    is run again.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    missing = reduce(or_, [F.col(k).isNull() for k in keys])

    order = [*order_by, *(tie_break(df, but=keys) if ties is None else newest_first(*ties))]
    partition = list(keys)
    if null_keys == "drop":
        source = df.where(~missing)
    elif null_keys == "keep":
        source = df.withColumn(_OWN_GROUP, F.when(missing, F.monotonically_increasing_id()))
        partition.append(_OWN_GROUP)
    else:
        raise ValueError("null_keys is 'drop' or 'keep'")

    w = Window.partitionBy(*partition).orderBy(*order)
    return source.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) == 1).drop(
        _RANK, _OWN_GROUP
    )


def newest_first(*timestamps: str) -> list[Column]:
    """Descending order, rows without a timestamp last."""
    return [F.col(t).desc_nulls_last() for t in timestamps]


def distinct_values(df: DataFrame, **columns: Column) -> DataFrame:
    """Distinct rows of the named expressions (partial aggregation before the shuffle)."""
    return df.select(*[c.alias(name) for name, c in columns.items()]).distinct()
