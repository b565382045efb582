"""Small Column helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words are runs of characters other than space and \\t \\n \\v \\f \\r.
_BETWEEN = r"[\x20\x09-\x0D]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` evaluated once, whatever the optimizer joins or splits."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    """All words of a text; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BETWEEN, -1), "")
