"""Audit timestamps that a caller can pin, so that a run can be repeated."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = datetime | Column | None


def audit_time(as_of: AsOf = None) -> Column:
    """`as_of` as a timestamp column, or the start of the query when it is None."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of)


def dimension_audit(as_of: AsOf = None) -> dict[str, Column]:
    """The three housekeeping columns every dimension ends with."""
    stamp = audit_time(as_of)
    return {"is_active": F.lit(True), "created_at": stamp, "updated_at": stamp}
