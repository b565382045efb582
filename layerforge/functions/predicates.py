"""Boolean Column builders with SQL three-valued logic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a well-formed e-mail, ZIP code and image address.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}$"
ZIP_PATTERN = r"^\d{5}(-\d{4})?$"
URL_PATTERN = r"^https?://"

# Latitude and longitude limits in degrees.
LATITUDE_LIMIT = 90
LONGITUDE_LIMIT = 180


def mismatches(c: Column, pattern: str) -> Column:
    """True when a value is present and does not match; NULL when it is absent."""
    return ~c.rlike(pattern)


def absent_or_within(c: Column, low: float, high: float) -> Column:
    """NULL passes, otherwise the closed range decides. Never NULL."""
    return c.isNull() | c.between(low, high)


def off_the_globe(latitude: Column, longitude: Column) -> Column:
    """True when either coordinate is present and out of range. Never NULL."""
    return ~(
        absent_or_within(latitude, -LATITUDE_LIMIT, LATITUDE_LIMIT)
        & absent_or_within(longitude, -LONGITUDE_LIMIT, LONGITUDE_LIMIT)
    )


def blank(c: Column) -> Column:
    """NULL or the empty string."""
    return c.isNull() | (F.length(c) == 0)
