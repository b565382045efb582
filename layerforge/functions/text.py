"""Text normalisation. All builders take and return a Column and keep NULL as NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters a phone number may keep.
PHONE_DROP_PATTERN = r"[^\d\-\+\(\)\s]"


def lower_trimmed(c: Column) -> Column:
    """Lower case without surrounding spaces (U+0020 only, tabs stay)."""
    return F.lower(F.trim(c))


def upper_trimmed(c: Column) -> Column:
    return F.upper(F.trim(c))


def title_case(c: Column) -> Column:
    """First letter of every space-separated word upper case, the rest lower case."""
    return F.initcap(F.trim(c))


def squeezed_title_case(c: Column) -> Column:
    """`title_case` after collapsing every run of whitespace to one space."""
    return F.initcap(F.regexp_replace(F.trim(c), r"\s+", " "))


def phone_digits(c: Column) -> Column:
    """Keep digits, `-`, `+`, parentheses and whitespace; drop everything else."""
    return F.regexp_replace(F.trim(c), PHONE_DROP_PATTERN, "")


def joined(separator: str, *parts: Column) -> Column:
    """Non-NULL parts joined by `separator`; `''` when every part is NULL."""
    return F.concat_ws(separator, *[p.cast("string") for p in parts])


def ndjson_line(*columns: str | Column) -> Column:
    """One JSON object per row that keeps NULL fields."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
