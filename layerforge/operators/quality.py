"""Declarative quality rules, the category taxonomy and the quarantine split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISSUES = "dq_issues"
INVALID = "dq_invalid_flag"
UNKNOWN_CATEGORY = "unknown"

Rule = tuple[str, Column]


def issue_list(rules: Sequence[Rule]) -> Column:
    """Tags of the rules that hold, in rule order; a NULL predicate does not tag."""
    return F.array_compact(F.array(*[F.when(bad, F.lit(tag)) for tag, bad in rules]))


def with_issues(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Append `dq_issues` and `dq_invalid_flag`."""
    return df.withColumn(ISSUES, issue_list(rules)).withColumn(INVALID, F.size(ISSUES) > 0)


def issue_summary(df: DataFrame, entity: str) -> DataFrame:
    """Rows per issue tag of one entity."""
    return (
        df.select(F.explode(ISSUES).alias("issue"))
        .groupBy("issue")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(entity).alias("entity"), "issue", "n_rows")
    )


def _flagged() -> Column:
    return F.coalesce(F.col(INVALID), F.lit(True))


def accepted(df: DataFrame) -> DataFrame:
    return df.where(~_flagged())


def quarantined(df: DataFrame) -> DataFrame:
    return df.where(_flagged())


def with_key(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def without_key(df: DataFrame, key: str) -> DataFrame:
    """Rows that no key identifies: they go to the quarantine before duplicates are removed."""
    return df.where(F.col(key).isNull())


def mapped_by_literal(raw: Column, taxonomy: Mapping[str, str]) -> Column:
    """Look a value up in a literal map; NULL when it is not there."""
    if not taxonomy:
        return F.lit(None).cast("string")
    pairs = F.create_map(*[F.lit(v) for v in chain.from_iterable(taxonomy.items())])
    return pairs[raw]


def with_category(df: DataFrame, raw: str, taxonomy: Mapping[str, str]) -> DataFrame:
    """Replace `raw` by `category_unmapped` and `category` through a literal taxonomy."""
    mapped = mapped_by_literal(F.col(raw), taxonomy)
    return df.select(
        *[c for c in df.columns if c != raw],
        mapped.isNull().alias("category_unmapped"),
        F.coalesce(mapped, F.lit(UNKNOWN_CATEGORY)).alias("category"),
    )


def with_category_table(df: DataFrame, raw: str, mapping: DataFrame) -> DataFrame:
    """`with_category` with an external table `(category_raw, category)`.

    Where it has several rows for a `category_raw`, the smallest `category`
    holds, so rows never multiply. It carries no broadcast hint: its size is the
    user's, so the optimizer decides by its statistics and adaptive execution
    splits a hot category if both sides are large.
    """
    lookup = mapping.groupBy(F.col("category_raw").alias("__raw")).agg(
        F.min("category").alias("__mapped")
    )
    mapped = F.col("__mapped")
    return df.join(lookup, F.col(raw) == F.col("__raw"), "left").select(
        *[c for c in df.columns if c != raw],
        mapped.isNull().alias("category_unmapped"),
        F.coalesce(mapped, F.lit(UNKNOWN_CATEGORY)).alias("category"),
    )
