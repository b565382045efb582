"""Measures of a table taken while it is written, and how they compare with the days before."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from layerforge.operators.quality import INVALID, ISSUES

MEASURES = "entity string, day string, metric string, n bigint, share double"


@dataclass(frozen=True)
class Watched:
    """Rows to write, and what is counted on their way."""

    rows: DataFrame
    seen: Observation

    def measured(self, spark: SparkSession, entity: str, day: str) -> DataFrame:
        """`entity, day, metric, n, share` once the rows were written: a handful of numbers, no second scan."""
        found = self.seen.get
        total = found["rows"]
        rows = [(entity, day, metric, int(n), n / total if total else 0.0) for metric, n in found.items()]
        return spark.createDataFrame(rows, MEASURES)


def watch(df: DataFrame, tags: Sequence[str]) -> Watched:
    """Count rows, invalid rows, rows per issue tag and NULLs per column while `df` is written."""
    counts = {"rows": F.count(F.lit(1)), "invalid": F.count_if(F.coalesce(INVALID, F.lit(True)))}
    counts |= {f"issue:{t}": F.count_if(F.array_contains(ISSUES, t)) for t in tags}
    counts |= {f"null:{c}": F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns if c not in (ISSUES, INVALID)}
    seen = Observation()
    return Watched(df.observe(seen, *[c.alias(n) for n, c in counts.items()]), seen)


def spikes(runs: DataFrame, day: str, days: int = 7, factor: float = 3.0, least: float = 0.01) -> DataFrame:
    """`entity, metric, share, usual`: measures of `day` that left what the last `days` runs before showed.

    A share is out of the ordinary when it is over `factor` times its mean over those runs, and over `least`; the
    number of rows when it is over `factor` times its mean or under one `factor`th of it. A
    measure without a run before is not judged.
    """
    before = Window.partitionBy("entity", "metric").orderBy("day").rowsBetween(-days, -1)
    value = F.when(F.col("metric") == "rows", F.col("n").cast("double")).otherwise(F.col("share"))
    judged = runs.where(F.col("day") <= day).withColumn("share", value)
    judged = judged.withColumn("usual", F.avg("share").over(before)).where((F.col("day") == day) & F.col("usual").isNotNull())
    high = F.col("share") > F.col("usual") * factor
    rows = (F.col("metric") == "rows") & (high | (F.col("share") * factor < F.col("usual")))
    return judged.where(rows | ((F.col("metric") != "rows") & high & (F.col("share") > least))).select("entity", "metric", "share", "usual")
