"""Session settings the library relies on. A cluster's own settings win where it has any."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Days are UTC days.
    "spark.sql.session.timeZone": "UTC",
    # Runtime join choice, coalesced and split partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Columns are built without recording the Python line of each of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", name: str = "layerforge", **extra: str) -> SparkSession:
    """Local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for k, v in {**SETTINGS, **extra}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
