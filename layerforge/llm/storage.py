"""Intermediate tables, and the code that tasks run."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from layerforge.sources.staging import remove, scratch, shared_folder, written

__all__ = ["released", "remove", "scratch", "shared_folder", "with_package", "written"]

_SHIPPED: set[str] = set()


def with_package(df: DataFrame) -> DataFrame:
    """Send this package to the executors once per application, for the functions that run there."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="layerforge-")) / f"{package.name}.zip"
        with zipfile.ZipFile(target, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        context.addPyFile(str(target))
        _SHIPPED.add(context.applicationId)
    return df


def released(spark: SparkSession) -> None:
    """Have the driver find what nothing refers to any more, so that Spark deletes the shuffle files of the steps that are written.

    It looks by itself only when its memory runs short, and a driver that does little keeps the files of all steps until then.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
