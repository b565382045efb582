"""Intermediate tables in the folder that all machines of the cluster share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []
_NOTED: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`. Where it is unset, a temporary folder if all tasks run on this machine, an error otherwise."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    if not _OWN:
        _OWN.append("file://" + tempfile.mkdtemp(prefix="layerforge-"))
    return _OWN[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    That cuts the lineage: a lost executor costs the tasks it ran, never the
    steps before, and no step runs twice because two later ones need it.
    """
    folder = f"{shared_folder(df.sparkSession)}/layerforge-{uuid.uuid4().hex}"
    for noted in _NOTED:
        noted.append(folder)
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


@contextmanager
def scratch() -> Iterator[list[str]]:
    """The folders that `written` makes inside, to be removed when nothing reads them any more."""
    folders: list[str] = []
    _NOTED.append(folders)
    try:
        yield folders
    finally:
        _NOTED[:] = [noted for noted in _NOTED if noted is not folders]


def remove(spark: SparkSession, folders: Iterable[str]) -> None:
    """Delete folders of `scratch`."""
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(settings).delete(path, True)
