"""Table sinks, registration by location, versioned publishing and refresh."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import timedelta
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerforge.operators.contracts import enforce
from layerforge.sources.scans import records_frame


def _writer(df: DataFrame, fmt: str, partition_by: Sequence[str]):
    if partition_by:
        # One adaptive shuffle by partition value: small values share a task, a hot
        # value is split over several, and no task opens a file per partition.
        df = df.hint("rebalance", *partition_by)
    w = df.write.format(fmt)
    return w.partitionBy(*partition_by) if partition_by else w


def append(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Append, new columns allowed. Read the result with a schema or `merge_schema=True`."""
    _writer(df, fmt, partition_by).option("mergeSchema", "true").mode("append").save(path)


def overwrite(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Replace the table at `path`."""
    _writer(df, fmt, partition_by).mode("overwrite").save(path)


def replace_slice(
    df: DataFrame,
    path: str,
    column: str,
    value: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Replace the slice `column=value` of a partitioned table and nothing else.

    An append that can be repeated: writing the same batch again leaves one copy.
    `column` becomes a partition column; `df` must not read the slice it replaces.
    """
    if not re.fullmatch(r"[\w.\-]+", value):
        raise ValueError(f"{value!r} is not a plain partition value")
    overwrite(df.drop(column), f"{path.rstrip('/')}/{column}={value}", fmt, partition_by)


def publish_slice(
    df: DataFrame,
    table: str,
    path: str,
    column: str,
    value: str,
    fmt: str = "parquet",
    contracts: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Replace one slice of a table that is partitioned by `column` alone, at once for its readers.

    The rows go to a new folder, and then the catalog's entry of this partition
    points there. A job that fails half-way, whose executors are lost, or whose rows break a contract leaves the old
    slice as it was, and no other partition is listed. `contracts` builds the contract frame from
    the written rows, before any reader can see them. Old folders stay until
    you remove them. Read such a table by its name.
    """
    spark = df.sparkSession
    if not re.fullmatch(r"[\w.\-]+", value):
        raise ValueError(f"{value!r} is not a plain partition value")
    rows = df.drop(column)
    location = f"{path.rstrip('/')}/{column}={value}/v-{uuid.uuid4().hex}"
    overwrite(rows, location, fmt)
    if contracts is not None:
        enforce(contracts(spark.read.format(fmt).schema(rows.schema).load(location)))
    schema = T.StructType([*rows.schema.fields, T.StructField(column, T.StringType())])
    create(spark, table, path, schema, fmt, (column,))
    where = f"PARTITION (`{column}` = '{value}')"
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {where} LOCATION '{_quoted(location)}'")
    spark.sql(f"ALTER TABLE {table} {where} SET LOCATION '{_quoted(location)}'")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def slices(spark: SparkSession, table: str, column: str) -> DataFrame:
    """`value`: the slices of a table, from the catalog; no file is opened. Empty when there is no table."""
    if not spark.catalog.tableExists(table):
        return spark.createDataFrame([], "value string")
    name = F.regexp_extract("partition", f"(?:^|/){column}=([^/]+)", 1)
    return spark.sql(f"SHOW PARTITIONS {table}").select(name.alias("value"))


def save_to_parquet(
    entity: str, data: Iterable[Mapping[str, Any]], path: str, spark: SparkSession
) -> None:
    """Write in-memory records of an entity as Parquet."""
    records_frame(spark, entity, data).write.mode("overwrite").parquet(path)


def create_namespace(spark: SparkSession, name: str, use: bool = False) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    if use:
        spark.sql(f"USE {name}")


def _columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def register(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Create an external table over `path` unless it exists, and pick up its partitions.

    The schema is stated, so registration reads no file and partition values
    keep their declared type.
    """
    create(spark, table, path, schema, fmt, partition_by)
    refresh(spark, table, partitioned=bool(partition_by))


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def create(
    spark: SparkSession,
    table: str,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Create an external table over `path` unless it exists, and append the columns it lacks."""
    parts = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({_columns_ddl(schema)}) "
        f"USING {fmt} {parts} LOCATION '{_quoted(path)}'"
    )
    add_columns(spark, table, schema)


def add_columns(spark: SparkSession, table: str, schema: T.StructType) -> list[str]:
    """Append the columns the table lacks; older files read as NULL there."""
    known = {f.name.lower() for f in spark.table(table).schema.fields}
    new = [f for f in schema.fields if f.name.lower() not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns_ddl(T.StructType(new))})")
    return [f.name for f in new]


def refresh(spark: SparkSession, table: str, partitioned: bool = False) -> None:
    """Make files and partitions that were written to, or left, the location visible."""
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def publish(
    df: DataFrame,
    table: str,
    root: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    contracts: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Write a full new version of a table, check it, and point the catalog at it.

    The version goes to its own folder under `root`, so the plan may read the
    version it replaces, running readers keep theirs, and a job that fails or
    breaks a contract leaves the published table as it was. `contracts` builds
    the contract frame from the written version, so nothing is computed twice.
    """
    spark = df.sparkSession
    location = f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"
    # Partition columns come last in a partitioned table.
    columns = [c for c in df.columns if c not in partition_by] + list(partition_by)
    schema = T.StructType([df.schema[c] for c in columns])
    overwrite(df, location, fmt, partition_by)
    if contracts is not None:
        enforce(contracts(spark.read.format(fmt).schema(schema).load(location)))
    if partition_by or not _switched(spark, table, location, schema):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        register(spark, table, location, schema, fmt, partition_by)
    return spark.table(table)


def _switched(spark: SparkSession, table: str, location: str, schema: T.StructType) -> bool:
    """Point an existing table at a new folder, in one step for its readers.

    False when there is no table, or when its columns are not among the new ones:
    the table then has to be made anew. A partitioned table has a location
    per partition and is made anew as well.
    """
    if not spark.catalog.tableExists(table):
        return False
    known = {f.name: f.dataType for f in spark.table(table).schema.fields}
    if any(n not in schema.names or schema[n].dataType != t for n, t in known.items()):
        return False
    add_columns(spark, table, schema)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{_quoted(location)}'")
    spark.catalog.refreshTable(table)
    return True


def _plain(path: Column) -> Column:
    """Local paths come with one slash or three."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def published_locations(spark: SparkSession, table: str) -> DataFrame:
    """`location`: the folders that the catalog points to for a table, one per slice where it has any.

    The catalog is asked slice by slice; only names come to the driver.
    """
    if not spark.catalog.tableExists(table):
        return spark.createDataFrame([], "location string")
    wanted = [""]
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        specs = [r["partition"].split("/") for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
        wanted = ["PARTITION ({})".format(", ".join("`{}` = '{}'".format(*p.split("=", 1)) for p in spec)) for spec in specs]
    found = []
    for part in wanted:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {part}").where("col_name = 'Location'")
        found += [(r["data_type"],) for r in rows.collect()[:1]]
    return spark.createDataFrame(found, "location string").select(_plain(F.col("location")).alias("location"))


def unreferenced(spark: SparkSession, tables: Sequence[str], root: str, grace: timedelta = timedelta(days=7)) -> DataFrame:
    """`location, n_files, n_bytes, last_written`: folders of old versions below `root` that none of `tables` points to.

    Only folders that `publish` and `publish_slice` make are listed, and of these only ones in which nothing was written during
    `grace`: running readers keep what they opened, and a run that is writing has not switched yet. Name every table that may
    have its folders below `root`. Files are listed by Spark, and their contents are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    folder = F.regexp_extract(_plain(F.col("path")), "^(.*/v-[0-9a-f]{32})/", 1)
    folders = (
        files.select(folder.alias("location"), "modificationTime", "length")
        .where("location <> ''")
        .groupBy("location")
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.sum("length").alias("n_bytes"),
            F.max("modificationTime").alias("last_written"),
        )
    )
    used = reduce(DataFrame.union, [published_locations(spark, t) for t in tables])
    old = F.col("last_written") < F.current_timestamp() - F.lit(grace)
    return folders.join(used, "location", "left_anti").where(old)


def remove_unreferenced(spark: SparkSession, tables: Sequence[str], root: str, grace: timedelta = timedelta(days=7)) -> list[str]:
    """Delete the folders of `unreferenced` and return their names, one per old version."""
    gone = sorted(r["location"] for r in unreferenced(spark, tables, root, grace).select("location").collect())
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    for name in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(settings).delete(path, True)
    return gone


def view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
