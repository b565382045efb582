"""Scans: typed NDJSON, API payloads, text lines, tables and in-memory records."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerforge.sources.schemas import entity_schema

RAW_FILES = "*.json*"

# The column that keeps the text of a line that does not fit the schema.
BROKEN = "broken_line"


def with_broken(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])


def broken_reason(column: str = BROKEN) -> Column:
    """Why a line is kept as text: `not_json`, or `field_mistyped` where single fields do not fit; NULL for good lines."""
    text = F.col(column)
    return F.when(text.isNotNull(), F.when(F.try_parse_json(text).isNull(), "not_json").otherwise("field_mistyped"))


def read_raw(
    spark: SparkSession, path: str | list[str], schema: T.StructType, broken: bool = False
) -> DataFrame:
    """NDJSON files (plain or gzip) anywhere below `path`, plus `file_origin`.

    Parsing is permissive: a broken line gives a row of NULLs, a field that does
    not fit its type gives NULL in that field only. With `broken` the text of such lines
    is kept in `broken_line`. The file path comes from the
    scan's own metadata, so it survives any later shuffle.
    """
    files = (
        spark.read.schema(with_broken(schema) if broken else schema)
        .option("columnNameOfCorruptRecord", BROKEN)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", RAW_FILES)
        .json(path)
    )
    return files.select("*", F.col("_metadata.file_path").alias("file_origin"))


def parsed_lines(
    lines: DataFrame, schema: T.StructType, column: str = "value", broken: bool = False
) -> DataFrame:
    """Rows of NDJSON text held in a column, as permissive as `read_raw`; other columns stay."""
    rest = [c for c in lines.columns if c != column]
    options = {"columnNameOfCorruptRecord": BROKEN}
    row = F.from_json(column, with_broken(schema) if broken else schema, options)
    return lines.select(*rest, row.alias("__row")).select(*rest, "__row.*")


def payload_rows(payloads: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Rows of API responses held in a column: one per element of an array, one for an object."""
    rest = [c for c in payloads.columns if c != column]
    rows = F.from_json(column, T.ArrayType(schema))
    return payloads.select(*rest, F.explode(rows).alias("__row")).select(*rest, "__row.*")


def read_payload(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Whole API responses: one row per element of an array, one row for an object."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines (`value`) with the file each line comes from; gzip is transparent."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("file_origin"))
    )


def records_frame(
    spark: SparkSession, entity: str, records: Iterable[Mapping[str, Any]], id_type: str = "int"
) -> DataFrame:
    """In-memory records with the schema of their entity.

    The records go through Spark's JSON parser, so they are coerced exactly as a
    landed file would be: integer prices widen to double, missing fields are
    NULL, text where a struct is declared becomes a NULL struct.
    """
    lines = [(json.dumps(r, ensure_ascii=False),) for r in records]
    return parsed_lines(spark.createDataFrame(lines, "value string"), entity_schema(entity, id_type))


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Table by path. Give `schema` for evolved tables: merging footers reads every file."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    elif merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table or temporary view by a one-, two- or three-part name."""
    return spark.table(name)
