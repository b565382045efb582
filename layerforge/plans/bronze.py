"""BRONZE: typed rows with lineage, one row per id and batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.functions.audit import AsOf, audit_time
from layerforge.operators.dedup import latest_per_key
from layerforge.sources.scans import read_raw
from layerforge.sources.schemas import entity_schema


def stamped(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    return raw.withColumn("ingestion_ts", audit_time(as_of))


def one_per_id(df: DataFrame) -> DataFrame:
    """One row per id, the choice fixed by file and content; rows without an id all stay."""
    return latest_per_key(df, "id", [F.col("file_origin").desc_nulls_last()], null_keys="keep")


def bronze(
    spark: SparkSession,
    entity: str,
    path: str | list[str],
    as_of: AsOf = None,
    id_type: str = "int",
) -> DataFrame:
    """Scan the raw files of an entity and make its bronze rows; lines that do not fit keep their text."""
    return one_per_id(stamped(read_raw(spark, path, entity_schema(entity, id_type), broken=True), as_of))


def relational_products(products: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Flat projection for a relational target; `date_ingest` is never NULL."""
    given = F.col("ingestion_ts") if "ingestion_ts" in products.columns else F.lit(None)
    return products.select(
        "id",
        "title",
        "price",
        "description",
        "category",
        "image",
        F.col("rating.rate").alias("rating_rate"),
        F.col("rating.count").alias("rating_count"),
        F.coalesce(given, audit_time(as_of)).alias("date_ingest"),
    )
