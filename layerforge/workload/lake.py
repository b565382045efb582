"""Queries that write: files that are landed and read back, and whole runs through the layers of a lake of their own."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.plans import runs
from layerforge.sources import landing, scans, schemas
from layerforge.sources.staging import shared_folder
from layerforge.workload import roles

LINES = 100


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/layerforge-{uuid.uuid4().hex}"


def _product_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [f.name for f in schemas.entity_schema("products").fields]
    return roles.products(spark, sf_dir).select(*fields, "version")


def landed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of the products landed as gzipped NDJSON, validated, and read back from the files."""
    folder = _folder(spark)
    # Parts are few bytes and many files: without a shuffle one or two tasks would write them all.
    items = _product_items(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism)
    landing.write_raw(items, folder, LINES)
    schema = schemas.entity_schema("products", "bigint").add("version", "integer")
    rows = scans.read_raw(spark, folder, schema, broken=True)
    return rows.select(
        "id",
        "version",
        "title",
        "price",
        "description",
        "category",
        "image",
        F.col("rating.rate").alias("rating_rate"),
        F.col("rating.count").alias("rating_count"),
        F.col(scans.BROKEN).isNull().alias("whole"),
        F.col("file_origin").rlike(r"/part-[^/]+\.json\.gz$").alias("named"),
    )


@contextmanager
def _utc(spark: SparkSession) -> Iterator[None]:
    """Runs count UTC days; a session of another zone gets its own back."""
    name = "spark.sql.session.timeZone"
    zone = spark.conf.get(name)
    spark.conf.set(name, "UTC")
    try:
        yield
    finally:
        spark.conf.set(name, zone)


def _run(spark: SparkSession, sf_dir: str, gold: bool = True) -> runs.Lake:
    """Two days: first versions of products and users, then second versions of products. Without `gold` products up to silver."""
    name = f"lake_{uuid.uuid4().hex[:12]}"
    # Places outgrow 31-bit keys: some ten thousand of them already share one, which the contract of their dimension refuses.
    lake = runs.Lake(
        _folder(spark),
        bronze=f"{name}_bronze",
        silver=f"{name}_silver",
        gold=f"{name}_gold",
        keys="xxhash64",
        id_type="bigint",
        taxonomy=roles.TAXONOMY,
    )
    products = _product_items(spark, sf_dir)
    users = roles.users(spark, sf_dir).where("version = 1").select(*[f.name for f in schemas.entity_schema("users").fields])
    with _utc(spark):
        for day in (1, 2):
            at = datetime(2024, 1, day, 6)
            batches = [("products", products.where(F.col("version") == day).drop("version"))]
            if day == 1 and gold:
                batches.append(("users", users))
            for entity, items in batches:
                batch = f"{entity}-{day}"
                raw = runs.land(items, lake, entity, at.date(), batch)
                runs.to_bronze(spark, lake, entity, raw, batch, at)
                runs.to_silver(spark, lake, entity, at, batch)
            if gold:
                runs.to_gold(spark, lake, at)
    return lake


def lake_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog that two daily runs publish, with its running counts and the place of its first day."""
    lake = _run(spark, sf_dir)
    catalog = spark.table(f"{lake.gold}.product_catalog").withColumn("rating_bayes_score", F.round("rating_bayes_score", 6))
    fact = spark.table(f"{lake.gold}.fact_product_metrics_daily")
    counts = fact.groupBy(F.col("product_id").alias("id")).agg(
        F.min("rating_count_cum").alias("first_count"), F.max("rating_count_cum").alias("last_count"), F.min("dt").alias("first_dt")
    )
    return catalog.join(counts, "id")


def lake_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What such runs counted while they wrote silver products, and the batches of each snapshot."""
    lake = _run(spark, sf_dir, gold=False)
    measured = spark.table(f"{lake.silver}.dq_runs").where("entity = 'products'").select("day", "metric", "n")
    batches = spark.table(f"{lake.silver}.products_batches").groupBy(F.col("snapshot").alias("day"))
    return measured.where("metric NOT LIKE 'null:%' OR metric IN ('null:price', 'null:image', 'null:rating_rate')").unionByName(
        batches.agg(F.lit("batches").alias("metric"), F.count(F.lit(1)).alias("n"))
    )
