"""Bounded samples of labelled documents, for models that are fitted on the driver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def known(labels: DataFrame, column: str, train: Column) -> DataFrame:
    """`doc_id, label`: all rows to train on that have one of the labels 0 and 1, once each."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
    return rows.where(train & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).distinct()


def labelled(docs: DataFrame, labels: DataFrame, column: str, train: Column, per_class: int) -> DataFrame:
    """`doc_id, text, label` (and `lang`, if there) of at most `per_class` documents for each of the labels 0 and 1.

    The rows with the smallest hash of their id are taken, so the sample is the
    same however the tables are stored, and all labels can be drawn. Rows
    with another or no label, and labels without a document, are left out.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label")).where(
        train & F.col("doc_id").isNotNull()
    )
    parts = [
        rows.where(F.col("label") == k).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)
    ]
    chosen = reduce(DataFrame.unionByName, parts)
    lang = [F.col("lang").cast("string").alias("lang")] if "lang" in docs.columns else [F.lit(None).cast("string").alias("lang")]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *lang)
    # The sample has at most 2 * per_class rows of two numbers, whatever the tables hold.
    return texts.join(F.broadcast(chosen), "doc_id")


def share(labels: DataFrame, column: str, train: Column) -> float:
    """Share of label 1 among all rows to train on; one half when there are none."""
    row = (
        labels.where(train & F.col(column).isin(0, 1)).agg(F.avg(F.col(column).cast("double")).alias("p")).first()
    )
    return 0.5 if row["p"] is None else float(row["p"])
