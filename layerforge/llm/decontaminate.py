"""Benchmark decontamination: size-partitioned MinHash search for short items inside long documents.

Items are partitioned by size (powers of two of their shingle count). For each
partition a document is read in windows of four times the smallest item size, half
overlapping, so an item that occurs lies inside one window, and the Jaccard
similarity of item and window is bounded from below whatever the length of the
document: 0.8 of the item's shingles give 0.19 at least. A window is a candidate
for an item when one of 64 MinHash values agrees, which a true case misses with
a probability of about one in a million. Items of up to four shingles, or with most
of them repeated, would have less in common with a window: each of their shingles is
looked up instead, and none is missed. Candidates are verified by exact
containment: |item & document| / |item| over distinct shingles of the whole text.

Values that no item has are dropped where they arise, by a bit table of fixed size;
what remains joins the items' values. The shingles of documents with a
candidate travel along, so no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.llm import bit_tables
from layerforge.llm import words as w
from layerforge.llm.storage import with_package, written

HASHES = 64
_U = np.uint64
_FACTORS = w.mixed(np.arange(1, HASHES + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)
_LABELS = w.mixed(np.arange(1, HASHES + 1, dtype=np.uint64) ^ _U(0xD6E8FEB86659FD93))
FEW = 4  # items of so many shingles are sought by each of them
SHORTEST = 3  # the smallest partition holds items of up to 2 ** SHORTEST shingles


def _keys(least: np.ndarray, k: int, size_class: int) -> np.ndarray:
    """One number for (partition, hash function, value)."""
    return w.mixed(least ^ _LABELS[k] ^ _U(size_class))


def _class_of(n: int) -> int:
    """Partition of an item of n shingles: the exponent of the next power of two."""
    return max(SHORTEST, int(n - 1).bit_length())


def _item_rows(width: int):
    """Per item: its distinct shingles, and the keys that a window of a document may share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in w.slices(batch, "text"):
                found, before = w.hashes(part["text"])
                sets = w.shingles(found, before, width)
                counts = np.diff(before)
                keys, classes, widths = [], [], []
                for s, n in zip(sets, counts.tolist(), strict=True):
                    if n == 0:
                        own, c, m = np.zeros(0, np.uint64), 0, 0
                    elif len(s) <= FEW or 2 * len(s) < n - width + 1:
                        own, c, m = w.mixed(s), 0, min(n, width)
                    else:
                        c, m = _class_of(n - width + 1), width
                        own = np.array([_keys((s * _FACTORS[k]).min(keepdims=True), k, c)[0] for k in range(HASHES)])
                    keys.append(w.signed(own))
                    classes.append(c)
                    widths.append(m)
                yield pa.RecordBatch.from_pydict(
                    {
                        "item_id": part["item_id"],
                        "words": pa.array(widths, pa.int64()),
                        "size_class": pa.array(classes, pa.int64()),
                        "keys": pa.array(keys, pa.list_(pa.int64())),
                        "shingles": pa.array([w.signed(s) for s in sets], pa.list_(pa.int64())),
                    }
                )

    return run


def _window_keys(shingles: np.ndarray, ends: np.ndarray, classes: list[int], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all window values that the table knows."""
    rows, keys = [], []
    sizes = np.diff(ends)
    full = np.flatnonzero(sizes)
    if not len(full):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = classes[0]
    # Blocks of the smallest class, counted anew in every row.
    blocks = (sizes[full] + (1 << first) - 1) >> first
    owner = np.repeat(full, blocks)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    at = ends[:-1][owner] + (within << first)
    for k in range(HASHES):
        least, who, place = np.minimum.reduceat(shingles * _FACTORS[k], at), owner, within
        for c in range(first, classes[-1] + 1):
            if c > first:  # two blocks of the class below make one
                starts = np.flatnonzero((place & 1) == 0)
                least, who, place = np.minimum.reduceat(least, starts), who[starts], place[starts] >> 1
            if c not in classes:
                continue
            pair = least.copy()
            joined = who[1:] == who[:-1]
            pair[:-1] = np.where(joined, np.minimum(least[:-1], least[1:]), least[:-1])
            key = _keys(pair, k, c)
            hit = np.flatnonzero(bit_tables.known(table, key))
            rows.append(who[hit])
            keys.append(key[hit])
    return np.concatenate(rows), np.concatenate(keys)


def _document_rows(width: int, classes: list[int], short: list[int], table):
    """Documents with keys that some item has, and the shingles that verify them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in w.slices(batch, "text"):
                found, before = w.hashes(part["text"])
                flat, ends = w.all_shingles(found, before, width)
                rows, keys = np.zeros(0, np.int64), np.zeros(0, np.uint64)
                if classes:
                    rows, keys = _window_keys(flat, ends, classes, table.value)
                extra: dict[int, list[np.ndarray]] = {}
                for m in short:  # items of few shingles are sought by each of them
                    grams, to = w.all_shingles(found, before, m)
                    hit = np.flatnonzero(bit_tables.known(table.value, w.mixed(grams)))
                    where = np.searchsorted(to, hit, side="right") - 1
                    rows, keys = np.concatenate([rows, where]), np.concatenate([keys, w.mixed(grams[hit])])
                    for r, g in zip(where.tolist(), grams[hit], strict=True):
                        extra.setdefault(r, []).append(g)
                order = np.argsort(rows, kind="stable")
                rows, keys = rows[order], keys[order]
                chosen, starts = np.unique(rows, return_index=True)
                if len(chosen):
                    sets = [
                        np.unique(np.concatenate([flat[ends[r] : ends[r + 1]], np.array(extra.get(r, []), np.uint64)]))
                        for r in chosen.tolist()
                    ]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "row": pa.array((task << 33) | (n + chosen), pa.int64()),
                            "doc_id": part["doc_id"].take(pa.array(chosen)),
                            "key": part["key"].take(pa.array(chosen)),
                            "keys": pa.array([w.signed(np.unique(x)) for x in np.split(keys, starts[1:])], pa.list_(pa.int64())),
                            "shingles": pa.array([w.signed(s) for s in sets], pa.list_(pa.int64())),
                        }
                    )
                n += part.num_rows

    return run


def leaks(docs: DataFrame, items: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """`doc_id, item_id, n_shared, n_item`: documents that contain at least `percent` of an item's shingles.

    `docs` has doc_id and text, `items` item_id and text; other columns are
    ignored. Words are lower-cased (A-Z) runs between white space. An item of
    fewer than `width` words counts as one shingle and is contained where its
    words follow each other. Null and empty texts, and texts without words,
    contain nothing and are contained in nothing. Each row of `docs` is a document
    and each row of `items` an item; pairs with equal ids and figures stay one row
    each. Empty tables give no rows.
    """
    return _leaks(docs, items, width, percent).select("doc_id", "item_id", "n_shared", "n_item")


def _leaks(docs: DataFrame, items: DataFrame, width: int, percent: int) -> DataFrame:
    """`leaks` with `key`, the number of the document's text: an id may have several texts."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = with_package(rows.withColumn("key", F.xxhash64("text")))
    items = written(
        items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(
            _item_rows(width), "item_id long, words long, size_class long, keys array<long>, shingles array<long>"
        )
        .withColumn("item", F.monotonically_increasing_id()),
        "items",
    )
    # A few small numbers: which partitions and which short lengths there are.
    shape = items.agg(
        F.sort_array(F.collect_set(F.when(F.col("size_class") > 0, F.col("size_class")))).alias("classes"),
        F.sort_array(F.collect_set(F.when((F.col("size_class") == 0) & (F.col("words") > 0), F.col("words")))).alias("short"),
    ).first()
    keys = items.select("item", F.explode("keys").alias("key"))
    table = spark.sparkContext.broadcast(bit_tables.table_of(keys))
    found = written(
        docs.mapInArrow(
            _document_rows(width, list(shape["classes"]), list(shape["short"]), table),
            "row long, doc_id long, key long, keys array<long>, shingles array<long>",
        ),
        "found",
    )
    sought = found.select("row", F.explode("keys").alias("sought"))
    pairs = sought.join(keys.withColumnRenamed("key", "sought"), "sought").select("row", "item").distinct()
    shared = F.size(F.array_intersect("shingles", "item_shingles")).cast("long")
    return (
        pairs.join(items.select("item", "item_id", F.col("shingles").alias("item_shingles")), "item")
        .join(found.select("row", "doc_id", "key", "shingles"), "row")
        .select("doc_id", "key", "item_id", shared.alias("n_shared"), F.size("item_shingles").cast("long").alias("n_item"))
        .where(F.col("n_shared") * 100 >= percent * F.col("n_item"))
    )


def clean_documents(docs: DataFrame, items: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` whose text contains no item; all columns stay, whatever their names. Rows without `doc_id` stay.

    A `doc_id` with several texts is as many documents.
    """
    bad = _leaks(docs, items, width, percent).select("doc_id", "key").distinct()
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("key"),
    )
    return rows.join(bad, ["doc_id", "key"], "left_anti").select(*[F.col(f"row.`{c}`") for c in docs.columns])
