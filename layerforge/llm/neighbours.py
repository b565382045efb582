"""Approximate nearest neighbours by cross-polytope hashing, reranked exactly.

A table turns every vector by three rounds of random signs and a fast Hadamard transform and
files it under the signed axis that it is nearest to (under several, one per
rotation, with `axes` above 1). A query turns the same way and probes the buckets of the
axes nearest to it, the best `probes` over all tables together. Every row is in
every table.

A bucket is worked on in blocks: where it holds more than BLOCK_ROWS vectors or is probed by
more than BLOCK_ROWS queries, both sides are split by salt, and every block of one meets every block
of the other. So no task holds more than two blocks, however many rows a bucket has, and each
block sends on at most k + 1 rows per query. Equal query vectors are one query until the end.
Distances are those of the original vectors in double precision, so a found neighbour has
its true distance; what can be missed is a neighbour in no probed bucket.

The axes follow directions. Vectors of very different lengths, where the nearest one may point
elsewhere, are found less often; scale them first.

Defined results: a null or empty vector, one of zeros, and one with a null or non-finite component takes
no part, nor does a row without an id. Vectors meet only those of their own dimension. Repeated
rows count once; an id with several vectors counts with the one nearest to the query, and searches with all of them. A
query that no other vector can meet has no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from layerforge.llm.storage import with_package, written

# Rotations per table, tables, and buckets that a query looks into over all of them.
AXES, TABLES, PROBES = 1, 4, 112
NEIGHBOURS = 10
BLOCK_ROWS = 2048
_ROUNDS = 3
_PAIRS = 1 << 16


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row; the width is a power of two."""
    rows, width = x.shape
    step = 1
    while step < width:
        x = x.reshape(rows, width // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        step *= 2
    return x.reshape(rows, width) / np.sqrt(width)


def _rotated(vectors: np.ndarray, table: int, axis: int) -> np.ndarray:
    """Unit vectors after the pseudo-rotation of a table, padded to a power of two."""
    width = 1 << (vectors.shape[1] - 1).bit_length()
    x = np.zeros((len(vectors), width))
    # The largest component first, so that no square is lost or overflows.
    x[:, : vectors.shape[1]] = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    signs = np.random.default_rng([width, table, axis])
    for _ in range(_ROUNDS):
        x = _hadamard(x * signs.choice([-1.0, 1.0], width))
    return x


def _scores(rotated: np.ndarray) -> np.ndarray:
    """The nearness to every signed axis: 2i is axis i, 2i + 1 its opposite."""
    return np.stack([rotated, -rotated], axis=2).reshape(len(rotated), -1)


def filed(vectors: np.ndarray, axes: int, tables: int) -> np.ndarray:
    """The bucket of every vector in every table."""
    out = np.zeros((len(vectors), tables), np.int64)
    for table in range(tables):
        for axis in range(axes):
            scores = _scores(_rotated(vectors, table, axis))
            out[:, table] = out[:, table] * scores.shape[1] + scores.argmax(axis=1)
    return out


def probed(vectors: np.ndarray, axes: int, tables: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """The tables and buckets that every query looks into, the nearest first."""
    keys, marks = [], []
    for table in range(tables):
        key, mark = np.zeros((len(vectors), 1), np.int64), np.zeros((len(vectors), 1))
        for axis in range(axes):
            scores = _scores(_rotated(vectors, table, axis))
            key = (key[:, :, None] * scores.shape[1] + np.arange(scores.shape[1])).reshape(len(vectors), -1)
            mark = (mark[:, :, None] + scores[:, None, :]).reshape(len(vectors), -1)
            if key.shape[1] > probes:
                best = np.argsort(-mark, axis=1, kind="stable")[:, :probes]
                key, mark = np.take_along_axis(key, best, 1), np.take_along_axis(mark, best, 1)
        keys.append(key)
        marks.append(mark)
    table = np.repeat(np.arange(tables), [k.shape[1] for k in keys])
    key, mark = np.concatenate(keys, axis=1), np.concatenate(marks, axis=1)
    best = np.argsort(-mark, axis=1, kind="stable")[:, :probes]
    return table[best], np.take_along_axis(key, best, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one dimension as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _same_width(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, a dimension at a time."""
    dims = batch["dim"].to_numpy()
    for dim in np.unique(dims):
        yield batch if (dims == dim).all() else batch.filter(pa.array(dims == dim))


def _filing(axes: int, tables: int, with_vector: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _same_width(batch) if batch.num_rows else ():
                bucket = filed(_matrix(part["vector"]), axes, tables)
                n = part.num_rows
                keys = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * tables, pa.array(bucket.ravel()))
                out = {"id": part["id"], "dim": part["dim"], "keys": keys}
                yield pa.RecordBatch.from_pydict(out | ({"vector": part["vector"]} if with_vector else {}))

    return run


def _probing(axes: int, tables: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _same_width(batch) if batch.num_rows else ():
                table, key = probed(_matrix(part["vector"]), axes, tables, probes)
                rows = np.repeat(np.arange(part.num_rows), table.shape[1])
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": part["id"].take(pa.array(rows)),
                        "dim": part["dim"].take(pa.array(rows)),
                        "slot": pa.array(table.ravel().astype(np.int32)),
                        "key": pa.array(key.ravel()),
                    }
                )

    return run


def nearest(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`(query, id, distance)` rows of the k nearest vectors of every query, ties to the smaller id.

    Products give distances up to a rounding error; what may be among the nearest
    by them is measured again by differences, so equal vectors have equal distances.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        own, other = (queries * queries).sum(axis=1), (vectors * vectors).sum(axis=1)
        rough = own[:, None] + other[None, :] - 2.0 * (queries @ vectors.T)
        last = np.partition(rough, k - 1, axis=1)[:, k - 1] if rough.shape[1] > k else np.full(len(queries), np.inf)
        room = 1e-12 * (own + other.max())
        # What is no number may be near.
        q, v = np.nonzero(~(rough > (last + room)[:, None]))
        distance = np.empty(len(q))
        for a in range(0, len(q), _PAIRS):
            gap = queries[q[a : a + _PAIRS]] - vectors[v[a : a + _PAIRS]]
            distance[a : a + _PAIRS] = np.sqrt((gap * gap).sum(axis=1))
    order = np.lexsort((ids[v], distance, q))
    q, v, distance = q[order], v[order], distance[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    keep = rank < k
    return q[keep], ids[v[keep]], distance[keep]


_FOUND = "q long, id long, score double"


def _ranked(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"q": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        queries, vectors = (_matrix(t["vector"].combine_chunks()) for t in (right, left))
        q, ids, score = nearest(queries, vectors, left["id"].to_numpy(), k)
        return pa.table({"q": right["id"].to_numpy()[q], "id": ids, "score": score})

    return run


def usable(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`id, vector, dim`: the rows that take part."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col(id_column).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    return df.where(sound).select(F.col(id_column).cast("long").alias("id"), v.alias("vector"), F.size(v).alias("dim"))


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = NEIGHBOURS,
    axes: int = AXES,
    tables: int = TABLES,
    probes: int = PROBES,
) -> DataFrame:
    """`query_id, rank, vec_id, score`: up to `k` neighbours of every query among the rows of `vectors` with another id.

    Both frames are `usable` rows. With `axes` rotations a table has (2 * dimension) ** axes buckets: take more axes
    for more rows, so that a bucket stays near BLOCK_ROWS, and measure `recall` for the number of probes.
    """
    vectors, queries = with_package(vectors), with_package(queries)
    name = ["dim", "slot", "key"]
    asked = written(
        queries.groupBy("vector", "dim").agg(F.count(F.lit(1)).alias("n")).select(F.monotonically_increasing_id().alias("id"), "vector", "dim"),
        "queries",
    )

    def rows(with_vector: bool) -> DataFrame:
        schema = "id long, dim int, keys array<long>"
        kept = ["vector"] if with_vector else []
        if with_vector:
            schema += f", vector {vectors.schema['vector'].dataType.simpleString()}"
        made = vectors.mapInArrow(_filing(axes, tables, with_vector), schema)
        return made.select("id", "dim", F.posexplode("keys").alias("slot", "key"), *kept)

    probing = written(asked.mapInArrow(_probing(axes, tables, probes), "id long, dim int, slot int, key long"), "probes")
    # Only buckets that are probed and hold something are worked on, with the number of blocks of either side.
    held = rows(False).groupBy(*name).agg(F.count(F.lit(1)).alias("n_held"))
    wanted = probing.groupBy(*name).agg(F.count(F.lit(1)).alias("n_wanted"))
    blocks = written(
        held.join(wanted, name).select(
            *name,
            F.ceil(F.col("n_held") / BLOCK_ROWS).cast("int").alias("v_parts"),
            F.ceil(F.col("n_wanted") / BLOCK_ROWS).cast("int").alias("q_parts"),
        ),
        "blocks",
    )

    def each(parts: str):
        return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

    def own(parts: str):
        return F.pmod(F.xxhash64("id"), F.col(parts)).cast("int")

    left = rows(True).join(blocks, name).select("id", "vector", *name, own("v_parts").alias("v_part"), each("q_parts").alias("q_part"))
    right = (
        probing.join(blocks, name)
        .select("id", *name, own("q_parts").alias("q_part"), each("v_parts").alias("v_part"))
        .join(asked.select("id", "vector"), "id")
    )
    block = [*name, "v_part", "q_part"]
    met = left.groupBy(*block).cogroup(right.groupBy(*block)).applyInArrow(_ranked(k + 1), _FOUND)
    # An id may be met in several tables, and with several vectors.
    best = met.groupBy("q", "id").agg(F.min("score").alias("score"))
    top = best.withColumn("r", F.row_number().over(W.partitionBy("q").orderBy("score", "id"))).where(F.col("r") <= k + 1)
    lists = top.groupBy("q").agg(F.collect_list(F.struct("id", "score")).alias("near"))
    named = lists.join(asked.select(F.col("id").alias("q"), "vector"), "q").select("vector", "near")
    out = (
        queries.select(F.col("id").alias("query_id"), "vector")
        .join(named, "vector")
        .select("query_id", F.explode("near").alias("m"))
        .where("m.id <> query_id")
        .groupBy("query_id", F.col("m.id").alias("vec_id"))
        .agg(F.min("m.score").alias("score"))
    )
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id")).alias("rank")
    return out.select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of rows of the exact answer (`query_id, vec_id`) that were found; 1 when there are none."""
    pairs = exact.select("query_id", "vec_id").distinct()
    hit = found.select("query_id", "vec_id").distinct().withColumn("hit", F.lit(1))
    row = pairs.join(hit, ["query_id", "vec_id"], "left").agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("hits")).first()
    return row["hits"] / row["n"] if row["n"] else 1.0
