"""Connected components of an edge table, without collecting edges or components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.llm.storage import written

_EDGE = "a long, b long"


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the smallest node each is connected with, within these edges."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        root = root[root]
        if np.array_equal(root, before):
            return nodes, nodes[root]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a partition, a batch at a time, as stars around the smallest node."""
    for batch in batches:
        nodes, roots = _roots(batch["a"].to_numpy(), batch["b"].to_numpy())
        own = nodes != roots
        yield pa.RecordBatch.from_pydict({"a": nodes[own], "b": roots[own]})


def components(edges: DataFrame) -> DataFrame:
    """`node, root`: for every node of `edges` (a, b) other than a root, the smallest node it is connected with.

    Each round replaces a node's neighbours by the smallest of them (large
    star), then does the same among its smaller neighbours (small star); the
    number of rounds follows the logarithm of the longest path. Batches of edges
    are first reduced to stars where they are, so short paths need few rounds.
    Rows with a null end, loops and repeated edges are allowed; no edges give no rows.
    """
    edges = edges.where("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long"))
    edges = written(edges.mapInArrow(_forest, _EDGE).distinct(), "edges")
    while not edges.isEmpty():
        # Large star: neighbours above a node go to the smallest of it and its neighbours.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        # Small star: a node and its smaller neighbours go to the smallest of them.
        down = large.where("a <> b").distinct()
        floor = down.groupBy("a").agg(F.min("b").alias("least"))
        small = down.join(floor, "a").select(
            F.explode(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("e")
        ).select("e.*").where("a <> b")
        after = written(small.mapInArrow(_forest, _EDGE).distinct(), "edges")
        # Stars: every node has one edge, and no root is a node.
        last = after.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("a").alias("d")).first()
        edges = after
        if last["n"] == last["d"] and after.join(
            after.select(F.col("b").alias("a")).distinct(), "a", "left_semi"
        ).isEmpty():
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
