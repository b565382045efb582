"""N-gram Jaccard join: documents whose sets of word shingles are nearly equal.

The method is prefix filtering under several global orders of the shingles. A
set of n shingles that reaches the threshold with another shares a shingle with
it among its first n - ceil(t n) + 1 under *every* total order. Order 1 puts
rare shingles first; it builds the index and generates candidates. Orders 2 and
3 are two other orders (rare classes permuted by other keys), whose prefixes every set keeps as
32-bit numbers; a candidate that shares no prefix shingle under one of them goes
before any text moves. What passes all three is verified by its exact intersection.

Rarity comes from a counter of fixed size over all shingles of all documents.
It only sets the order, and any order gives the same links.

No group is expanded into its pairs:

* equal sets are one node;
* every index bucket links its members to one hub first (a star, not all
  pairs), and verified stars are contracted to components;
* only buckets that still hold several components compare their members with
  each other, in blocks of bounded size, by bit arrays (parity sketches) that
  bound the difference of two sets from below; only pairs of different components
  that pass this exact bound become rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.llm import words as w
from layerforge.llm.components import components
from layerforge.llm.storage import with_package, written

COUNTER_BITS = 22
BLOCKS = 64
_SKETCH_WORDS = 4
# Rows of one index bucket that are compared as one block.
BLOCK_ROWS = 2048
_U = np.uint64
_ORDER_KEYS = (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x9B05688C2B3E6C1F)


def _node(shingles: np.ndarray) -> int:
    """A number for a set of shingles; equal for equal sets."""
    n = len(shingles)
    total = w.mixed(shingles ^ _U(0x6A09E667F3BCC908)).sum(dtype=np.uint64) + _U(n)
    return int(w.signed(w.mixed(np.array([total], np.uint64)))[0])


def _clean(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # A document is a doc_id with a text: an id may have several.
    return rows.withColumn("key", F.xxhash64("text"))


def packed(counts: np.ndarray) -> pa.Array:
    """A task's counter (uint32) in BLOCKS blocks."""
    return pa.array([pa.compress(c.tobytes(), "zstd", asbytes=True) for c in counts.reshape(BLOCKS, -1)], pa.binary())


def _sets(width: int):
    """Per document: node and set size; per task: its share of the shingle counter, in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNTER_BITS, np.uint32)
        used, pending = False, []

        def count() -> None:
            cells = (np.concatenate(pending) >> _U(64 - COUNTER_BITS)).astype(np.int64)
            counts[:] += np.bincount(cells, minlength=len(counts)).astype(np.uint32)
            pending.clear()

        for batch in batches:
            for part in w.slices(batch, "text"):
                found, before = w.hashes(part["text"])
                sets = w.shingles(found, before, width)
                used = True
                pending.extend(sets)
                if sum(map(len, pending)) > 1 << 20:
                    count()
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part["doc_id"],
                        "key": part["key"],
                        "node": pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                        "n": pa.array([len(s) for s in sets], pa.int64()),
                        "block": pa.nulls(len(sets), pa.int32()),
                        "counts": pa.nulls(len(sets), pa.binary()),
                    }
                )
        if used:
            if pending:
                count()
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.nulls(BLOCKS, pa.int64()),
                    "key": pa.nulls(BLOCKS, pa.int64()),
                    "node": pa.nulls(BLOCKS, pa.int64()),
                    "n": pa.nulls(BLOCKS, pa.int64()),
                    "block": pa.array(range(BLOCKS), pa.int32()),
                    "counts": packed(counts),
                }
            )

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counter blocks of all tasks, added up; a task holds one block at a time."""
    size = (1 << COUNTER_BITS) // BLOCKS
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, packed in zip(batch["block"].to_pylist(), batch["counts"].to_pylist(), strict=True):
            own = np.frombuffer(pa.decompress(packed, size * 4, "zstd", asbytes=True), np.uint32)
            totals[block] = totals.get(block, 0) + own.astype(np.uint64)
    if totals:
        # Classes of rarity, a quarter of a power of two apart.
        ranks = [np.minimum(4 * np.log2(1.0 + t), 255).astype(np.uint8).tobytes() for t in totals.values()]
        yield pa.RecordBatch.from_pydict({"block": pa.array(list(totals), pa.int32()), "ranks": pa.array(ranks, pa.binary())})


def rarity(made: DataFrame) -> np.ndarray:
    """Rarity class of every counter cell: 4 MiB whatever the input."""
    parts = (
        made.where("block IS NOT NULL")
        .select("block", "counts")
        .repartition("block")
        .mapInArrow(_summed, "block int, ranks binary")
        .collect()
    )
    out = np.zeros(1 << COUNTER_BITS, np.uint8)
    size = (1 << COUNTER_BITS) // BLOCKS
    for row in parts:
        out[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(row["ranks"], np.uint8)
    return out


def _order(shingles: np.ndarray, ranks: np.ndarray, which: int) -> np.ndarray:
    """The shingles from first to last under one of the global orders."""
    rank = ranks[(shingles >> _U(64 - COUNTER_BITS)).astype(np.int64)].astype(np.uint64)
    if which == 1:  # coarser classes, so that this order differs more from the first
        rank = rank >> _U(3)
    key = (rank << _U(56)) | (w.mixed(shingles ^ _U(_ORDER_KEYS[which])) >> _U(8))
    return shingles[np.argsort(key, kind="stable")]


def _at_least(percent: int, n):
    """Length that a set of `n` must at least share with one of its size or more."""
    return -(-percent * n // 100)


def _needed(percent: int, n, m):
    """Common shingles that make the Jaccard similarity of sets of n and m reach the threshold."""
    return -(-percent * (n + m) // (100 + percent))


def _prefix(percent: int, n):
    return n - _at_least(percent, n) + 1


def _sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the shingles that fall on each of 256 bits."""
    bit = (w.mixed(shingles + _U(0x3C6EF372FE94F82B)) >> _U(56)).astype(np.int64)
    odd = (np.bincount(bit, minlength=64 * _SKETCH_WORDS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _prefixes(width: int, percent: int, ranks):
    """Per document its node, size, sketch, first shingles under order 1, and numbers of those under orders 2 and 3."""

    def folded(shingles: np.ndarray, which: int) -> np.ndarray:
        # Two shingles may share a number: then a pair passes that need not, never the other way round.
        own = _order(shingles, ranks.value, which)[: _prefix(percent, len(shingles))]
        return (w.mixed(own) >> _U(32)).astype(np.uint32).view(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in w.slices(batch, "text"):
                found, before = w.hashes(part["text"])
                sets = w.shingles(found, before, width)
                keep = [k for k, s in enumerate(sets) if len(s)]
                firsts = [w.signed(_order(sets[k], ranks.value, 0)[: _prefix(percent, len(sets[k]))]) for k in keep]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part["doc_id"].take(pa.array(keep, pa.int64())),
                        "node": pa.array([_node(sets[k]) for k in keep], pa.int64()),
                        "n": pa.array([len(sets[k]) for k in keep], pa.int64()),
                        "sketch": pa.array([_sketch(sets[k]) for k in keep], pa.list_(pa.int64())),
                        "first": pa.array(firsts, pa.list_(pa.int64())),
                        "second": pa.array([folded(sets[k], 1) for k in keep], pa.list_(pa.int32())),
                        "third": pa.array([folded(sets[k], 2) for k in keep], pa.list_(pa.int32())),
                    }
                )

    return run


def _verified(width: int, percent: int):
    """The pairs whose similarity reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                left = w.shingles(*w.hashes(part["text_a"]), width)
                right = w.shingles(*w.hashes(part["text_b"]), width)
                ends = zip(part["a"].to_pylist(), part["b"].to_pylist(), left, right, strict=True)
                for k, (a, b, x, y) in enumerate(ends):
                    # A doc_id that repeats may bring another text than the node's.
                    if _node(x) == a and _node(y) == b and _linked(x, y, percent):
                        keep.append(at + k)
            if keep:
                yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return run


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common >= _needed(percent, len(x), len(y))


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (token, salt, place, node): keep shared tokens, with the first node of each as hub.

    A row that is alone in its bucket goes, unless the bucket is a part of a
    frequent token (salt >= 0). The first row of an open bucket waits for a second.
    """
    hub: list[np.int64] | None = None
    waiting = False
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch[c].to_numpy() for c in ("token", "salt", "node", "n", "place")]
        carried = hub is not None
        if carried:
            cols = [np.concatenate([[h], c]) for h, c in zip(hub, cols, strict=True)]
        fresh = np.ones(len(cols[0]), bool)
        fresh[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
        start = np.flatnonzero(fresh)
        size = np.diff(np.append(start, len(fresh)))
        out = (np.repeat(size, size) > 1) | (cols[1] >= 0)
        last = start[-1]
        done = carried and not waiting  # the carried row went out before
        seen = bool(out[last]) or (last == 0 and done)
        if done:
            out[0] = False
        rows = np.flatnonzero(out)
        if len(rows):
            h = np.repeat(start, size)[rows]
            made = [cols[k][at] for k, at in ((0, rows), (2, rows), (3, rows), (4, rows), (2, h), (3, h), (4, h))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(m) for m in made], ["token", "node", "n", "place", "hub", "hub_n", "hub_place"]
            )
        hub, waiting = [c[last] for c in cols], not seen


def _salted(ranks, rows: int):
    """Buckets by estimated size: parts of a frequent shingle go to several tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["first"]
            sizes = np.diff(lists.offsets.to_numpy())
            token = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            place = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            node = batch["node"].to_numpy()[owner]
            estimate = 2.0 ** (ranks.value[(token.view(np.uint64) >> _U(64 - COUNTER_BITS)).astype(np.int64)] / 4.0)
            parts = np.maximum(estimate / (4 * rows), 1).astype(np.int64)
            salt = (w.mixed(node.view(np.uint64)) >> _U(33)).astype(np.int64) % parts
            salt[parts == 1] = -1
            yield pa.RecordBatch.from_pydict(
                {"token": token, "salt": salt, "node": node, "n": batch["n"].to_numpy()[owner], "place": place}
            )

    return run


def _across(percent: int):
    """Pairs of different components in each (token, block pair) that may reach the threshold."""

    def pairs(cols: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        left, right = (np.flatnonzero(cols["side"] != s) for s in (1, 0))
        same = cols["x"][0] == cols["y"][0]
        bits = cols["sketch"]
        for at in range(0, len(left), 256):
            i, j = left[at : at + 256][:, None], right[None, :]
            a_n, b_n = cols["n"][i], cols["n"][j]
            needed = _needed(percent, a_n, b_n)
            ok = (cols["root"][i] != cols["root"][j]) & (np.minimum(a_n - cols["place"][i], b_n - cols["place"][j]) >= needed)
            if same:
                ok &= cols["node"][i] < cols["node"][j]
            i, j = np.nonzero(ok)
            i, j = left[at : at + 256][i], right[j]
            apart = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
            near = cols["n"][i] + cols["n"][j] - apart >= 2 * _needed(percent, cols["n"][i], cols["n"][j])
            x, y = cols["node"][i[near]], cols["node"][j[near]]
            if len(x):
                yield pa.RecordBatch.from_pydict({"a": np.minimum(x, y), "b": np.maximum(x, y)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = {c: batch[c].to_numpy() for c in ("token", "x", "y", "side", "node", "root", "n", "place")}
            cols["sketch"] = batch["sketch"].flatten().to_numpy().reshape(-1, _SKETCH_WORDS).view(np.uint64)
            if held is not None:
                cols = {c: np.concatenate([held[c], v]) for c, v in cols.items()}
            fresh = np.ones(len(cols["token"]), bool)
            fresh[1:] = np.any([cols[c][1:] != cols[c][:-1] for c in ("token", "x", "y")], axis=0)
            start = np.append(np.flatnonzero(fresh), len(fresh))
            for a, b in zip(start[:-2], start[1:-1], strict=True):
                if b - a > 1:
                    yield from pairs({c: v[a:b] for c, v in cols.items()})
            held = {c: v[start[-2] :] for c, v in cols.items()}
        if held is not None and len(held["token"]) > 1:
            yield from pairs(held)

    return run


def _checked(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Linked pairs among candidate `pairs` (a, b); `texts` has one row (node, text) per node."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(
        _verified(width, percent), "a long, b long"
    )


def _apart(percent: int, a: str, b: str):
    """The parity sketches of two rows leave the threshold possible."""
    bits = [F.bit_count(F.col(f"{a}.sketch")[k].bitwiseXOR(F.col(f"{b}.sketch")[k])) for k in range(_SKETCH_WORDS)]
    n = F.col(f"{a}.n") + F.col(f"{b}.n")
    return (n - sum(bits[1:], bits[0])) >= 2 * F.ceil(F.lit(percent) * n / F.lit(100 + percent) - F.lit(1e-9))


def linked_documents(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """`doc_id, n_shingles, component_id` for every row of `docs` (doc_id, text; other columns are ignored).

    Two documents link when 100 * |A & B| >= percent * |A | B| for their sets of
    distinct `width`-word shingles. `component_id` is the smallest `doc_id` that
    links reach. A text of fewer words is one shingle; a null or empty text, or
    one without words, has none and links with nothing. Repeated rows are equal
    documents and stay one row each. A row without `doc_id` links with nothing
    and has no component. Sets are told apart by 64-bit numbers of their shingles.
    """
    return _linked_rows(docs, width, percent).select("doc_id", "n_shingles", "component_id")


def _linked_rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """`linked_documents` with `key`, the number of the row's text, and `root`, which names the component."""
    spark = docs.sparkSession
    docs = with_package(_clean(docs))
    made = written(
        docs.mapInArrow(_sets(width), "doc_id long, key long, node long, n long, block int, counts binary"), "sets"
    )
    rows = made.where("block IS NULL").select("doc_id", "key", "node", "n")
    ranks = spark.sparkContext.broadcast(rarity(made))

    # One document stands for each distinct set.
    nodes = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    prefixes = written(
        docs.mapInArrow(
            _prefixes(width, percent, ranks), "doc_id long, node long, n long, sketch array<long>, first array<long>, second array<int>, third array<int>"
        ).join(nodes.withColumnRenamed("node", "__node"), "doc_id").where("node = __node").drop("__node"),
        "prefixes",
    )
    info = prefixes.select("node", "n", "sketch")
    # A node is there once for each row of its document.
    others = prefixes.groupBy("node").agg(F.first("n").alias("n"), *[F.first(c).alias(c) for c in ("sketch", "second", "third")])

    def met_in_all_orders(pairs: DataFrame) -> DataFrame:
        """The pairs whose sketches leave the threshold possible and whose prefixes meet under orders 2 and 3."""
        left = others.select(F.col("node").alias("a"), F.struct("n", "sketch", "second", "third").alias("l"))
        right = others.select(F.col("node").alias("b"), F.struct("n", "sketch", "second", "third").alias("r"))
        meet = F.arrays_overlap("l.second", "r.second") & F.arrays_overlap("l.third", "r.third")
        return pairs.join(left, "a").join(right, "b").where(_apart(percent, "l", "r") & meet).select("a", "b")

    # Stars: every bucket of the order-1 index links its rows to the row that is first in it.
    postings = prefixes.select("node", "n", "first").mapInArrow(
        _salted(ranks, BLOCK_ROWS), "token long, salt long, node long, n long, place long"
    )
    shared = written(
        postings.repartition("token", "salt")
        .sortWithinPartitions("token", "salt", "place", "node")
        .mapInArrow(_stars, "token long, node long, n long, place long, hub long, hub_n long, hub_place long"),
        "shared",
    )
    stars = (
        shared.where("node <> hub")
        .where(
            f"least(n - place, hub_n - hub_place) >= ceil({percent} * (n + hub_n) / {100 + percent} - 1e-9)"
        )
        .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
        .distinct()
    )
    stars = written(met_in_all_orders(stars), "stars")

    def texts_of(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        chosen = nodes.join(ends, "node").select("doc_id", "node")
        # A repeated doc_id may have several texts; the one that made the node is right.
        return docs.join(chosen, "doc_id").select("node", "text", "doc_id")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        return written(_checked(pairs, texts_of(pairs), width, percent).distinct(), name)

    near = verified(stars, "near")
    roots = components(near)

    # What is left: pairs of different components that meet in a bucket.
    labelled = shared.join(roots, "node", "left").select(
        "token", "node", "n", "place", F.coalesce("root", "node").alias("root")
    )
    sizes = (
        labelled.groupBy("token")
        .agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("members"))
        .where("lo <> hi")
        .select("token", F.ceil(F.col("members") / BLOCK_ROWS).alias("blocks"))
    )
    # The row that starts a part of a frequent bucket is one of its members already.
    mine = F.pmod(F.xxhash64("node"), F.col("blocks"))
    open_rows = labelled.join(sizes, "token").join(info.select("node", "sketch"), "node").withColumn("block", mine)
    blocks = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda k: F.struct(
            F.least(k, F.col("block")).alias("x"),
            F.greatest(k, F.col("block")).alias("y"),
            F.when(k == F.col("block"), 2).when(F.col("block") < k, 0).otherwise(1).alias("side"),
        ),
    )
    crossed = (
        open_rows.withColumn("b", F.explode(blocks))
        .select("token", "b.x", "b.y", "b.side", "node", "root", "n", "place", "sketch")
        .repartition("token", "x", "y")
        .sortWithinPartitions("token", "x", "y")
        .mapInArrow(_across(percent), "a long, b long")
        .distinct()
    )
    rest = verified(written(met_in_all_orders(crossed.join(stars, ["a", "b"], "left_anti")), "rest"), "more")
    roots = components(near.union(rest))

    # The smallest document of each component.
    least = nodes.join(roots, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), "doc_id"
    )
    named = least.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    final = least.select("node", "root").join(named, "root").select("node", "root", "component_id")
    return rows.join(final, "node", "left").select(
        "doc_id",
        "key",
        "root",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def first_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` with the smallest `doc_id` of each group of linked documents; all columns stay, whatever their names.

    Documents that link with nothing stay, those without words or `doc_id` too. Of
    rows that repeat both `doc_id` and text one stays. A `doc_id` with several texts is as many documents.
    """
    found = written(_linked_rows(docs, width, percent), "linked")
    own = found.where("doc_id = component_id AND root IS NOT NULL")
    # Texts of one id that link with each other: one of them stays.
    several = own.groupBy("doc_id", "root").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least <> most")
    surplus = own.join(several.select("doc_id", "root", "least"), ["doc_id", "root"]).where("key <> least")
    later = found.where("doc_id <> component_id").select("doc_id", "key").union(surplus.select("doc_id", "key")).distinct()
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("key"),
    )
    kept = rows.join(later, ["doc_id", "key"], "left_anti")
    repeated = found.where("doc_id IS NOT NULL").groupBy("doc_id", "key").count().where("count > 1").select("doc_id", "key")
    if not repeated.isEmpty():
        once = kept.join(repeated, ["doc_id", "key"], "left_semi").dropDuplicates(["doc_id", "key"])
        kept = kept.join(repeated, ["doc_id", "key"], "left_anti").unionByName(once)
    return kept.select(*[F.col(f"row.`{c}`") for c in docs.columns])
