"""Prefix trie of conversations: what a cache of shared beginnings would save, node by node.

Conversations that are equal turn by turn are collapsed first: one weighted sequence per distinct
conversation, with the list of those that end there. A sequence that is a proper prefix of
another one is found by an anti join and is no leaf. All figures of a node are then
sums over the weighted prefixes of the distinct sequences, so copies cost nothing.

A prefix is named by its depth and two 64-bit numbers: the exclusive or of hashes of (place, role, text)
over its turns. That is an ordinary aggregate, so whole conversations and prefixes are
named without gathering a conversation in one row. Texts do not move: a
turn is a digest and a length from the first projection on.

Places and prefixes are worked out per stretch of a conversation and then shifted by the
stretches before, so that a very long conversation is spread over tasks.

Defined results: rows with a null `conv_id` belong to no conversation and take no part; a null turn comes first;
a null role or text is empty; equal turn numbers are ordered by the SHA-256 of role and
text; repeated rows are repeated turns; other columns are ignored; an empty table has no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from layerforge.llm.storage import written

# Turns of one stretch of a conversation.
STRETCH = 1024


def _earlier(rows: DataFrame, stretch: str, sums: dict) -> DataFrame:
    """Per conversation and stretch the sums over all stretches before; no row for first stretches.

    `sums` maps a column to (its aggregate within a stretch, how those are combined).
    """
    own = rows.groupBy("conv", stretch).agg(*(within.alias(c) for c, (within, _) in sums.items()))
    before = W.partitionBy("conv").orderBy(stretch).rowsBetween(W.unboundedPreceding, -1)
    shifted = own.select("conv", stretch, *(over(F.col(c)).over(before).alias(f"{c}_before") for c, (_, over) in sums.items()))
    return shifted.where(F.col(f"{next(iter(sums))}_before").isNotNull())


def numbered(conversations: DataFrame) -> DataFrame:
    """`conv, place, digest, size`: the turns in order, places from 1, sizes in code points."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    body = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    # The stretch of a null turn lies before all others.
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.expr(f"cast(turn AS long) div {STRETCH}"), F.lit(-(1 << 63))).alias("stretch"),
        F.unhex(F.sha2(body, 256)).alias("digest"),
        F.length(text).cast("long").alias("size"),
    )
    order = W.partitionBy("conv", "stretch").orderBy(F.asc_nulls_first("turn"), "digest")
    earlier = _earlier(rows, "stretch", {"n": (F.count(F.lit(1)), F.sum)})
    return (
        rows.withColumn("place", F.row_number().over(order).cast("long"))
        .join(earlier, ["conv", "stretch"], "left")
        .select("conv", (F.col("place") + F.coalesce("n_before", F.lit(0))).alias("place"), "digest", "size")
    )


def rebuilt(conversations: DataFrame, family: int = 100, heads: int = 6) -> DataFrame:
    """The turns of `numbered` with the beginning of every conversation taken from the first of its family.

    Conversation c gets the first h = crc32(c as text) % heads turns of conversation c - c % family
    (all if there are fewer, none if it is not there), then its own turns after
    its first h. A row of place 0 without text stands for every conversation, so none gets lost.
    """
    turns = written(numbered(conversations), "turns")
    most = heads - 1
    first = (
        turns.where((F.col("conv") % family == 0) & (F.col("place") <= most))
        .groupBy(F.col("conv").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "digest", "size"))).alias("head"))
    )
    h = F.crc32(F.col("conv").cast("string")) % heads
    taken = F.least(h, F.coalesce(F.size("head"), F.lit(0)).cast("long"))
    plan = (
        turns.select("conv")
        .distinct()
        .withColumn("base", F.col("conv") - F.col("conv") % family)
        .join(first, "base", "left")
        .select("conv", (h - taken).alias("missing"), F.slice(F.coalesce("head", F.array().cast(first.schema["head"].dataType)), F.lit(1), taken.cast("int")).alias("head"))
    )
    root = F.array(F.struct(F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("size")))
    lent = plan.select("conv", F.explode(F.concat(root, "head")).alias("t")).select("conv", "t.*")
    # Own turns move down where the family has too few turns to lend.
    missing = plan.where("missing > 0").select("conv", "missing")
    own = (
        turns.where(F.col("place") > h)
        .join(missing, "conv", "left")
        .select("conv", (F.col("place") - F.coalesce("missing", F.lit(0))).alias("place"), "digest", "size")
    )
    return lent.unionByName(own)


def with_roots(turns: DataFrame) -> DataFrame:
    """The turns of `numbered` as they are, with the row of place 0 that `trie` asks for."""
    root = turns.select("conv").distinct().select("conv", F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("size"))
    return root.unionByName(turns)


_SEQUENCE = "a long, b long, depth long, conv long, chars long, weight long, ends_sha256 string"


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations sorted by sequence and id, as one row per sequence. The ids go through the digest, never into a list."""
    names = ["a", "b", "depth", "conv", "chars"]
    open_key, row, ends = None, None, None

    def closed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * 7
        types = [pa.int64()] * 6 + [pa.string()]
        fields = [*names, "weight", "ends_sha256"]
        return pa.RecordBatch.from_pydict({f: pa.array(c, t) for f, c, t in zip(fields, columns, types, strict=True)})

    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, depth, conv, chars = (batch[n].to_numpy() for n in names)
        new = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (depth[1:] != depth[:-1])
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        done = []
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            key = (int(a[start]), int(b[start]), int(depth[start]))
            if key != open_key:
                if open_key is not None:
                    done.append((*row, ends.hexdigest()))
                open_key, ends = key, hashlib.sha256()
                row = [*key, int(conv[start]), int(chars[start]), 0]
            listed = ",".join(map(str, conv[start:end].tolist()))
            ends.update((listed if not row[-1] else "," + listed).encode())
            row[-1] += end - start
        yield closed(done)
    if open_key is not None:
        yield closed([(*row, ends.hexdigest())])


def sequences(turns: DataFrame) -> DataFrame:
    """The distinct conversations: their name (`depth, a, b`), smallest id `conv`, `weight`, `chars` and the digest of all ids."""

    def named(seed: int):
        term = F.xxhash64(F.lit(seed), "place", "digest")
        return F.bit_xor(F.when(F.col("place") > 0, term).otherwise(F.lit(0).cast("long")))

    whole = turns.groupBy("conv").agg(
        named(1).alias("a"), named(2).alias("b"), F.max("place").alias("depth"), F.sum("size").alias("chars")
    )
    dealt = whole.select("a", "b", "depth", "conv", "chars").repartition("a", "b", "depth")
    return dealt.sortWithinPartitions("a", "b", "depth", "conv").mapInArrow(_collapsed, _SEQUENCE)


def _prefixes(turns: DataFrame, distinct: DataFrame) -> DataFrame:
    """A row per turn of every distinct sequence: the prefix that ends there, the one before, and the code points before."""
    rows = (
        turns.join(distinct.select("conv", "weight"), "conv")
        .withColumn("stretch", F.floor(F.col("place") / STRETCH))
        .withColumns({f"own_{k}": F.when(F.col("place") > 0, F.xxhash64(F.lit(s), "place", "digest")).otherwise(F.lit(0).cast("long")) for k, s in (("a", 1), ("b", 2))})
    )
    sums = {
        "a": (F.bit_xor("own_a"), F.bit_xor),
        "b": (F.bit_xor("own_b"), F.bit_xor),
        "chars": (F.sum("size"), F.sum),
    }
    earlier = _earlier(rows, "stretch", sums)
    run = W.partitionBy("conv", "stretch").orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = rows.select(
        "*", F.bit_xor("own_a").over(run).alias("in_a"), F.bit_xor("own_b").over(run).alias("in_b"), F.sum("size").over(run).alias("in_chars")
    ).join(earlier, ["conv", "stretch"], "left")

    def total(k: str):
        return F.col(f"in_{k}"), F.coalesce(f"{k}_before", F.lit(0).cast("long"))

    def xor(k: str):
        inner, before = total(k)
        return inner.bitwiseXOR(before)

    inner, before = total("chars")
    return inside.select(
        "conv",
        F.col("place").alias("depth"),
        "size",
        "weight",
        xor("a").alias("a"),
        xor("b").alias("b"),
        xor("a").bitwiseXOR(F.col("own_a")).alias("parent_a"),
        xor("b").bitwiseXOR(F.col("own_b")).alias("parent_b"),
        (inner + before - F.col("size")).alias("before"),
    )


def trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie over `rebuilt` or `with_roots` turns.

    `conv_id` is the smallest member; with `depth` it names the node and where its text can be read. `saved_tokens` sums
    (members - 1) * code points of the last turn over the subtree: that is, members times
    code points of all turns below, less those of the distinct ones. Every distinct one
    belongs to the sequence with the smallest id that runs through it, which owns all of its turns from some place on.
    """
    turns = written(turns, "rebuilt")
    distinct = written(sequences(turns), "sequences")
    prefixes = written(_prefixes(turns, distinct), "prefixes")
    name = ["depth", "a", "b"]
    nodes = written(
        prefixes.groupBy(*name).agg(
            F.sum("weight").alias("n_convs"),
            F.min("conv").alias("conv_id"),
            F.min("size").alias("size"),
            F.min("parent_a").alias("parent_a"),
            F.min("parent_b").alias("parent_b"),
        ),
        "nodes",
    )
    children = (
        nodes.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_a").alias("a"), F.col("parent_b").alias("b"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    leaves = distinct.join(children, name, "left_anti").select("conv", F.lit(1).cast("long").alias("leaf"))
    owned = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.sum("size").alias("owned"))
    weighed = (
        distinct.select("conv", "chars")
        .join(owned, "conv", "left")
        .join(leaves, "conv", "left")
        .select("conv", "chars", F.coalesce("owned", F.lit(0)).alias("owned"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    )
    below = F.col("chars") - F.col("before")
    sums = prefixes.join(weighed, "conv").groupBy(*name).agg(
        F.sum("leaf").alias("n_leaves"), F.sum(F.col("weight") * below - F.least("owned", below)).alias("saved_tokens")
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("conv_id").alias("parent_conv_id")
    )
    return (
        nodes.join(sums, name)
        .join(children, name, "left")
        .join(distinct.select(*name, "ends_sha256"), name, "left")
        .join(parents, ["depth", "parent_a", "parent_b"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are."""
    return trie(with_roots(numbered(conversations)))
