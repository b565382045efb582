"""How the word frequencies of a source differ from those of every other source of its language.

Words are counted per (language, source) inside the tasks, then by a shuffle. The kept words of a
language (in at least MIN_DOCS of its documents) are dealt into blocks by their hash and
numbered within a block, so a source is, per block, a sorted array of (word number, count). Every
unordered pair of sources is a task per block: the two arrays are co-grouped and
intersected by galloping, which prices the words both have, those that one has, and those that neither has,
once for both directions. Blocks bound every array, so neither a large vocabulary nor a
source with a third of all rows makes a group that grows.

Arithmetic is exact: a frequency is a whole number of billionths, divided in steps that stay
within 64 bits up to 9 * 10^15 words and kept words of a source.

Defined results: null text, language and source are empty ones; a source without kept words still has its rows;
without kept words all values are 0; a language with one source has no pairs; equal values
are ranked by the bytes of the item; repeated rows count as documents of their own; other columns are
ignored; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from layerforge.llm import words as w
from layerforge.llm.storage import with_package, written

MIN_DOCS = 10
TOP_TERMS = 10
# Kept words of a block, on average.
BLOCK_TERMS = 1 << 16
# Rows of counts that a task holds before it sends them on.
HELD = 1 << 19
_UNIT = 1_000_000_000
_U = np.uint64

_BYTES = np.arange(256)
_LETTER = (_BYTES >= 128) | ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122))
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_VALUE = w.mixed((_LOWER.astype(np.uint64) + _U(1)) * _U(0x9E3779B97F4A7C15))


def _keyed(group: np.ndarray, number: np.ndarray) -> np.ndarray:
    """One 64-bit number for a word in a document or a source."""
    return w.mixed(number + (group.astype(np.uint64) + _U(1)) * _U(0xD6E8FEB86659FD93))


def _summed(key: np.ndarray, sums: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """For every distinct key the place of a copy, and the sums over its copies."""
    order = np.argsort(key)
    new = np.ones(len(order), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    starts = np.flatnonzero(new)
    return order[starts], [np.add.reduceat(s[order], starts) for s in sums]


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and row, number, start and end of every word."""
    text, offsets = w.buffers(texts)
    solid = _LETTER[text]
    edge = np.zeros(len(text) + 1, bool)
    edge[offsets] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = w._power_tables(len(text) + 1)
    summed = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_VALUE[text] * power[: len(text)], out=summed[1:])
    number = w.mixed((summed[ends] - summed[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    return _LOWER[text], np.searchsorted(offsets, starts, side="right") - 1, number, starts, ends


def _cut(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The stretches of a text as strings."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(text[at].tobytes()))


_COUNTED = "lang string, source string, term string, n long, docs long"


class _Counts:
    """Counts of (group, word) over many documents, of bounded size."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]] = []
        self.rows = 0

    def add(self, batch: pa.RecordBatch) -> None:
        # Text of one slice: words per document first, so that documents are counted once each.
        names = zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), strict=True)
        group = np.array([self.groups.setdefault(g, len(self.groups)) for g in names], np.int64)
        text, row, number, starts, ends = _terms(batch["text"])
        if not len(row):
            return
        one, (n,) = _summed(_keyed(row, number), [np.ones(len(row), np.int64)])
        own = group[row[one]]
        two, (n, docs) = _summed(_keyed(own, number[one]), [n, np.ones(len(one), np.int64)])
        at = one[two]
        self.parts.append((own[two], number[at], n, docs, _cut(text, starts[at], ends[at])))
        self.rows += len(at)

    def join(self) -> None:
        if len(self.parts) > 1:
            group, number, n, docs = (np.concatenate([p[k] for p in self.parts]) for k in range(4))
            terms = pa.chunked_array([p[4] for p in self.parts]).combine_chunks()
            at, (n, docs) = _summed(_keyed(group, number), [n, docs])
            self.parts = [(group[at], number[at], n, docs, terms.take(pa.array(at)))]
            self.rows = len(at)

    def out(self) -> Iterator[pa.RecordBatch]:
        self.join()
        for group, _, n, docs, terms in self.parts:
            langs, sources = zip(*self.groups, strict=True)
            at = pa.array(group)
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array(langs, pa.string()).take(at), "source": pa.array(sources, pa.string()).take(at), "term": terms, "n": n, "docs": docs}
            )
        self.clear()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = _Counts()
    for batch in batches:
        for part in w.slices(batch, "text"):
            counts.add(part)
            if counts.rows > HELD:
                counts.join()
                if counts.rows > HELD // 2:
                    yield from counts.out()
    yield from counts.out()


def shares(count: np.ndarray, whole: int) -> np.ndarray:
    """1 + floor(10^9 * (count + 2) / whole), exactly; `whole` is the sum over the words plus twice their number."""
    rest, out = count + 2, np.zeros(len(count), np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // whole
        rest = rest % whole
    return out + 1


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)), exactly."""
    return (p - q) * (p - q) // (p + q)


def gallop(short: np.ndarray, long: np.ndarray, stride: int = 128) -> np.ndarray:
    """The place in `long` of every number of `short`, or -1; both sorted and distinct.

    A stretch of `short` at a time looks for its end by steps that double from the place
    reached so far, and only the stretch of `long` in between is searched.
    """
    out = np.full(len(short), -1, np.int64)
    reached = 0
    for at in range(0, len(short), stride):
        some = short[at : at + stride]
        step = len(some)
        end = reached + step
        while end < len(long) and long[end - 1] < some[-1]:
            step *= 2
            end += step
        end = min(end, len(long))
        place = reached + np.searchsorted(long[reached:end], some)
        inside = place < len(long)
        hit = np.zeros(len(some), bool)
        hit[inside] = long[place[inside]] == some[inside]
        out[at : at + stride][hit] = place[hit]
        reached = int(place[-1])
    return out


def merged(a: tuple[np.ndarray, np.ndarray, int], b: tuple[np.ndarray, np.ndarray, int], kept: int) -> int:
    """The value of a pair over one block: (word numbers, counts, whole) of both sides and the kept words of the block."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    (ids_a, n_a, whole_a), (ids_b, n_b, whole_b) = a, b
    zero = np.zeros(1, np.int64)
    p, q = shares(n_a, whole_a), shares(n_b, whole_b)
    p0, q0 = shares(zero, whole_a), shares(zero, whole_b)
    at = gallop(ids_a, ids_b)
    both = at >= 0
    alone = np.ones(len(ids_b), bool)
    alone[at[both]] = False
    neither = kept - len(ids_a) - len(ids_b) + int(both.sum())
    return (
        int(gaps(p[both], q[at[both]]).sum())
        + int(gaps(p[~both], q0).sum())
        + int(gaps(p0, q[alone]).sum())
        + neither * int(gaps(p0, q0)[0])
    )


_SIDE = ["lang", "block", "one", "two"]
_PRICED = "lang string, one string, two string, value long"


def _priced(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    def side(t: pa.Table) -> tuple[np.ndarray, np.ndarray, int]:
        terms, counts = (t[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("ids", "counts"))
        return terms, counts, t["whole"][0].as_py()

    lang, _, one, two = (k.as_py() for k in key)
    value = merged(side(left), side(right), left["kept"][0].as_py())
    return pa.table({"lang": [lang], "one": [one], "two": [two], "value": [value]})


def _share(count: Column, whole: Column) -> Column:
    """`shares` as a Column."""
    first = (count + 2) * 1000
    second = first % whole * 1000
    third = second % whole * 1000

    def by(x: Column) -> Column:
        return F.call_function("div", x, whole)

    return F.lit(1) + by(first) * 1_000_000 + by(second) * 1000 + by(third)


def counted(docs: DataFrame) -> DataFrame:
    """`lang, source, term, n, docs`: the words of every source, with occurrences and documents."""
    blank = F.lit("")
    rows = with_package(docs).select(*(F.coalesce(F.col(c).cast("string"), blank).alias(c) for c in ("lang", "source", "text")))
    return rows.mapInArrow(_counted, _COUNTED).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """`lang, source, part, item, value, rank`.

    Part `pair`: every other source of the language, by falling divergence over all kept words. Part `term`: the `top` words
    that the source uses more than its language does.
    """
    blank = F.lit("")
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), blank).alias(c) for c in ("lang", "source"))).distinct()
    counts = written(counted(docs), "counts")
    terms = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("in_lang")).where(F.col("docs") >= min_docs)
    sizes = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("in_lang").alias("n_lang"))
    sizes = written(sizes.withColumn("blocks", F.ceil(F.col("v") / BLOCK_TERMS).cast("int")), "sizes")
    numbered = terms.join(sizes.select("lang", "blocks"), "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    place = F.row_number().over(W.partitionBy("lang", "block").orderBy("term"))
    numbered = written(numbered.select("lang", "term", "in_lang", "block", place.alias("id")), "terms")
    kept = written(counts.select("lang", "source", "term", "n").join(numbered, ["lang", "term"]), "kept")

    # Groups without kept words have a whole of 2 V; without kept words in the language there is none, and nothing to add up.
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_own"))
    known = groups.join(own, ["lang", "source"], "left").join(sizes, "lang", "left")
    known = written(
        known.select(
            "lang",
            "source",
            (F.coalesce("n_own", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("whole"),
            (F.coalesce("n_lang", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("lang_whole"),
        ),
        "groups",
    )

    in_block = numbered.groupBy("lang", "block").agg(F.count(F.lit(1)).alias("kept"))
    arrays = kept.groupBy("lang", "source", "block").agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("t"))
    sides = written(
        known.join(in_block, "lang")
        .join(arrays, ["lang", "source", "block"], "left")
        .select(
            "lang",
            "source",
            "block",
            "kept",
            "whole",
            F.coalesce(F.col("t.id"), F.array().cast("array<int>")).alias("ids"),
            F.coalesce(F.col("t.n"), F.array().cast("array<long>")).alias("counts"),
        ),
        "sides",
    )
    pairs = known.select("lang", F.col("source").alias("one")).join(known.select("lang", F.col("source").alias("two")), "lang").where("one < two")
    # toDF names the columns anew: both sides come from the same tables.
    columns = ["lang", "one", "two", "block", "kept", "whole", "ids", "counts"]
    left = pairs.join(sides.withColumnRenamed("source", "one"), ["lang", "one"]).select(*columns).toDF(*columns)
    right = pairs.join(sides.withColumnRenamed("source", "two"), ["lang", "two"]).select(*columns).toDF(*columns)
    priced = left.groupBy(*_SIDE).cogroup(right.groupBy(*_SIDE)).applyInArrow(_priced, _PRICED)
    # Pairs of languages without kept words were no task.
    value = pairs.withColumn("value", F.lit(0).cast("long")).unionByName(priced).groupBy("lang", "one", "two").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("two").alias("item")), F.struct(F.col("two").alias("source"), F.col("one").alias("item"))))
    by_value = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair_rows = value.select("lang", ways.alias("w"), "value").select("lang", "w.*", "value").withColumn("rank", F.row_number().over(by_value))

    priced_terms = kept.join(known, ["lang", "source"]).select(
        "lang",
        "source",
        F.col("term").alias("item"),
        _share(F.col("n"), F.col("whole")).alias("p"),
        _share(F.col("in_lang"), F.col("lang_whole")).alias("q"),
    )
    gap = F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("p") + F.col("q"))
    term_rows = (
        priced_terms.where("p > q")
        .select("lang", "source", "item", gap.alias("value"))
        .withColumn("rank", F.row_number().over(by_value))
        .where(F.col("rank") <= top)
    )
    return (
        pair_rows.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
        .unionByName(term_rows.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
    )
