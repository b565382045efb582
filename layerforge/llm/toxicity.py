"""Convolutional text classifier for toxicity, in numpy: hashed embeddings, several filter widths, max pooling.

A word's vector is the sum of the vectors of its hash and of the hashes of its
first bytes. Filters of one, two and three words run over the whole text, each
keeps its highest value, and a logistic unit weighs these. The model is fitted by the
tasks on all labelled documents: in every round each shard of them goes on from the same model, and
the models of the shards are averaged, every embedding by how often a shard used it. The result (a few MiB)
is sent to the executors and applied to every document there.

Thresholds by language are calibrated on a fifth of the labelled documents that the model has
not seen, by counts of their scores. The language only chooses the threshold; it is no input of the score.
"""

from __future__ import annotations

import copy
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.llm import bit_tables, samples
from layerforge.llm import words as w
from layerforge.llm.scoring import with_score
from layerforge.llm.storage import with_package, written

# Labelled documents that one task fits on between two averages, and averages.
SHARD_ROWS, ROUNDS = 4096, 3
CELLS = 1 << 16
DIMENSIONS, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
PREFIXES = (4, 6)
# Documents seen in all passes, and most passes: few documents are read more often, many once a round.
VISITS, MOST_EPOCHS = 36_000, 60
# Scores are counted in so many steps to find thresholds.
STEPS = 4096
RATE, BATCH = 0.05, 32
FOLDS, HELD_OUT = 5, 0
_BLOCKS = 16
_U = np.uint64


@dataclass
class Model:
    """Weights, and the thresholds of `flagged` by language ('' for all others)."""

    cells: np.ndarray
    filters: dict[int, np.ndarray]
    shifts: dict[int, np.ndarray]
    weights: np.ndarray
    bias: float
    thresholds: dict[str, float]

    def score(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled, 0) @ self.weights + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def word_cells(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Embedding cells of every word (a row each), and the number of words before each row."""
    found, before = w.hashes(column)
    out = np.empty((len(found), 1 + len(PREFIXES)), np.uint16)
    out[:, 0] = found >> _U(48)
    if len(found):
        text, offsets = w.buffers(column)
        starts, ends, _ = w.spans(text, offsets)
        folded = np.where((text >= 65) & (text <= 90), text + 32, text).astype(np.uint64)
        folded = np.concatenate([folded, np.zeros(max(PREFIXES), np.uint64)])
        value = np.zeros(len(starts), np.uint64)
        size = ends - starts
        for k in range(max(PREFIXES)):
            value = np.where(k < size, (value << _U(8)) | folded[starts + k], value)
            if k + 1 in PREFIXES:
                out[:, 1 + PREFIXES.index(k + 1)] = w.mixed(value + _U(k + 1)) >> _U(48)
    return out, before


def _packed(texts: pa.Array) -> pa.Array:
    """Texts as they move between tasks: cells take more room than the words they stand for."""
    return pa.array([zlib.compress(t, 1) for t in texts.cast(pa.binary()).to_pylist()], pa.binary())


def _unpacked(column: pa.Array) -> list[np.ndarray]:
    """Cells of the words of every packed text."""
    texts = pa.array([zlib.decompress(t) for t in column.to_pylist()], pa.large_binary()).cast(pa.large_string(), safe=False)
    out = []
    for part in w.slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
        found, before = word_cells(part["text"])
        out += [found[a:b] for a, b in zip(before[:-1], before[1:], strict=True)]
    return out


def _vectors(cells: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = cells[rows[:, 0]]
    for k in range(1, rows.shape[1]):
        out = out + cells[rows[:, k]]
    return out


def _convolved(model: Model, x: np.ndarray, width: int) -> np.ndarray:
    """Filter values at every place; a text shorter than the filter is filled up with zeros."""
    if len(x) < width:
        x = np.concatenate([x, np.zeros((width - len(x), x.shape[1]), x.dtype)])
    n = len(x) - width + 1
    f = model.filters[width]
    out = x[:n] @ f[0]
    for k in range(1, width):
        out += x[k : k + n] @ f[k]
    return out + model.shifts[width]


def pooled(model: Model, rows: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Highest value of every filter in every text; zeros for a text without words."""
    out = np.zeros((len(before) - 1, FILTERS * len(WIDTHS)), np.float32)
    full = np.flatnonzero(np.diff(before))
    if not len(full):
        return out
    x = _vectors(model.cells, rows)
    for j, width in enumerate(WIDTHS):
        values = _convolved(model, x, width)
        for r in full.tolist():
            a, b = before[r], before[r + 1]
            if b - a >= width:
                best = values[a : b - width + 1].max(axis=0)
            else:
                best = _convolved(model, x[a:b], width)[0]
            out[r, j * FILTERS : (j + 1) * FILTERS] = best
    return out


def initial(seed: int = 7) -> Model:
    """A model that has seen nothing."""
    rng = np.random.default_rng(seed)
    return Model(
        rng.normal(0, 0.1, (CELLS, DIMENSIONS)).astype(np.float32),
        {k: rng.normal(0, 0.3, (k, DIMENSIONS, FILTERS)).astype(np.float32) for k in WIDTHS},
        {k: np.zeros(FILTERS, np.float32) for k in WIDTHS},
        rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32),
        0.0,
        {},
    )


def _odds(prior: float) -> float:
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    return float(np.log(prior / (1 - prior)))


def fitted(rows: list[np.ndarray], labels: np.ndarray, prior: float, seed: int = 7) -> Model:
    """A model of documents (cells of their words) and labels that are all in one shard; `prior` is the true share of label 1.

    With one label, or none, the model gives the prior.
    """
    model = initial(seed)
    if len(set(labels.tolist())) < 2:
        return without_evidence(model, prior)
    epochs = min(MOST_EPOCHS, max(1, VISITS // len(rows)))
    improve(model, rows, labels, float(labels.mean()), epochs, RATE, np.random.default_rng(seed))
    model.bias += _odds(prior)
    return model


def without_evidence(model: Model, prior: float) -> Model:
    model.weights[:] = 0
    model.bias = _odds(prior)
    return model


def improve(
    model: Model, rows: list[np.ndarray], labels: np.ndarray, prior: float, epochs: int, rate: float, rng: np.random.Generator
) -> np.ndarray:
    """Passes over documents (cells of their words), in place. Returns how often every embedding was used.

    Both labels weigh the same in all, whatever their share `prior`. Gradients flow through the highest place of each filter only.
    """
    share = (0.5 / (1 - prior), 0.5 / prior)
    used = np.zeros(CELLS, np.float32)
    seen_cells = np.full(model.cells.shape, 1e-3, np.float32)
    seen_weights = np.full(len(model.weights), 1e-3, np.float32)
    seen_filters = {k: np.full(model.filters[k].shape, 1e-3, np.float32) for k in WIDTHS}
    seen_shifts = {k: np.full(FILTERS, 1e-3, np.float32) for k in WIDTHS}
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            g_weights, g_bias = np.zeros_like(model.weights), 0.0
            g_filters = {k: np.zeros_like(model.filters[k]) for k in WIDTHS}
            g_shifts = {k: np.zeros_like(model.shifts[k]) for k in WIDTHS}
            touched, grads = [], []
            for d in chosen:
                own = rows[d]
                x = _vectors(model.cells, own) if len(own) else np.zeros((0, DIMENSIONS), np.float32)
                best, places = np.zeros(len(model.weights), np.float32), {}
                if len(x):
                    for j, width in enumerate(WIDTHS):
                        values = _convolved(model, x, width)
                        top = values.argmax(axis=0)
                        places[width] = top
                        best[j * FILTERS : (j + 1) * FILTERS] = values[top, np.arange(FILTERS)]
                active = best > 0
                z = float(np.maximum(best, 0) @ model.weights + model.bias)
                error = share[labels[d]] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[d])
                g_weights += error * np.maximum(best, 0)
                g_bias += error
                back = error * model.weights * active
                for j, width in enumerate(WIDTHS):
                    if not len(x):
                        break
                    up = back[j * FILTERS : (j + 1) * FILTERS]
                    g_shifts[width] += up
                    for k in range(width):
                        at_word = places[width] + k
                        inside = at_word < len(x)
                        word = np.minimum(at_word, len(x) - 1)
                        g_filters[width][k] += (x[word] * inside[:, None]).T * up
                        delta = (model.filters[width][k] * (up * inside)).T
                        for c in range(own.shape[1]):
                            touched.append(own[word, c])
                            grads.append(delta)
                            np.add.at(used, own[word, c], inside)
            # Adagrad: rarely touched cells keep a high rate.
            model.bias -= rate * g_bias / len(chosen)
            for value, seen, grad in (
                (model.weights, seen_weights, g_weights),
                *((model.filters[k], seen_filters[k], g_filters[k]) for k in WIDTHS),
                *((model.shifts[k], seen_shifts[k], g_shifts[k]) for k in WIDTHS),
            ):
                grad = grad / len(chosen)
                seen += grad**2
                value -= rate * grad / np.sqrt(seen)
            if touched:
                cells, where = np.unique(np.concatenate(touched), return_inverse=True)
                total = np.zeros((len(cells), DIMENSIONS), np.float32)
                np.add.at(total, where, np.concatenate(grads) / len(chosen))
                seen_cells[cells] += total**2
                model.cells[cells] -= rate * total / np.sqrt(seen_cells[cells])
    return used


def _fixed(model: Model) -> np.ndarray:
    """All numbers of the model but the embeddings."""
    parts = [model.weights, *(model.filters[k].ravel() for k in WIDTHS), *(model.shifts[k] for k in WIDTHS)]
    return np.concatenate([*parts, [model.bias]]).astype(np.float64)


def _with_fixed(model: Model, numbers: np.ndarray) -> None:
    at = 0
    for own in (model.weights, *(model.filters[k] for k in WIDTHS), *(model.shifts[k] for k in WIDTHS)):
        own[...] = numbers[at : at + own.size].reshape(own.shape)
        at += own.size
    model.bias = float(numbers[-1])


_SHARE = "block int, shard long, total binary, weight binary"


def _shard(model, prior: float, epochs: int, turn: int):
    """What the documents of one shard make of the model, by blocks of embeddings; the last block is the rest of the model."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("label", "ascending"), ("key", "ascending")])
        rows = _unpacked(table["packed"])
        own = copy.deepcopy(model.value)
        shard = key[0].as_py()
        used = improve(own, rows, table["label"].to_numpy().astype(np.int64), prior, epochs, RATE / turn, np.random.default_rng([7, turn, shard]))
        totals = [*np.split((own.cells * used[:, None]).astype(np.float64), _BLOCKS), _fixed(own) * len(rows)]
        weights = [*np.split(used.astype(np.float64), _BLOCKS), np.array([float(len(rows))])]
        zipped = [pa.array([pa.compress(x.tobytes(), "zstd", asbytes=True) for x in part], pa.binary()) for part in (totals, weights)]
        n = len(totals)
        return pa.table([pa.array(range(n), pa.int32()), pa.array([shard] * n, pa.int64()), *zipped], ["block", "shard", "total", "weight"])

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted means of the blocks of all shards; rows are sorted by block and shard, a task holds the sums of its blocks."""
    fixed = len(_fixed(initial()))
    sums: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for block, *packed in zip(*[batch[c].to_pylist() for c in ("block", "total", "weight")], strict=True):
            size = (CELLS // _BLOCKS * DIMENSIONS, CELLS // _BLOCKS) if block < _BLOCKS else (fixed, 1)
            own = [np.frombuffer(pa.decompress(x, n * 8, "zstd", asbytes=True), np.float64) for x, n in zip(packed, size, strict=True)]
            sums[block] = [a + b for a, b in zip(sums[block], own, strict=True)] if block in sums else own
    for block, (total, weight) in sums.items():
        mean = total.reshape(len(weight), -1) / np.maximum(weight, 1e-9)[:, None]
        mean[weight == 0] = np.nan
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([mean.tobytes()], pa.binary())], ["block", "mean"])


def _rounds(rows: DataFrame, model: Model, prior: float, n: int) -> None:
    """Fit the model to all `rows` (doc_id, label, key, shard, packed), in place. The driver sees averages only, a few MiB a round."""
    epochs = min(MOST_EPOCHS // ROUNDS, max(1, VISITS // (ROUNDS * n)))
    for turn in range(1, ROUNDS + 1):
        shared = rows.sparkSession.sparkContext.broadcast(model)
        made = rows.groupBy("shard").applyInArrow(_shard(shared, prior, epochs, turn), _SHARE)
        means = made.repartition("block").sortWithinPartitions("block", "shard").mapInArrow(_averaged, "block int, mean binary")
        for row in means.collect():
            mean = np.frombuffer(row["mean"], np.float64)
            if row["block"] == _BLOCKS:
                _with_fixed(model, mean)
            else:
                at = row["block"] * (CELLS // _BLOCKS)
                part = model.cells[at : at + CELLS // _BLOCKS]
                mean = mean.reshape(part.shape)
                # Embeddings that no document used stay as they are.
                part[...] = np.where(np.isnan(mean), part, mean)
        shared.unpersist()


def _threshold(ones: np.ndarray, zeros: np.ndarray, prior: float) -> float:
    """The threshold with the fewest expected errors at the true share of label 1, from counts by step of the score."""
    cuts = np.arange(STEPS + 1) / STEPS
    missed = np.concatenate([[0], np.cumsum(ones)]) / max(ones.sum(), 1)
    wrong = 1 - np.concatenate([[0], np.cumsum(zeros)]) / max(zeros.sum(), 1)
    cost = prior * missed + (1 - prior) * wrong
    best = np.flatnonzero(cost <= cost.min() + 1e-12)
    return float(cuts[best[np.argmin(np.abs(cuts[best] - 0.5))]])


def calibrated(model: Model, apart: DataFrame, prior: float, least: int = 20) -> None:
    """Thresholds for all documents and for every language with enough cases of both labels, from all rows of `apart`."""
    shared = apart.sparkSession.sparkContext.broadcast(model)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = _unpacked(batch["packed"])
            if not kept:
                continue
            before = np.concatenate([[0], np.cumsum([len(x) for x in kept])])
            scores = shared.value.score(pooled(shared.value, np.concatenate(kept), before))
            step = np.minimum(scores * STEPS, STEPS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch["lang"], batch["label"], pa.array(step)], ["lang", "label", "step"])

    # A count per language, label and step comes to the driver, however many documents there are.
    counts = apart.select("lang", "label", "packed").mapInArrow(steps, "lang string, label int, step int").groupBy("lang", "label", "step").count()
    found: dict[str, np.ndarray] = {}
    whole = np.zeros((2, STEPS), np.int64)
    for row in counts.collect():
        for own in (whole, found.setdefault(row["lang"] or "", np.zeros((2, STEPS), np.int64))):
            own[row["label"], row["step"]] += row["count"]
    model.thresholds[""] = _threshold(whole[1], whole[0], prior) if whole.sum(axis=1).all() else 0.5
    for lang in sorted(found):
        if lang and found[lang].sum(axis=1).min() >= least:
            model.thresholds[lang] = _threshold(found[lang][1], found[lang][0], prior)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on all labelled documents outside the held-out fold; every fifth of them calibrates the thresholds instead."""
    outside = samples.fold(F.col("doc_id"), FOLDS) != HELD_OUT
    chosen = samples.known(labels, "toxic", outside)
    table = docs.sparkSession.sparkContext.broadcast(bit_tables.table_of(chosen.select(F.xxhash64("doc_id").alias("key"))))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = bit_tables.known(table.value, batch["key"].to_numpy())
            for part in w.slices(batch.filter(pa.array(wanted)), "text"):
                found, before = word_cells(part["text"])
                own = pa.array([found[a:b].tobytes() for a, b in zip(before[:-1], before[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["lang"], own, _packed(part["text"])], ["doc_id", "lang", "cells", "packed"]
                )

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = with_package(docs).select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), text.alias("text"))
    numbered = given.withColumn("key", F.xxhash64("doc_id")).mapInArrow(
        cells, "doc_id long, lang string, cells binary, packed binary"
    )
    # Documents of one id part by their words.
    numbered = numbered.select("doc_id", "lang", F.xxhash64("doc_id", "cells").alias("key"), "packed")
    # Labels grow with the documents: they are never sent to every task.
    rows = written(numbered.join(chosen.hint("merge"), "doc_id").withColumn("apart", F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 4), "labelled")
    prior = samples.share(labels, "toxic", outside)
    model = initial()
    n = {r["label"]: r["n"] for r in rows.where("NOT apart").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        without_evidence(model, prior)
    else:
        every = sum(n.values())
        shards = -(-every // SHARD_ROWS)
        dealt = rows.where("NOT apart").select("doc_id", "label", "key", F.pmod("key", F.lit(shards)).alias("shard"), "packed")
        _rounds(dealt, model, n[1] / every, every)
        # Both labels weighed the same, in the corpus they do not.
        model.bias += _odds(prior)
    calibrated(model, rows.where("apart"), prior)
    return model


def scored(docs: DataFrame, model: Model, keep: Sequence[str] | None = None) -> DataFrame:
    """`docs` with `held_out, score, predicted, flagged`, one row per row of `docs`; such columns are replaced.

    `keep` names the columns to carry (all by default; `doc_id` is needed, `lang` chooses thresholds).

    `predicted` is 1 from a score of 0.5, `flagged` uses the threshold of the
    document's language (a null or unknown one: the general threshold). A null
    or empty text has the score of no evidence. Rows with a null `doc_id` and
    repeated rows stay. An empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = ["held_out", "score", "predicted", "flagged"]
    rest = [c for c in (docs.columns if keep is None else keep) if c not in own]
    made = with_score(docs, rest, lambda texts: shared.value.score(pooled(shared.value, *word_cells(texts))))
    pairs = [F.lit(x) for item in model.thresholds.items() if item[0] for x in item]
    known = F.create_map(*pairs) if pairs else F.create_map().cast("map<string, double>")
    lang = F.col("row.lang").cast("string") if "lang" in rest else F.lit(None).cast("string")
    least = F.coalesce(F.try_element_at(known, lang), F.lit(model.thresholds.get("", 0.5)))
    return made.select(
        *[F.col(f"row.`{c}`") for c in rest],
        (samples.fold(F.col("row.doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        (F.col("score") >= least).alias("flagged"),
    )


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` that are not flagged, with all their columns as they were, also ones named like a result here."""
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string").alias("lang")
    packed = docs.select("doc_id", "text", lang, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("given"))
    kept = scored(packed, model, keep=("doc_id", "lang", "given")).where("NOT flagged")
    return kept.select(*[F.col(f"given.`{c}`") for c in docs.columns])
