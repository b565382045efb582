"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a text are computed by whole arrays. The trees are grown on the
driver from a bounded sample of labelled documents (`PER_CLASS`): features are cut
into at most 64 bins once, and every split is found in histograms of gradients.
They are flattened into arrays, so that a batch of documents walks through all
trees by array lookups, one level at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.llm import samples
from layerforge.llm import words as w
from layerforge.llm.scoring import with_score
from layerforge.llm.storage import with_package

# At most so many documents of each label are used for fitting.
PER_CLASS = 10_000
TREES, DEPTH, BINS, RATE = 60, 4, 64, 0.2
LEAST_WEIGHT, PENALTY = 1.0, 1.0
FOLDS, HELD_OUT = 3, 1

FEATURES = (
    "log_words",
    "log_bytes",
    "bytes_per_word",
    "distinct_words",
    "most_frequent_word",
    "repeated_next_word",
    "distinct_bigrams",
    "capitals",
    "digits",
    "punctuation",
    "symbols",
    "bars",
    "exclamations",
    "non_ascii",
    "lines_per_word",
    "repeated_lines",
    "one_letter_words",
)


def _class(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in characters]] = True
    return out


_CAPITALS = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGITS = _class("0123456789")
_PUNCTUATION = _class(".,;:?\"'()-")
_SYMBOLS = _class("#*$%&<>@^~=+_{}[]\\/")
_LINE_END = _class("\n")
_HIGH = np.arange(256) >= 128


def statistics(column: pa.Array) -> np.ndarray:
    """A row of `FEATURES` for every text; zeros for a null or empty one."""
    text, offsets = w.buffers(column)
    found, before = w.hashes(column)
    starts, ends, _ = w.spans(text, offsets)
    n = len(offsets) - 1
    words = np.diff(before).astype(float)
    size = np.diff(offsets).astype(float)
    out = np.zeros((n, len(FEATURES)))

    def counted(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[text])])
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)

    per_byte, per_word = np.maximum(size, 1), np.maximum(words, 1)
    lines = counted(_LINE_END) + (size > 0)
    columns = {
        "log_words": np.log1p(words),
        "log_bytes": np.log1p(size),
        "bytes_per_word": size / per_word,
        "capitals": counted(_CAPITALS) / per_byte,
        "digits": counted(_DIGITS) / per_byte,
        "punctuation": counted(_PUNCTUATION) / per_word,
        "symbols": counted(_SYMBOLS) / per_word,
        "bars": counted(_class("|")) / per_word,
        "exclamations": counted(_class("!")) / per_word,
        "non_ascii": counted(_HIGH) / per_byte,
        "lines_per_word": lines / per_word,
    }
    short = np.concatenate([[0], np.cumsum((ends - starts) == 1)])
    columns["one_letter_words"] = (short[before[1:]] - short[before[:-1]]) / per_word
    names = ("distinct_words", "most_frequent_word", "repeated_next_word", "distinct_bigrams", "repeated_lines")
    rest = {c: np.zeros(n) for c in names}
    pairs = w.mixed(found[:-1] * np.uint64(3) + found[1:]) if len(found) > 1 else np.zeros(0, np.uint64)
    for r in np.flatnonzero(words).tolist():
        a, b = before[r], before[r + 1]
        own = found[a:b]
        _, times = np.unique(own, return_counts=True)
        rest["distinct_words"][r] = len(times) / (b - a)
        rest["most_frequent_word"][r] = times.max() / (b - a)
        if b - a > 1:
            rest["repeated_next_word"][r] = (own[1:] == own[:-1]).mean()
            rest["distinct_bigrams"][r] = len(np.unique(pairs[a : b - 1])) / (b - a - 1)
        own_lines = [x for x in text[offsets[r] : offsets[r + 1]].tobytes().split(b"\n") if x.strip()]
        rest["repeated_lines"][r] = 1 - len(set(own_lines)) / max(len(own_lines), 1)
    columns |= rest
    for k, name in enumerate(FEATURES):
        out[:, k] = columns[name]
    return out


@dataclass
class Trees:
    """All trees as one set of arrays; `root` has the first node of each. A leaf leads to itself."""

    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        total = np.full(len(x), self.start)
        for root in self.root.tolist():
            node = np.full(len(x), root)
            for _ in range(self.depth):
                down = x[rows, self.feature[node]] > self.threshold[node]
                node = np.where(down, self.right[node], self.left[node])
            total += self.value[node]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def fitted(x: np.ndarray, y: np.ndarray, prior: float, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees for labels 0 and 1; `prior` is the true share of label 1 and weighs the rows."""
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    start = float(np.log(prior / (1 - prior)))
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []

    def leaf(value: float) -> int:
        at = len(nodes["value"])
        for k, v in (("feature", 0), ("threshold", np.inf), ("left", at), ("right", at), ("value", value)):
            nodes[k].append(v)
        return at

    if len(set(y.tolist())) == 2:
        share = y.mean()
        weight = np.where(y == 1, prior / share, (1 - prior) / (1 - share))
        edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
        bins = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T, strict=True)])
        z = np.full(len(y), start)

        def grow(rows: np.ndarray, level: int) -> int:
            g, h = grad[rows], hess[rows]
            total_g, total_h = g.sum(), h.sum()
            best = (1e-6, None, None)
            if level < depth and len(rows) > 1:
                for f in range(len(bins)):
                    own = bins[f, rows]
                    left_g = np.cumsum(np.bincount(own, g, BINS))[:-1]
                    left_h = np.cumsum(np.bincount(own, h, BINS))[:-1]
                    right_g, right_h = total_g - left_g, total_h - left_h
                    gain = left_g**2 / (left_h + PENALTY) + right_g**2 / (right_h + PENALTY) - total_g**2 / (total_h + PENALTY)
                    gain[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0] and k < len(edges[f]):
                        best = (gain[k], f, k)
            at = leaf(-RATE * total_g / (total_h + PENALTY))
            if best[1] is None:
                z[rows] += nodes["value"][at]
                return at
            _, f, k = best
            low = bins[f, rows] <= k
            nodes["feature"][at], nodes["threshold"][at] = f, edges[f][k]
            nodes["left"][at] = grow(rows[low], level + 1)
            nodes["right"][at] = grow(rows[~low], level + 1)
            return at

        for _ in range(trees):
            p = 1 / (1 + np.exp(-z))
            grad, hess = weight * (p - y), weight * p * (1 - p)
            roots.append(grow(np.arange(len(y)), 0))
    return Trees(
        np.array(roots, np.int64),
        np.array(nodes["feature"], np.int64),
        np.array(nodes["threshold"], float),
        np.array(nodes["left"], np.int64),
        np.array(nodes["right"], np.int64),
        np.array(nodes["value"], float),
        start,
        depth,
    )


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Trees:
    """Fit on labelled documents outside the held-out fold."""
    outside = samples.fold(F.col("doc_id"), FOLDS) != HELD_OUT
    rows = samples.labelled(with_package(docs), labels, "quality", outside, per_class)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in w.slices(batch, "text"):
                found = pa.array(list(statistics(part["text"])), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_pydict({"doc_id": part["doc_id"], "label": part["label"], "x": found})

    sample = (
        rows.select("doc_id", "text", "label").mapInArrow(measured, "doc_id long, label int, x array<double>").collect()
    )
    sample.sort(key=lambda r: (r["doc_id"], r["label"], r["x"]))
    x = np.array([r["x"] for r in sample], float).reshape(-1, len(FEATURES))
    y = np.array([r["label"] for r in sample], np.int64)
    return fitted(x, y, samples.share(labels, "quality", outside))


def scored(docs: DataFrame, model: Trees, keep: Sequence[str] | None = None) -> DataFrame:
    """`docs` with `held_out, score, predicted`, one row per row of `docs`; such columns are replaced.

    `keep` names the columns to carry (all by default; `doc_id` is needed). A
    null or empty text has the score of its statistics, which are zeros. Rows
    with a null `doc_id` and repeated rows stay; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = ["held_out", "score", "predicted"]
    rest = [c for c in (docs.columns if keep is None else keep) if c not in own]

    made = with_score(docs, rest, lambda texts: shared.value.score(statistics(texts)))
    return made.select(
        *[F.col(f"row.`{c}`") for c in rest],
        (samples.fold(F.col("row.doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
