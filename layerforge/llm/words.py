"""Words and shingles of Arrow text columns as 64-bit numbers, by whole arrays.

A word is a maximal run of bytes other than space and \\t \\n \\v \\f \\r; A-Z count as
a-z. Text is cut into slices of bounded size, so memory does not follow the batch.
A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = np.arange(256, dtype=np.uint64)
_FOLDED = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + _U(32), _BYTES)
_VALUE = mixed((_FOLDED + _U(1)) * _U(0x9E3779B97F4A7C15))
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_BASE, _INVERSE = 0xD1342543DE82EF95, pow(0xD1342543DE82EF95, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


_POWERS: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS[:] = [_powers(_BASE, n), _powers(_INVERSE, n)]
    return _POWERS


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; a null text is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n, at = len(column), column.offset
    offsets = np.frombuffer(column.buffers()[1], np.int64)[at : at + n + 1]
    data = column.buffers()[2]
    if data is None or not n:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    text = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return text, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, in runs whose texts take about `limit` bytes; one row at least."""
    _, offsets = buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def spans(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of words before each row and after the last."""
    solid = ~_SPACE[text]
    if not len(text):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    edge = np.zeros(len(text) + 1, bool)
    edge[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A number for every word of every row, and the number of words before each row and after all."""
    text, offsets = buffers(column)
    starts, ends, before = spans(text, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), before
    power, inverse = _power_tables(len(text) + 1)
    summed = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_VALUE[text] * power[: len(text)], out=summed[1:])
    own = (summed[ends] - summed[starts]) * inverse[starts]
    return mixed(own + (ends - starts).astype(np.uint64) * _U(0x9E3779B97F4A7C15)), before


_STEP = _U(0xA0761D6478BD642F)


def _rolled(words: np.ndarray, width: int) -> np.ndarray:
    """A number for every run of `width` words; rows are not told apart."""
    n = len(words) - width + 1
    out = words[:n].copy()
    for k in range(1, width):
        out = out * _STEP + words[k : k + n]
    return mixed(out + _U(width))


def shingles(words: np.ndarray, before: np.ndarray, width: int) -> list[np.ndarray]:
    """The distinct shingles of each row, sorted. A row of fewer words is one shingle, an empty row none."""
    rolled = _rolled(words, width) if len(words) >= width else np.zeros(0, np.uint64)
    none = np.zeros(0, np.uint64)
    out = []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            out.append(_rolled(words[a:b], b - a))
        else:
            out.append(none)
    return out


def all_shingles(words: np.ndarray, before: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of all rows in text order, repeats included, and their number before each row."""
    counts = np.diff(before)
    sizes = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(ends[-1], np.uint64)
    if len(words) >= width:
        rolled = _rolled(words, width)
        long = counts >= width
        keep = np.repeat(before[:-1][long], sizes[long]) + (
            np.arange(sizes[long].sum()) - np.repeat(np.cumsum(sizes[long]) - sizes[long], sizes[long])
        )
        at = np.repeat(ends[:-1][long], sizes[long]) + (keep - np.repeat(before[:-1][long], sizes[long]))
        out[at] = rolled[keep]
    for r in np.flatnonzero((counts > 0) & (counts < width)):
        out[ends[r]] = _rolled(words[before[r] : before[r + 1]], int(counts[r]))[0]
    return out, ends


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's bigint."""
    return x.astype(np.uint64).view(np.int64)
