"""Token windows of fixed length from whole documents, by bounded-space online packing.

Every task tokenises its rows and packs them as they come: it keeps a fixed number
of open windows, puts what is left of a document into the window it fits best,
and emits the fullest window when none fits. What stays open at the end of a task
is merged across tasks, in groups of bounded size, by filling windows up (pieces
may be cut). Only descriptions of pieces and the ids of open windows move.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.llm.storage import with_package, written

WINDOW = 2048
OPEN_WINDOWS = 16
# Tasks whose leftovers are merged together: a merge sees at most so many times OPEN_WINDOWS windows.
MERGED_TASKS = 64
# Words whose ids a worker remembers.
REMEMBERED = 1_000_000
END_ID = 1

_PIECE = "doc_id long, row long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordTokens:
    """Token ids of texts, a word at a time, remembering the ids of words seen.

    The tokenizer drops white space and never joins what white space separates, so
    the ids of a text are those of its parts between ASCII white space. A part
    that is a plain Latin word, with or without a tail of punctuation, goes to
    the vocabulary model directly; anything else goes through the whole tokenizer.
    """

    _PLAIN = re.compile(r"([^\W\d_]+)([.,!?;:|()*$%&#\"-]*)")

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        # The usual printable stand-ins of bytes: printable Latin-1 stands for itself, the rest follows from 256.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        self._stand_in = {b: 256 + k for k, b in enumerate(rest)}
        self._forget()

    def _forget(self) -> None:
        """Start anew, so that memory stays bounded."""
        self._known: dict[bytes, int] = {}
        self._stems: dict[str, int] = {}
        self._flat, self._starts, self._sizes = array("I"), array("q"), array("q")

    def _stored(self, ids: Iterable[int]) -> int:
        self._starts.append(len(self._flat))
        self._flat.extend(ids)
        self._sizes.append(len(self._flat) - self._starts[-1])
        return len(self._starts) - 1

    def _stem(self, text: str) -> int:
        """Place of the ids of lower-case letters or of punctuation alone."""
        place = self._stems.get(text)
        if place is None:
            if text.isalpha():
                bytewise = text if text.isascii() else text.encode().decode("latin-1").translate(self._stand_in)
                ids = [t.id for t in self._model.tokenize(bytewise)]
            else:
                ids = self._full(text)
            place = self._stems[text] = self._stored(ids)
        return place

    def _full(self, text: str) -> list[int]:
        return self._tokenizer.encode(text, add_special_tokens=False).ids

    def _place(self, word: bytes) -> int:
        """Work out a new word and remember it."""
        text = word.decode("utf-8")
        plain = self._PLAIN.fullmatch(text.lower())
        stem, tail = plain.groups() if plain else ("", "")
        if plain and (stem.isascii() or (stem.isalpha() and max(stem) < "ɐ")):
            place = self._stem(stem)
            if tail:
                parts = [self._flat[self._starts[p] : self._starts[p] + self._sizes[p]] for p in (place, self._stem(tail))]
                place = self._stored(parts[0] + parts[1])
        else:
            place = self._stored(self._full(text))
        self._known[word] = place
        return place

    def encode(self, text: bytes) -> np.ndarray:
        """All ids of a text."""
        found = text.split()
        if not found:
            return np.zeros(0, np.uint32)
        if len(self._known) > REMEMBERED:
            self._forget()
        known = self._known
        places = [known.get(x, -1) for x in found]
        for k, place in enumerate(places):
            if place < 0:
                word = found[k]
                places[k] = known[word] if word in known else self._place(word)
        index = np.array(places)
        starts, sizes = np.frombuffer(self._starts, np.int64)[index], np.frombuffer(self._sizes, np.int64)[index]
        last = np.cumsum(sizes)
        return np.frombuffer(self._flat, np.uint32)[np.arange(last[-1]) + np.repeat(starts - (last - sizes), sizes)]


_ENCODERS: dict[str, WordTokens] = {}


def _encoder(path: str) -> WordTokens:
    """One for a worker process, so that later tasks find the words of earlier ones."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordTokens(path)
    return _ENCODERS[path]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())


class _Window:
    """An open sequence: pieces in order, with their ids while they may still be cut."""

    __slots__ = ("pieces", "used")

    def __init__(self) -> None:
        self.pieces: list[tuple] = []
        self.used = 0

    def add(self, piece: tuple) -> None:
        self.pieces.append(piece)
        self.used += len(piece[3])


def _rows(window: _Window, sequence: int) -> Iterator[tuple]:
    offset = 0
    for doc, row, start, ids, total in window.pieces:
        yield doc, row, start, len(ids), _crc(ids), total, sequence, offset
        offset += len(ids)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in _PIECE.split(", ")]
    cols = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)


def _open_batch(windows: list[_Window], group: int) -> pa.RecordBatch:
    """Pieces of windows that stay open, with their ids."""
    pieces = [p for w in windows for p in w.pieces]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([group] * len(pieces), pa.int64()),
            *(pa.array([p[k] for p in pieces], pa.int64()) for k in (0, 1, 2, 4)),
            pa.array([p[3].astype("<u4").tobytes() for p in pieces], pa.binary()),
        ],
        ["task", "doc_id", "row", "start", "doc_tokens", "ids"],
    )




def _packed(path: str, window: int, spaces: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        encoder = _encoder(path)
        open_windows: list[_Window] = []
        made, row, out = 0, 0, []

        def sequence() -> int:
            nonlocal made
            made += 1
            return (task << 33) | (made - 1)

        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = np.append(encoder.encode((text.as_py() or "").encode()), np.uint32(end_id)).astype(np.uint32)
                name, total, start = (task << 33) | row, len(ids), 0
                row += 1
                while total - start >= window:  # whole windows of one document
                    full = _Window()
                    full.add((doc, name, start, ids[start : start + window], total))
                    out.extend(_rows(full, sequence()))
                    start += window
                rest = ids[start:]
                if len(rest):
                    fits = [w for w in open_windows if window - w.used >= len(rest)]
                    if fits:
                        best = max(fits, key=lambda w: w.used)
                    else:
                        if len(open_windows) >= spaces:
                            fullest = max(open_windows, key=lambda w: w.used)
                            # Documents may be cut: what the fullest lacks comes from this one.
                            lacking = window - fullest.used
                            if lacking:
                                fullest.add((doc, name, start, rest[:lacking], total))
                                start, rest = start + lacking, rest[lacking:]
                            out.extend(_rows(fullest, sequence()))
                            open_windows.remove(fullest)
                        best = _Window()
                        open_windows.append(best)
                    best.add((doc, name, start, rest.copy(), total))
                    if best.used == window:
                        out.extend(_rows(best, sequence()))
                        open_windows.remove(best)
                if len(out) >= 4096:
                    yield _with_open(_batch(out), None)
                    out = []
        if out:
            yield _with_open(_batch(out), None)
        if open_windows:
            yield _with_open(None, _open_batch(open_windows, task))

    return run


_EITHER = _PIECE + ", task long, ids binary"


def _with_open(done: pa.RecordBatch | None, left: pa.RecordBatch | None) -> pa.RecordBatch:
    """One schema for finished pieces and for those of open windows."""
    some = done if done is not None else left
    schema = [(c.split()[0], pa.binary() if c.endswith("binary") else pa.int64()) for c in _EITHER.split(", ")]
    arrays = [
        some[name].cast(kind) if name in some.schema.names else pa.nulls(some.num_rows, kind) for name, kind in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in schema])


def _merged(window: int, first: int):
    """Fill windows with the left pieces of a group of tasks; the last window may stay short."""

    def run(key, table):
        group = key[0].as_py()
        current, made, out = _Window(), 0, []
        rows = sorted(table.select(["row", "start", "doc_id", "doc_tokens", "ids"]).to_pylist(), key=lambda r: (r["row"], r["start"]))
        for r in rows:
            ids, start = np.frombuffer(r["ids"], "<u4"), r["start"]
            while len(ids):
                part = ids[: window - current.used]
                current.add((r["doc_id"], r["row"], start, part, r["doc_tokens"]))
                ids, start = ids[len(part) :], start + len(part)
                if current.used == window:
                    out.extend(_rows(current, first | (group << 33) | made))
                    current, made = _Window(), made + 1
        # What is left is cut to powers of two, which need no padding.
        rest, size = list(current.pieces), current.used
        while size:
            part, current = 1 << (size.bit_length() - 1), _Window()
            while current.used < part:
                doc, row, start, ids, total = rest[0]
                own = ids[: part - current.used]
                current.add((doc, row, start, own, total))
                if len(own) < len(ids):
                    rest[0] = (doc, row, start + len(own), ids[len(own) :], total)
                else:
                    rest.pop(0)
            out.extend(_rows(current, first | (group << 33) | made))
            made, size = made + 1, size - part
        return pa.Table.from_batches([_batch(out)])

    return run


def packed(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    spaces: int = OPEN_WINDOWS,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, row.

    The ids of a document are those of its whole `text` and then `end_id`; a null
    or empty text has that one id. Every id lies in one piece. `start` counts the
    document's ids before the piece, `offset` those of the sequence. Sequences
    are full; the few left at the end have lengths that are powers of two.
    `row` tells repeated rows with one `doc_id` apart; a null `doc_id` stays null.
    Other columns of `docs` are ignored, an empty table gives no rows.
    `tokenizer` is the path of a tokenizer file that all machines can read.
    """
    if spaces < 1 or window < 1:
        raise ValueError("window and spaces must be positive")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = written(with_package(rows).mapInArrow(_packed(tokenizer, window, spaces, end_id), _EITHER), "packed")
    names = [c.split()[0] for c in _PIECE.split(", ")]
    done = made.where("ids IS NULL").select(*names)
    left = (
        made.where("ids IS NOT NULL")
        .withColumn("merge", F.floor(F.col("task") / MERGED_TASKS))
        .groupBy("merge")
        .applyInArrow(_merged(window, 1 << 62), _PIECE)
    )
    return done.unionByName(left).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "row"
    )
