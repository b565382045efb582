"""A table of bits of fixed size over 64-bit keys: keys that are not in it are surely unknown.

Every key marks two bits, so that a table with room to spare knows few keys that it was not given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 26
_PARTS_LOG = 6
_U = np.uint64


def _cells(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of every key: its highest bits, and those below them."""
    keys = keys.view(np.uint64)
    return (keys >> _U(64 - BITS)).astype(np.int64), ((keys >> _U(64 - 2 * BITS)) & _U((1 << BITS) - 1)).astype(np.int64)


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of the table that the keys of this task fall in."""
    size = (1 << BITS) >> _PARTS_LOG
    tables: dict[int, np.ndarray] = {}
    for batch in batches:
        cell = batch["cell"].to_numpy()
        for part in np.unique(cell // size).tolist():
            table = tables.setdefault(part, np.zeros(size, bool))
            table[cell[cell // size == part] % size] = True
    if tables:
        bits = [np.packbits(t).tobytes() for t in tables.values()]
        yield pa.RecordBatch.from_pydict({"part": pa.array(list(tables), pa.int32()), "bits": pa.array(bits, pa.binary())})


def table_of(keys: DataFrame) -> np.ndarray:
    """The table of a frame with one bigint column `key`: 8 MiB for any number of keys, all parts made by one job."""
    first = F.shiftrightunsigned("key", 64 - BITS)
    second = F.shiftrightunsigned("key", 64 - 2 * BITS).bitwiseAND((1 << BITS) - 1)
    rows = (
        keys.select(F.explode(F.array(first, second)).alias("cell"))
        .distinct()
        .repartition(1 << _PARTS_LOG, F.shiftright("cell", BITS - _PARTS_LOG))
        .mapInArrow(_marked, "part int, bits binary")
        .collect()
    )
    size = (1 << BITS) >> _PARTS_LOG >> 3
    out = np.zeros((1 << BITS) >> 3, np.uint8)
    for row in rows:
        out[row["part"] * size : (row["part"] + 1) * size] |= np.frombuffer(row["bits"], np.uint8)
    return out


def known(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether both bits of a key are marked; true for every key of the table."""
    out = np.ones(len(keys), bool)
    for cell in _cells(keys):
        out &= (table[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
    return out
