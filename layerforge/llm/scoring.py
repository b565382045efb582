"""A score per row from a numpy function of its text."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerforge.llm import words as w
from layerforge.llm.storage import with_package


def with_score(docs: DataFrame, columns: Sequence[str], score: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """`row, score`: the named columns as a struct, so that no name can clash, and the score of the whole `text`."""
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    rows = with_package(docs).select(row, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in w.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part["row"], pa.array(score(part["text"]).astype(float))], ["row", "score"])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())]))
