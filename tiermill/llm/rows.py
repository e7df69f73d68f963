"""Texts to Python tasks in slices of bounded size, and back as Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Characters of text that a task works on at once. A longer text is a slice of its own.
SLICE_CHARS = 2_000_000


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold about SLICE_CHARS characters."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= SLICE_CHARS:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def map_texts(docs: DataFrame, work: Callable[[list[str]], dict[str, list]], schema: str, keys: dict[str, Column], text: Column | str = "text") -> DataFrame:
    """The columns `keys`, passed by, and for the text of each row the columns of `schema` that `work(texts)` gives.

    A null text is an empty one. Only keys and text reach Python, so other columns of `docs` may have any name. Work
    is per row, without a shuffle: a lost executor costs its tasks only. Batches are bounded by
    spark.sql.execution.arrow.maxBytesPerBatch, slices by SLICE_CHARS.
    """
    text = F.col(text) if isinstance(text, str) else text
    plain = docs.select(F.struct(*(c.alias(n) for n, c in keys.items())).alias("k"), text.cast("string").alias("t"))
    own = StructType.fromDDL(schema)
    whole = StructType([plain.schema["k"], *own.fields])
    arrow = to_arrow_schema(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            for a, b in slices(texts):
                made = work(texts[a:b])
                columns = [pa.array(made[f.name], f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns], ["k", *arrow.names])

    return plain.mapInArrow(run, whole).select("k.*", *own.names)
