"""Run a Python function over the rows of a DataFrame, in Arrow batches of bounded text."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

#: Texts are handed to the function in pieces of about this many characters, whole texts each.
PIECE_CHARS = 1_500_000


def pieces(batches: Iterable[pa.RecordBatch], text: str, limit: int = PIECE_CHARS) -> Iterator[dict[str, list]]:
    """Columns as lists, cut so that the texts of one piece stay near `limit`; a longer text is alone."""
    for part in slices(batches, text, limit):
        yield {name: part.column(name).to_pylist() for name in part.schema.names}


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = PIECE_CHARS) -> Iterator[pa.RecordBatch]:
    """The same pieces as batches. A slice copies nothing, so of a large batch only the rows at work become Python objects."""
    for batch in batches:
        start, held = 0, 0
        for i, size in enumerate(pc.fill_null(pc.utf8_length(batch.column(text)), 0).to_pylist()):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def cuts(batches: Iterable[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of one stay within `limit` bytes, whole rows each; a longer text is alone. A cut copies
    nothing, so of a large batch only the rows at work become Python objects."""
    for batch in batches:
        end = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        low = 0
        while low < batch.num_rows:
            held = end[low - 1] if low else 0
            high = max(int(np.searchsorted(end, held + limit, "right")), low + 1)
            yield batch.slice(low, high - low)
            low = high


def map_texts(
    df: DataFrame,
    fn: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]],
    schema: str,
    text: str = "text",
) -> DataFrame:
    """`fn` turns pieces of columns into pieces of the columns of `schema`; it runs once per partition."""
    arrow = to_arrow_schema(_struct(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in fn(pieces(batches, text)):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def _struct(schema: str) -> StructType:
    return _parse_datatype_string(schema)
