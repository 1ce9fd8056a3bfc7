"""Pieces of documents that keep their number, so that answers about a piece can come back to it."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stalewatch.llm.tables import pieces, with_columns
from stalewatch.staging import stage

PIECE = "__piece"
#: Documents without a doc_id come after all others.
LAST = (1 << 63) - 1


def numbered_pieces(docs: DataFrame, text: str, size: int) -> DataFrame:
    """Adds the number of the piece of about ``size`` bytes; written once, so that it stays the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in pieces(batches, text, size):
            yield with_columns(batch, **{PIECE: pa.array([number] * batch.num_rows, pa.int64())})
            number += 1

    schema = T.StructType([*docs.schema.fields, T.StructField(PIECE, T.LongType())])
    return stage(docs.mapInArrow(run, schema), "pieces")


def whole_pieces(batches: Iterator[pa.RecordBatch], doc_id: str, text: str) -> Iterator[tuple[int, np.ndarray, list[bytes]]]:
    """Number, ids and texts of each piece; its rows lie one after the other."""
    number, ids, texts = None, [], []
    for batch in batches:
        number_of = batch.column(batch.schema.get_field_index(PIECE)).to_numpy()
        limits = bounds(number_of)
        for start, end in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
            if number_of[start] != number:
                if texts:
                    yield number, np.concatenate(ids), texts
                number, ids, texts = int(number_of[start]), [], []
            part = batch.slice(start, end - start)
            ids.append(ids_of(part.column(part.schema.get_field_index(doc_id))))
            texts += bytes_of(part.column(part.schema.get_field_index(text)))
    if texts:
        yield number, np.concatenate(ids), texts


def bounds(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    return np.r_[np.flatnonzero(np.r_[True, values[1:] != values[:-1]]), len(values)] if len(values) else np.zeros(1, np.int64)


def bytes_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def ids_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.array([LAST if i is None else i for i in column.to_pylist()], np.int64)
