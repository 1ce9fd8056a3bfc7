"""Reading the corpus tables and cutting Arrow batches into pieces of bounded size."""

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

PIECE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table, with two settings that whole texts need.

    Arrow batches are held to ``PIECE_BYTES``, as texts can be of any length. Shuffle files go when their
    query ends, so that a job of several steps needs the disk of its largest step.
    """
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(PIECE_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(batches: Iterator[pa.RecordBatch], text: str, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``size`` bytes of the text column; a longer text stays alone."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        start = filled = 0
        for row, length in enumerate(lengths):
            if row > start and filled + length > size:
                yield batch.slice(start, row - start)
                start, filled = row, 0
            filled += int(length)
        yield batch.slice(start)


def with_columns(batch: pa.RecordBatch, drop: Sequence[str | None] = (), **columns: pa.Array) -> pa.RecordBatch:
    """The batch without ``drop`` and with new columns at the end."""
    names = [n for n in batch.schema.names if n not in drop]
    arrays = [batch.column(batch.schema.get_field_index(n)) for n in names]
    return pa.RecordBatch.from_arrays([*arrays, *columns.values()], names=[*names, *columns])
