"""Bounded walks over Arrow batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Bytes that Spark puts into an Arrow batch at most, unless a single row is longer; its own default of 64 MB takes
#: several times that outside the heap for each running task.
BATCH_BYTES = 8 << 20
#: Bytes of text that one step of a Python worker holds, unless a single text is longer.
STEP_BYTES = 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after the session is told to keep Arrow batches to ``BATCH_BYTES``."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of each text, None for null."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def steps(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose texts add up to about ``limit`` bytes; one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def lists(values, offsets, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat values and row offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
