"""Arrow columns as numpy arrays, for operators that work inside ``mapInArrow``."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Lower the rows that Spark puts into one Arrow batch for this session, when more are allowed.

    Spark counts rows, not bytes, and holds whole batches on both sides: 10,000 texts of some kilobytes are tens of
    megabytes in the executor and again in its worker.
    """
    if int(spark.conf.get(_BATCH_ROWS)) > rows or int(spark.conf.get(_BATCH_ROWS)) <= 0:
        spark.conf.set(_BATCH_ROWS, str(rows))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary column and the n + 1 offsets of its values (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    places = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[places[0] : places[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, places - places[0]


def slices(batches: Iterable[pa.RecordBatch], text: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the text of each has about ``most_bytes`` (a longer row is a batch of its own)."""
    for batch in batches:
        _, ends = text_buffers(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, ends[at] + most_bytes, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def fixed_binary(rows: np.ndarray) -> pa.Array:
    """Each row of a two-dimensional array as one binary value."""
    rows = np.ascontiguousarray(rows)
    size = rows.shape[1] * rows.itemsize
    return pa.array([r.tobytes() for r in rows], pa.binary()) if size else pa.array([b""] * len(rows), pa.binary())
