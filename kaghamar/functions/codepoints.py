"""Arrow string columns as flat code-point arrays, so that numpy sees a whole batch at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def as_string(column: pa.Array) -> pa.Array:
    """The column as a plain (32-bit offset) string array without nulls; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def flatten(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets): row i is `points[offsets[i]:offsets[i + 1]]`; null counts as empty."""
    column = as_string(column)
    if len(column) == 0:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if column.buffers()[2] is None:
        return np.zeros(0, np.uint32), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    try:
        points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        starts = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        return points, starts[ends - ends[0]].astype(np.int64)
    except UnicodeDecodeError:  # ill-formed bytes: row by row, with replacement characters
        rows = [bytes(raw[a:b]).decode("utf-8", "replace").encode("utf-32-le") for a, b in zip(ends[:-1] - ends[0], ends[1:] - ends[0])]
        offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in rows])]).astype(np.int64)
        return np.frombuffer(b"".join(rows), np.uint32), offsets


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose `column` holds about `most` bytes; a longer row stands alone."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes) - sizes) // most
    cuts = np.flatnonzero(np.diff(group, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], batch.num_rows]):
        yield batch.slice(a, b - a)
