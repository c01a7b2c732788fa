"""Arrow batches in bounded slices, and arrays of arrays as one flat numpy array with lengths."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def release() -> None:
    """Hand freed memory back to the machine: a worker lives on and the next stage needs it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of ``column``; a longer value stands alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end
        release()


def texts_of(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column as one array with nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def starts_of(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths, dtype=np.int64) - lengths


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``flat[starts[0] : starts[0] + lengths[0]]``, ``flat[starts[1] : ...]``, ... in one array."""
    shift = np.repeat(starts - starts_of(lengths), lengths)
    return flat[shift + np.arange(len(shift), dtype=np.int64)]


def segment_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The sum of each segment; zero for empty ones."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths, dtype=np.int64)
    return total[ends] - total[ends - lengths]
