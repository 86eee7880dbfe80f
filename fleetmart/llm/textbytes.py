"""Texts of Arrow batches as plain byte arrays, a bounded number of bytes at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    filled = pc.fill_null(array.cast(pa.large_binary()), b"")
    if isinstance(filled, pa.ChunkedArray):
        filled = filled.combine_chunks()
    _, offsets, data = filled.buffers()
    at = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return held, at


def slices(array: pa.Array, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts that hold ``most`` bytes, or one longer text.

    ``offsets`` has one entry more than the run has rows and begins with 0; a NULL text is empty.
    """
    if not len(array):
        return
    data, at = _of(array)
    first = 0
    while first < len(array):
        last = int(np.searchsorted(at, at[first] + most, "right")) - 1
        last = min(max(last, first + 1), len(array))
        yield first, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last
