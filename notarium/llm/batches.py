"""Slices of Arrow batches that keep a worker's memory small."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text handled at once; the arrays made from it take some forty times as much.
SLICE_BYTES = 1 << 20
SLICE_ROWS = 8192


def slices(batches: Iterator[pa.RecordBatch], column: str | list[str], most_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the named text columns hold about ``most_bytes``; a longer row is a slice of its own."""
    names = [column] if isinstance(column, str) else column
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = np.zeros(n + 1, np.int64)
        for name in names:
            length = pc.binary_length(batch.column(batch.schema.get_field_index(name))).fill_null(0)
            size[1:] += np.cumsum(length.to_numpy(zero_copy_only=False), dtype=np.int64)
        begin = 0
        while begin < n:
            end = int(np.searchsorted(size, size[begin] + most_bytes, side="right")) - 1
            end = min(max(end, begin + 1), begin + SLICE_ROWS, n)
            yield batch.slice(begin, end - begin)
            begin = end
