"""Slices of Arrow columns, so that a batch of long rows is never unpacked as a whole."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa

# Columns are unpacked in slices of about this many bytes: Python's strings are ten times as large.
SLICE_BYTES = 1024 * 1024


def unpacked(*columns: pa.Array, size: int | None = None) -> Iterator[tuple[pd.Series, ...]]:
    """The same rows of all columns as pandas, a slice of about ``size`` bytes or one long row at a time."""
    rows = len(columns[0])
    step = max(1, rows * (size or SLICE_BYTES) // max(1, sum(c.nbytes for c in columns)))
    for start in range(0, rows, step):
        yield tuple(c.slice(start, step).to_pandas() for c in columns)
