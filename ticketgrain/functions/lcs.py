"""Longest common subsequence length of two token lists.

Bit-parallel recurrence (Crochemore et al. 2001; Hyyro 2004): one big-integer row
per token of the second list, so whole texts are compared in O(n*m/64).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketgrain.functions.batches import unpacked

ColumnOrName = Column | str


def lcs_length(left, right) -> int:
    if len(left) == 0 or len(right) == 0:
        return 0
    places: dict[str, int] = {}
    for i, token in enumerate(left):
        places[token] = places.get(token, 0) | (1 << i)
    full = (1 << len(left)) - 1
    row = full
    for token in right:
        match = places.get(token)
        if match is not None:
            hit = row & match
            row = ((row + hit) | (row - hit)) & full
    return (full ^ row).bit_count()


def _lcs_batch(left: pa.Array, right: pa.Array) -> pa.Array:
    return pa.array([lcs_length(a, b) for some, others in unpacked(left, right) for a, b in zip(some, others)], pa.int64())


def lcs_tokens(left: ColumnOrName, right: ColumnOrName) -> Column:
    """Length of the longest common subsequence, Arrow batch by Arrow batch."""
    return F.arrow_udf(_lcs_batch, T.LongType())(left, right)
