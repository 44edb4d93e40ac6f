"""Clipped n-gram overlaps of two token lists, Arrow batch by Arrow batch."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketgrain.functions.batches import unpacked


def clipped_overlap(left, right, n: int) -> int:
    """Common n-grams, each as often as it stands in both lists."""

    def grams(tokens) -> Counter:
        return Counter(zip(*(tokens[i:] for i in range(n))))

    return sum((grams(left) & grams(right)).values())


def overlaps(left: Column, right: Column, longest: int) -> Column:
    """Struct n1, n2, ... of the clipped overlaps up to ``longest`` tokens."""
    names = [f"n{n}" for n in range(1, longest + 1)]

    def batch(a: pa.Array, b: pa.Array) -> pa.Array:
        found: dict[str, list[int]] = {name: [] for name in names}
        for some, others in unpacked(a, b):
            for x, y in zip(some, others):
                x, y = list(x), list(y)
                for n, name in enumerate(names, 1):
                    found[name].append(clipped_overlap(x, y, n))
        return pa.StructArray.from_arrays([pa.array(found[name], pa.int64()) for name in names], names)

    return F.arrow_udf(batch, ", ".join(f"{name} long" for name in names))(left, right)
