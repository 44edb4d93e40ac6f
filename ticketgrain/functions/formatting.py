"""Numbers as report text.  The numeric column stays the result, this is for display.

``format_number`` with a pattern rounds the exact binary value half-even, which is
what printf-style formatting does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _pattern(value: Column, pattern: str) -> Column:
    return F.call_function("format_number", value.cast("double"), F.lit(pattern))


def fixed4(value: Column) -> Column:
    return _pattern(value, "0.0000")


def percent2(value: Column) -> Column:
    return F.concat(_pattern(value * 100, "0.00"), F.lit("%"))


def signed_percent2(value: Column) -> Column:
    """The value is already a percentage."""
    return F.concat(_pattern(value, "+0.00;-0.00"), F.lit("%"))
