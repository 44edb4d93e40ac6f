"""Reading labelled fields back out of rendered or generated text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketgrain.functions import fixed_values as V
from ticketgrain.functions.text import strip

_WS = f"[{V.WHITESPACE_CLASS}]"
_WORD = r"[\p{L}\p{N}_]"


def _first_group(text: Column, pattern: str) -> Column:
    """Group 1 of the first match, null without a match (a group is never empty)."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def extract_type(text: Column) -> Column:
    return _first_group(text, f"(?iu){V.TYPE_LABEL}{_WS}*({_WORD}+)")


def extract_queue(text: Column) -> Column:
    return strip(_first_group(text, f"(?iu){V.QUEUE_LABEL}{_WS}*([^\\n]+)"))


def extract_priority(text: Column) -> Column:
    return F.lower(_first_group(text, f"(?iu){V.PRIORITY_LABEL}{_WS}*({_WORD}+)"))


def extract_classification(text: Column) -> Column:
    """Struct of type, queue and priority; each null when its label is absent."""
    return F.struct(
        extract_type(text).alias("type"),
        extract_queue(text).alias("queue"),
        extract_priority(text).alias("priority"),
    )


def extract_response(text: Column) -> Column:
    """Everything after the first response label, or the whole text; stripped."""
    tail = _first_group(text, f"(?isu){V.RESPONSE_LABEL}{_WS}*(.+)")
    return strip(F.coalesce(tail, text))
