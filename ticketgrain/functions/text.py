"""Text cleaning and measuring as column expressions (no Python at run time)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketgrain.functions import fixed_values as V

_WS = f"[{V.WHITESPACE_CLASS}]"
_BLANKS = " " * len(V.WHITESPACE_CHARS)

# Classes are written as what they match: Java runs a negated class of several
# ranges about ten times slower than the same set spelled out.
_NOT_ALNUM = r"[\x00-/:-`{-\x{10ffff}]"
_NOT_ALNUM_OR_BLANK = r"[\x00-\x1f!-/:-`{-\x{10ffff}]"

# An address is a run of non-blanks with an "@" that has a character on both
# sides.  The second branch consumes every other run and puts it back, so each run
# is looked at once: linear even for one very long run (base64, say).
_ADDRESS = "(?:[^ @]++|@[^ @]*+)@[^ ]+|([^ ]+)"


def strip(text: Column) -> Column:
    """Trim every Unicode whitespace character from both ends."""
    return F.btrim(text, F.lit(V.WHITESPACE_CHARS))


def _blanks(text: Column) -> Column:
    """Every whitespace character as a plain blank."""
    return F.translate(text, V.WHITESPACE_CHARS, _BLANKS)


def basic_clean(text: Column, keep_punctuation: bool = False) -> Column:
    """Lower-case text without links, addresses and (by default) punctuation; null becomes ''.

    ``keep_punctuation=True`` is the report variant: any run that contains
    ``http`` or ``www`` is dropped from there on, other characters stay.
    Whitespace is unified first; it ends up as single blanks either way.
    """
    out = _blanks(F.lower(F.coalesce(text.cast("string"), F.lit(""))))
    if keep_punctuation:
        out = F.regexp_replace(out, "http[^ ]+|www[^ ]+", "")
        out = F.regexp_replace(out, _ADDRESS, "$1")
    else:
        out = F.regexp_replace(out, f"https?://{V.URL_CHARS}+", "")
        out = F.regexp_replace(out, rf"www\.{V.URL_CHARS}+", "")
        out = F.regexp_replace(out, _ADDRESS, "$1")
        out = F.regexp_replace(out, f"{_NOT_ALNUM_OR_BLANK}+", "")
    return F.btrim(F.regexp_replace(out, " +", " "))


def clean_text(text: Column) -> Column:
    """Keep the layout: blank-line runs become one blank line, space runs one space."""
    out = F.coalesce(text, F.lit(""))
    out = F.regexp_replace(out, f"\n{_WS}*\n", "\n\n")
    out = F.regexp_replace(out, " +", " ")
    return strip(out)


def words(text: Column) -> Column:
    """Whitespace tokens; the empty array for null or blank text."""
    return F.array_remove(F.split(_blanks(F.coalesce(text, F.lit(""))), " "), "")


def char_count(text: Column) -> Column:
    return F.length(text).cast("long")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def is_blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


def preview(text: Column, chars: int) -> Column:
    """The first ``chars`` characters."""
    return F.substring(text, 1, chars)


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def after_first_line(text: Column) -> Column:
    """What follows the first newline; '' when there is none."""
    newline = F.instr(text, "\n")
    return F.when(newline > 0, F.substring(text, newline + 1, F.length(text))).otherwise(F.lit(""))


def ticket_text(subject: Column, body: Column) -> Column:
    """Subject, blank line, body; the blank line stays when a side is missing."""
    return F.concat(F.coalesce(subject, F.lit("")), F.lit("\n\n"), F.coalesce(body, F.lit("")))


def format_tags(tags: Sequence[Column]) -> Column:
    """Non-empty tags joined by ', ', or the text 'None'."""
    joined = F.concat_ws(", ", *[F.nullif(t.cast("string"), F.lit("")) for t in tags])
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit("None"))


def rouge_words(text: Column) -> Column:
    """Lower-case tokens of [a-z0-9]; everything else separates."""
    spaced = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), f"{_NOT_ALNUM}+", " ")
    return F.array_remove(F.split(spaced, " "), "")


def bleu_words(text: Column) -> Column:
    """Lower-case whitespace tokens."""
    return words(F.lower(F.coalesce(text, F.lit(""))))


def extend_ngrams(shorter: Column, tokens: Column, n: int) -> Column:
    """n-grams from the (n-1)-grams: each is paired with the token after it."""
    count = F.greatest(F.size(tokens) - F.lit(n - 1), F.lit(0))
    return F.zip_with(
        F.slice(shorter, F.lit(1), count),
        F.slice(tokens, F.lit(n), count),
        lambda head, tail: F.concat(head, F.lit(" "), tail),
    )


def ngrams(tokens: Column, n: int) -> Column:
    """Space-joined n-grams of a token column."""
    grams = tokens
    for width in range(2, n + 1):
        grams = extend_ngrams(grams, tokens, width)
    return grams
