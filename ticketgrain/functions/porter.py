"""Porter stemming (M. F. Porter, "An algorithm for suffix stripping", 1980).

The extended variant common in Python text tooling is followed: short words stay,
a few irregular words are listed, and some suffix rules differ slightly from the
paper.  Only distinct words per Arrow batch are stemmed (see ``stem_words``).
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketgrain.functions.batches import unpacked

# --- fixed values: irregular forms and suffix rules ---------------------------
_IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
_STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"), ("logi", "log"),
)
_STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
)
_STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def _shape(stem: str) -> str:
    """One letter per character: 'v' vowel, 'c' consonant ('y' is a vowel after a consonant)."""
    shape = ""
    for i, ch in enumerate(stem):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and shape[-1] == "c")
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_syllable(word: str) -> bool:
    """Ends consonant-vowel-consonant (last not w, x, y), or is a two-letter vowel-consonant."""
    shape = _shape(word)
    return (shape.endswith("cvc") and word[-1] not in "wxy") or shape == "vc"


def _longest(word: str, suffixes):
    """Rules are tried in their listed order; the first suffix that fits decides."""
    return next((s for s in suffixes if word.endswith(s)), None)


def _plural(word: str) -> str:
    if word.endswith("ies") and len(word) == 4:
        return word[:-1]
    for suffix, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if word.endswith(suffix):
            return word[: len(word) - len(suffix)] + new
    return word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-3] + ("ie" if len(word) == 4 else "i")
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    suffix = _longest(word, ("ed", "ing"))
    if suffix is None or "v" not in _shape(word[: -len(suffix)]):
        return word
    stem = word[: -len(suffix)]
    if re.search("(at|bl|iz)$", stem):
        return stem + "e"
    if _double_consonant(stem):
        return stem if stem[-1] in "lsz" else stem[:-1]
    if _measure(stem) == 1 and _short_syllable(stem):
        return stem + "e"
    return stem


def _final_y(word: str) -> str:
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        return word[:-1] + "i"
    return word


def _swap(word: str, rules) -> str:
    for suffix, new in rules:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            # "logi" keeps its l when the rest is measured
            measured = word[:-3] if suffix == "logi" else stem
            return stem + new if _measure(measured) > 0 else word
    return word


def _adverbs(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _adverbs(word[:-2])
    return _swap(word, _STEP2)


def _residual(word: str) -> str:
    suffix = _longest(word, _STEP4)
    if suffix is None:
        return word
    stem = word[: -len(suffix)]
    if _measure(stem) <= 1 or (suffix == "ion" and stem[-1] not in "st"):
        return word
    return stem


def _tidy(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        measure = _measure(stem)
        if measure > 1 or (measure == 1 and not _short_syllable(stem)):
            word = stem
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def stem(word: str) -> str:
    word = word.lower()
    if word in _IRREGULAR:
        return _IRREGULAR[word]
    if len(word) <= 2:
        return word
    for step in (_plural, _past, _final_y, _adverbs, lambda w: _swap(w, _STEP3), _residual, _tidy):
        word = step(word)
    return word


def _stem_batch(tokens: pa.Array) -> pa.Array:
    known: dict[str, str] = {}

    def one(token: str) -> str:
        if len(token) <= 3:
            return token
        if token not in known:
            known[token] = stem(token)
        return known[token]

    kind = pa.list_(pa.string())
    parts = [pa.array([[one(t) for t in row] for row in rows], kind) for (rows,) in unpacked(tokens)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def stem_words(tokens: Column) -> Column:
    """Stem tokens longer than three characters; each distinct word once per Arrow batch."""
    return F.arrow_udf(_stem_batch, T.ArrayType(T.StringType()))(tokens)
