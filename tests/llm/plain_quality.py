"""The quality rules as plain loops."""

import math
from collections import Counter, defaultdict

from ticketgrain.llm import quality_rules as rules

BLANKS = " \t\n\x0b\x0c\r"


def words_of(text):
    for c in BLANKS[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def measures(text):
    text = text or ""
    words = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {i + k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)}
    classes = [0] * 6
    for c in text:
        kind = (
            0 if "A" <= c <= "Z" else 1 if "0" <= c <= "9" else 4 if c in BLANKS else 5 if "a" <= c <= "z" else 3 if c > "\x7f" else 2
        )
        classes[kind] += 1
    common = Counter(w.lower() for w in words)
    bins = [common[w] for w in rules.WORD_BINS]
    bins.append(len(words) - sum(bins))
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    counts = (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), failed,
    )
    return counts, classes, bins


def distance(counts, shares):
    total, out = sum(counts), 0.0
    for n, q in zip(counts, shares, strict=True):
        p = n / total
        out += (p and p * math.log2(2 * p / (p + q))) + (q and q * math.log2(2 * q / (p + q)))
    return math.sqrt(max(0.0, out / 2))


def quality(rows):
    """For (id, text, lang) rows: (id, counts..., class distance, word distance, kept) in the same order."""
    found = [measures(t) for _, t, _ in rows]
    pool = defaultdict(lambda: [[0] * 6, [0] * (len(rules.WORD_BINS) + 1)])
    for (_, _, lang), (counts, classes, bins) in zip(rows, found, strict=True):
        if lang in rules.COMMON_WORDS and not counts[-1]:
            pool[lang] = [[a + b for a, b in zip(x, y, strict=True)] for x, y in zip(pool[lang], (classes, bins), strict=True)]
    known = {lang: [[n / sum(x) for n in x] for x in pool[lang]] for lang in pool}
    out = []
    for (doc_id, text, lang), (counts, classes, bins) in zip(rows, found, strict=True):
        by_class = by_word = None
        tested = known and (lang is None or lang in rules.COMMON_WORDS)
        if tested and sum(classes) >= rules.MIN_CHARS:
            by_class = min(distance(classes, k[0]) for k in known.values())
        if tested and counts[0] >= rules.MIN_COMMON_WORDS:
            by_word = min(distance(bins, k[1]) for k in known.values())
        near = (by_class or 0) <= rules.MAX_CLASS_DISTANCE and (by_word or 0) <= rules.MAX_WORD_DISTANCE
        out.append((doc_id, *counts, by_class, by_word, not counts[-1] and near))
    return out
