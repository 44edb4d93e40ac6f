"""Quality rules: counts of words, symbols and repeats, and divergence from language references.

Only DataFrame functions.  Every measure is taken inside the document's row, in time linear in
its length (sorting apart).  Histograms of character classes and of common words are compared
with the references, the mean histograms of each language over all documents that pass the base
rules, by Jensen-Shannon distance; a document may be like any of them.  Short texts are judged
by the base rules alone, and so is everything while a language has too few documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketgrain.llm.common import NULL_ID, quoted, staged

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
GRAM = 5
# Length guards of the divergence rules.
MIN_CHARS = 200
MIN_COMMON_WORDS = 40
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.335
# Common words by language.
COMMON_WORDS = {
    "en": "the of and to in a is that for it on was as with be by this are at from",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "fr": "de la le et les des en un du une que est pour qui dans par sur au pas plus",
    "es": "de la que el en y a los se del las un por con no una su para es al",
}
WORD_BINS = tuple(sorted({w for words in COMMON_WORDS.values() for w in words.split()}))
CLASSES = ("upper", "digit", "mark", "wide", "space", "lower")
_BLANK = r"\x20\x09-\x0D"
_BLANKS = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"[{_BLANK}]+"), lambda w: w != "")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, although lambdas in it use it for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words in windows of GRAM words that stand twice or more, the first included."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    grams = _let(
        hashes,
        lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - (GRAM - 1)), lambda i: F.xxhash64(F.slice(h, i, GRAM))),
    )
    repeats = _let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(_let(_starts(g), _covered)))
    return F.when(F.size(words) <= GRAM, 0).otherwise(repeats)


def _starts(grams: Column) -> Column:
    """Places of the windows that have an equal one, ascending: equal ones are neighbours in order of hash and place."""

    def of(ordered: Column) -> Column:
        def same(j: Column, k: Column) -> Column:
            return F.coalesce(F.get(ordered, j)["h"] == F.get(ordered, k)["h"], F.lit(False))

        places = F.sequence(F.lit(0), F.size(ordered) - 1)
        alike = F.filter(places, lambda j: same(j, j - 1) | same(j, j + 1))
        return F.sort_array(F.transform(alike, lambda j: F.get(ordered, j)["i"]))

    return _let(F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), of)


def _covered(starts: Column) -> Column:
    """Words covered by windows at these places; the last one has no next place."""
    gaps = F.transform(starts, lambda start, k: F.least(F.lit(GRAM), F.get(starts, k + 1) - start))
    return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)


def _left(text: Column, removed: str) -> Column:
    """Characters left without those of the class."""
    return F.char_length(F.regexp_replace(text, f"[{removed}]+", ""))


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0), lambda total, n: total + n)


def measured(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """One narrow row for each row of ``docs``: base counts, class and common-word histograms."""
    lang = quoted(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    text = whole_text(quoted(text_col))
    rows = docs.select(
        quoted(id_col).cast("long").alias("doc_id"),
        row_key(id_col, text_col, lang).alias("row_key"),
        lang.alias("lang"),
        text.alias("text"),
        words_of(text).alias("words"),
    )
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(_BLANKS)) != "")
    common = F.filter("words", lambda w: F.lower(w).isin(*WORD_BINS))
    counted = rows.select(
        "doc_id",
        "row_key",
        "lang",
        F.size("words").alias("n_words"),
        F.char_length(text).alias("n_chars"),
        F.char_length(F.array_join("words", "")).alias("word_chars"),
        (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        # most characters go in this one pass
        F.regexp_replace(text, f"[a-z{_BLANK}]+", "").alias("rest"),
        # a blank on either side of each word, so that taking one word away leaves the others whole
        F.lower(F.concat(F.lit(" "), F.array_join(common, "  "), F.lit(" "))).alias("common"),
    )
    bins = [
        ((F.char_length("common") - F.char_length(F.replace("common", F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)).cast("int")
        for w in WORD_BINS
    ]
    rest, space = F.col("rest"), F.col("n_chars") - F.col("word_chars")
    classes = F.array(
        _left(rest, "^A-Z"),
        _left(rest, "^0-9"),
        _left(rest, r"A-Z0-9\x80-\x{10FFFF}"),
        _left(rest, r"\x00-\x7F"),
        space,
        F.col("word_chars") - F.char_length(rest),
    )
    numbers = ("n_words", "n_chars", "word_chars", "n_dup_lines", "n_repeat_words")
    narrow = counted.select(
        "doc_id", "row_key", "lang", *[F.col(c).cast("long").alias(c) for c in numbers],
        _left(rest, "^#*$%&|<>").cast("long").alias("n_symbols"), classes.alias("classes"), F.array(*bins).alias("bins"),
    )
    other = (F.col("n_words") - _total(F.col("bins"))).cast("int")
    return narrow.withColumn("bins", F.concat("bins", F.array(other))).withColumn("base_failed", base_failed())


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def row_key(id_col: str, text_col: str, lang: Column) -> Column:
    """Names a row by what the rules look at; rows with the same key get the same verdict."""
    return F.struct(
        F.coalesce(quoted(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
        F.xxhash64(whole_text(quoted(text_col))).alias("text"),
        F.xxhash64(F.coalesce(lang, F.lit(""))).alias("lang"),
    )


def whole_text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def language_references(rows: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Class and word shares of each language that has common words here: at most one row for each of them."""
    sums = [F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(len(CLASSES))]
    sums += [F.sum(F.col("bins")[i]).alias(f"b{i}") for i in range(len(WORD_BINS) + 1)]
    fit = rows.filter(~F.col("base_failed") & F.col("lang").isin(*COMMON_WORDS)).groupBy("lang")
    found = {}
    for r in fit.agg(*sums).collect():
        classes = [r[f"c{i}"] for i in range(len(CLASSES))]
        bins = [r[f"b{i}"] for i in range(len(WORD_BINS) + 1)]
        found[r.lang] = ([n / sum(classes) for n in classes], [n / sum(bins) for n in bins])
    return found


def divergence(counts: Column, total: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance (0 to 1) of a histogram and a reference."""

    def part(count: Column, share: Column) -> Column:
        p = count / total
        middle = (p + share) / 2
        mine = F.when(p > 0, p * F.log2(p / middle)).otherwise(0.0)
        return mine + F.when(share > 0, share * F.log2(share / middle)).otherwise(0.0)

    parts = F.zip_with(counts, F.array(*map(F.lit, reference)), part)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda total, x: total + x) / 2))


def judged(rows: DataFrame) -> DataFrame:
    """``measured`` rows (staged) with class_distance, word_distance (null where a guard holds) and kept."""
    references = language_references(rows)
    nothing = F.lit(None).cast("double")
    by_class, by_word = nothing, nothing
    if references:
        here = F.col("lang").isNull() | F.col("lang").isin(*COMMON_WORDS)
        both = [
            [divergence(F.col(c), F.col(n), r[i]) for _, r in sorted(references.items())]
            for i, (c, n) in enumerate((("classes", "n_chars"), ("bins", "n_words")))
        ]
        nearest = [F.least(*x) if len(x) > 1 else x[0] for x in both]
        by_class = F.when(here & (F.col("n_chars") >= MIN_CHARS), nearest[0])
        by_word = F.when(here & (F.col("n_words") >= MIN_COMMON_WORDS), nearest[1])
    rows = rows.withColumn("class_distance", by_class).withColumn("word_distance", by_word)
    near = (F.coalesce("class_distance", F.lit(0.0)) <= MAX_CLASS_DISTANCE) & (
        F.coalesce("word_distance", F.lit(0.0)) <= MAX_WORD_DISTANCE
    )
    return rows.withColumn("kept", ~F.col("base_failed") & near)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance,
    word_distance, kept: one row for each row of ``docs``.

    Null and empty texts have no words and fail.  A row without a language is held against all
    references like any other; for languages without common words here the base rules decide, as they
    do without any reference (no language column).  Repeated rows are judged each.
    """
    rows = judged(staged(measured(docs, id_col, text_col, lang_col), "quality"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "class_distance", "word_distance", "kept",
    )


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows that the rules reject; columns as they were."""
    rows = judged(staged(measured(docs, id_col, text_col, lang_col), "quality"))
    rejected = rows.filter(~F.col("kept")).select("row_key").distinct()
    lang = quoted(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    whole = docs.select(row_key(id_col, text_col, lang).alias("row_key"), F.struct(*map(quoted, docs.columns)).alias("row"))
    return whole.join(rejected, "row_key", "left_anti").select("row.*")
