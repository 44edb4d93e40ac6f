"""Tables that every operator must take: nulls, empty and long texts, repeats, odd columns."""

from __future__ import annotations

from collections import Counter

LONG = "one long line of words, again and again. " * 6_000
ROWS = [
    (5, "A plain text about the river and the hill.\nWith two lines."),
    (5, "A plain text about the river and the hill.\nWith two lines."),
    (5, "Another text under the same id."),
    (None, "No id at all, but words."),
    (None, None),
    (7, None),
    (8, ""),
    (9, " \t\n\x0b\x0c\r "),
    (10, "Ünïcödé ŠŽ 漢字 🙂 “quotes” <|endoftext|> don't <x> \xa0 1234"),
    (11, LONG),
    (-3, "x"),
    (2**62, "last of all, a text of some words"),
    (12, "A plain text about the river and the hill.\nWith two lines."),
]
# names that the operators use inside, and one that needs quoting
EXTRA = ("bucket", "fingerprint", "n_words", "_salt", "key", "words", "a.b", "row")


def table(spark, rows=None):
    rows = ROWS if rows is None else rows
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)
    filled = [(i, t, "en", None, None, *("?" for _ in EXTRA)) for i, t in rows]
    return spark.createDataFrame(filled, schema)


def empty(spark):
    return table(spark, []).limit(0)


def bag(df, *columns):
    return Counter(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def sf_texts(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
