"""Line deduplication by winnowing over line hashes.

A run of lines is a repeat if its content, at least ``MIN_WORDS`` words, also stands earlier, in
(id, hash of the text, line) order.  Lines without words do not count.

1. Winnowing.  A gram is the shortest run from a line on with half of ``MIN_WORDS`` words; a
   window the shortest with all of them.  Each window selects the gram with the smallest hash
   that lies in it.  What a window selects depends on its content only, so a repeated run shares
   at least one selected gram with its earlier copy.
2. Positions of grams that were selected twice or more are joined back to their documents.
3. Extension.  From each of these positions windows are laid both ways, forward from every line
   and backward from every line, as long as they hold a repeated gram.  A window whose content
   has an earlier place is a repeat, and overlapping repeats join to the longest one: forward
   windows reach its last but few lines, backward windows the rest.  Each window asks only for
   the first place of its content, so a passage that thousands of documents share costs one row
   for each of them and no pairs.
4. All lines of later repeats are deleted, with blank lines between two deleted lines.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketgrain.llm.common import map_texts, quoted, staged
from ticketgrain.llm.simhash import order_id_of

MIN_WORDS = 50
_DIGEST = 16


def content_lines(text: str) -> tuple[list[int], bytes, list[int]]:
    """Places, joined 128-bit hashes and word counts of the lines that have words."""
    places, hashes, counts = [], [], []
    for place, line in enumerate(text.split("\n")):
        words = line.encode().split()
        if words:
            places.append(place)
            hashes.append(xxhash.xxh3_128_digest(b" ".join(words)))
            counts.append(len(words))
    return places, b"".join(hashes), counts


def run_ends(counts: list[int], least: int) -> list[int | None]:
    """For each line the last line of the shortest run from it with ``least`` words, if there is one."""
    ends: list[int | None] = []
    end, words = -1, 0
    for start, count in enumerate(counts):
        while words < least and end + 1 < len(counts):
            end += 1
            words += counts[end]
        ends.append(end if words >= least else None)
        words -= count
    return ends


def run_starts(counts: list[int], least: int) -> list[int | None]:
    """For each line the first line of the shortest run up to it with ``least`` words."""
    last = len(counts) - 1
    return [None if e is None else last - e for e in reversed(run_ends(counts[::-1], least))]


def content(hashes: bytes, first: int, last: int) -> bytes:
    return xxhash.xxh3_128_digest(hashes[_DIGEST * first : _DIGEST * (last + 1)])


def winnow(hashes: bytes, counts: list[int], least: int = MIN_WORDS) -> dict[int, bytes]:
    """Selected grams by their first line."""
    gram_ends = run_ends(counts, (least + 1) // 2)
    grams = [None if e is None else content(hashes, i, e) for i, e in enumerate(gram_ends)]
    selected: dict[int, bytes] = {}
    for start, end in enumerate(run_ends(counts, least)):
        if end is None:
            break
        inside = start
        best = start
        while inside <= end and gram_ends[inside] is not None and gram_ends[inside] <= end:
            if grams[inside] < grams[best]:
                best = inside
            inside += 1
        selected[best] = grams[best]
    return selected


def windows_around(counts: list[int], hits: Iterable[int], least: int = MIN_WORDS) -> set[tuple[int, int]]:
    """First and last lines of the windows that hold a gram starting at one of ``hits``."""
    gram_ends = run_ends(counts, (least + 1) // 2)
    marked = set(hits)
    next_hit: list[int | None] = [None] * (len(counts) + 1)
    for line in range(len(counts) - 1, -1, -1):
        next_hit[line] = line if line in marked else next_hit[line + 1]
    forward = [(i, e) for i, e in enumerate(run_ends(counts, least)) if e is not None]
    backward = [(s, j) for j, s in enumerate(run_starts(counts, least)) if s is not None]
    return {
        (first, last)
        for first, last in forward + backward
        if (hit := next_hit[first]) is not None and gram_ends[hit] is not None and gram_ends[hit] <= last
    }


def delete_lines(text: str, ranges: Iterable[tuple[int, int]]) -> tuple[str, int, int, int]:
    """The text without the content lines in the ranges; lines, deleted lines, deleted words."""
    lines = text.split("\n")
    places, _, counts = content_lines(text)
    gone = set()
    for first, last in ranges:
        gone.update(range(first, last + 1))
    drop = {places[i] for i in gone}
    for i in gone:
        if i + 1 in gone:
            drop.update(range(places[i], places[i + 1]))
    kept = [line for place, line in enumerate(lines) if place not in drop]
    return "\n".join(kept), len(lines), len(drop), sum(counts[i] for i in gone)


def repeated_runs(docs: DataFrame, least: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, tie, runs (array of first and last content line) of the documents with later repeats."""
    rows = keyed(docs, id_col, text_col).select("key", "tie", whole_text(F.col("row").getField(text_col)).alias("text"))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for key, tie, text in zip(*(batch.column(c).to_pylist() for c in ("key", "tie", "text")), strict=True):
            _, hashes, counts = content_lines(text)
            if sum(counts) >= least:
                chosen = winnow(hashes, counts, least)
                out.append((key, tie, hashes, counts, list(chosen), list(chosen.values())))
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.binary())]
        names = ["key", "tie", "hashes", "counts", "at", "grams"]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    schema = "key long, tie long, hashes binary, counts array<int>, at array<int>, grams array<binary>"
    lines = staged(map_texts(rows, cut, schema), "lines")

    places = lines.select("key", "tie", F.explode(F.arrays_zip("at", "grams")).alias("x")).select("key", "tie", "x.at", "x.grams")
    # tables of their own: the joins may then split the rows of a passage that many documents share
    repeated = staged(
        places.groupBy("grams").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("grams"), "repeated-grams"
    )
    # at most as many positions as the document has lines
    hits = places.join(repeated, "grams").groupBy("key", "tie").agg(F.collect_set("at").alias("hits"))

    def lay(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("key", "tie", "hashes", "counts", "hits"))
        for key, tie, hashes, counts, at in zip(*columns, strict=True):
            out += [(content(hashes, a, b), key, tie, a, b) for a, b in windows_around(counts, at, least)]
        parts = list(zip(*out, strict=True)) if out else [[]] * 5
        types = [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(parts, types, strict=True)], ["content", "key", "tie", "first", "last"])

    around = lines.select("key", "tie", "hashes", "counts").dropDuplicates(["key", "tie"]).join(hits, ["key", "tie"])
    laid = staged(
        map_texts(around, lay, "content binary, key long, tie long, first int, last int", text="hashes"), "line-windows"
    )
    place = F.struct("key", "tie", "first")
    origin = staged(
        laid.groupBy("content").agg(F.min(place).alias("origin"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "origins"
    )
    return (
        laid.join(origin, "content")
        .filter(place != F.col("origin"))
        .groupBy("key", "tie")
        .agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    )


def whole_text(column):
    return F.coalesce(column.cast("string"), F.lit(""))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key and tie that name a row by id and text, and all its columns as one."""
    return docs.select(
        order_id_of(id_col).alias("key"),
        F.xxhash64(whole_text(quoted(text_col))).alias("tie"),
        F.struct(*map(quoted, docs.columns)).alias("row"),
    )


def _edited(docs: DataFrame, least: int, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    """The columns ``carry`` and the struct ``edit`` (text, n_lines, n_removed_lines, n_removed_words)."""
    runs = repeated_runs(docs, least, id_col, text_col)
    # rows equal in id and text: all but one repeat it whole
    copy = F.row_number().over(Window.partitionBy("key", "tie").orderBy("key"))
    joined = keyed(docs, id_col, text_col).join(runs, ["key", "tie"], "left").withColumn("copy", copy)

    @F.pandas_udf("text string, n_lines long, n_removed_lines long, n_removed_words long")
    def edit(texts, ranges, copies):
        out = []
        for text, found, number in zip(texts, ranges, copies, strict=True):
            found = [] if found is None else [(r["first"], r["last"]) for r in found]
            if number > 1:
                _, _, counts = content_lines(text)
                if sum(counts) >= least:
                    found = [(0, len(counts) - 1)]
            out.append(delete_lines(text, found) if len(found) else (text, text.count("\n") + 1, 0, 0))
        return pd.DataFrame(out, columns=["text", "n_lines", "n_removed_lines", "n_removed_words"])

    text = whole_text(F.col("row").getField(text_col))
    return joined.select(*carry, edit(text, "runs", "copy").alias("edit"))


def dedup_lines(docs: DataFrame, least: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed_lines, n_removed_words, text: one row for each row of ``docs``.

    A null or empty text is one empty line and stays so (as an empty text).  Of rows equal in id
    and text the further ones are repeats of the first.
    """
    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    edits = _edited(rows, least, "doc_id", "text", ["row.doc_id"])
    return edits.select("doc_id", "edit.n_lines", "edit.n_removed_lines", "edit.n_removed_words", "edit.text")


def drop_repeated_lines(docs: DataFrame, least: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later repeats deleted from its texts; every row and column stays, untouched texts and nulls as they were."""
    edits = _edited(docs, least, id_col, text_col, ["row"])
    changed = F.when(F.col("edit.n_removed_lines") > 0, F.col("edit.text")).otherwise(F.col("row").getField(text_col))
    columns = [(changed if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns]
    return edits.select(*columns)
