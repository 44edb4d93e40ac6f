"""Target-distribution importance resampling over hashed word n-grams.

Features are the runs of 1 to ``max_gram`` words, hashed into buckets.  A bucket gains what its share
in the target texts exceeds that in the documents (add-one, in log), a document's weight is the sum
over its features, and a draw without replacement takes the largest weights after Gumbel noise that
is a function of the document's id.

Inside a task the n-grams of a batch are interned in an open-addressed NumPy table: the key is the
xxhash64 of the n-gram's bytes, an equal key counts only after its bytes are compared, and the next
slot is tried otherwise.  A slot holds bucket and count, so a repeated n-gram is hashed into its
bucket once a batch; the slot id of each occurrence gathers its gain.

What goes through the driver is one number a bucket, ``buckets`` being a parameter.  The ranks come
from a range-partitioned sort by all tasks (``operators.scaling``), texts not among the columns.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketgrain.llm.common import id_and_text, map_texts, quoted, slices, staged
from ticketgrain.operators.scaling import global_row_number

MAX_GRAM = 1
BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
DRAW_PERCENT = 10
# Slots of a new table; it grows before it can be over half full.
_FIRST_SLOTS = 1 << 12
# Occurrences interned at once, and bytes of text that are split into words at once.
_CHUNK, _PIECE = 1 << 17, 1 << 20
# Scores are put into so many buckets when the cut of the draw is looked for.
_STEPS = 4096
# Maximal runs of digits, letters and all that is not ASCII, on bytes with A-Z in lower case.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


def pieces(text: bytes, max_gram: int) -> Iterator[tuple[int, list[bytes]]]:
    """Number of words and the n-grams that end in them, for stretches of a text cut between words."""
    text = text.lower()
    at, before = 0, []
    while at < len(text):
        gap = _GAP.search(text, min(at + _PIECE, len(text)))
        end = gap.start() if gap else len(text)
        words = _WORD.findall(text, at, end)
        grams = list(words)
        joined = before + words
        for n in range(2, max_gram + 1):
            starts = range(max(0, len(before) - n + 1), len(joined) - n + 1)
            grams += [b" ".join(joined[i : i + n]) for i in starts]
        yield len(words), grams
        at, before = end, joined[max(0, len(joined) - max_gram + 1) :] if max_gram > 1 else []


class Occurrences:
    """The n-grams of a batch of texts in stretches, each with the number of its text."""

    def __init__(self, texts: list[bytes], max_gram: int) -> None:
        self.texts = texts
        self.max_gram = max_gram
        self.n_words = np.zeros(len(texts), np.int64)
        self.n_grams = np.zeros(len(texts), np.int64)

    def __iter__(self) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        grams: list[bytes] = []
        of: list[tuple[int, int]] = []
        for i, text in enumerate(self.texts):
            for words, part in pieces(text, self.max_gram):
                self.n_words[i] += words
                self.n_grams[i] += len(part)
                grams += part
                of.append((i, len(part)))
                if len(grams) >= _CHUNK:
                    yield np.repeat(*zip(*of, strict=True)), grams
                    grams, of = [], []
        if grams:
            yield np.repeat(*zip(*of, strict=True)), grams


class GramTable:
    """Open-addressed table of n-grams: key, bytes, bucket and count of each slot; linear probing."""

    def __init__(self, buckets: int, slots: int = _FIRST_SLOTS, hashed=xxhash.xxh64_intdigest) -> None:
        self.buckets = buckets
        self.hashed = hashed
        self._make(slots)

    def _make(self, slots: int) -> None:
        self.used = 0
        self.keys = np.zeros(slots, np.uint64)
        self.grams = np.full(slots, None, object)
        self.bucket = np.zeros(slots, np.int64)
        self.count = np.zeros(slots, np.int64)

    def _slots_of(self, grams: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """A slot for each occurrence; new n-grams take free ones."""
        mask = np.uint64(len(self.keys) - 1)
        slots = (keys & mask).astype(np.int64)
        open_ = np.arange(len(grams))
        while len(open_):
            at = slots[open_]
            free = np.flatnonzero(np.equal(self.grams[at], None))
            if len(free):
                # of the occurrences at one free slot the first takes it
                slot, first = np.unique(at[free], return_index=True)
                taken = open_[free[first]]
                self.keys[slot], self.grams[slot] = keys[taken], grams[taken]
                self.bucket[slot] = [zlib.crc32(g) % self.buckets for g in grams[taken]]
                self.used += len(slot)
            same = self.keys[at] == keys[open_]
            same[same] = self.grams[at[same]] == grams[open_[same]]
            open_ = open_[~same]
            slots[open_] = (slots[open_] + 1) & int(mask)
        return slots

    def intern(self, grams: list[bytes]) -> np.ndarray:
        """Count the occurrences; the slot id of each, which holds until the next call."""
        if 2 * (self.used + len(grams)) > len(self.keys):
            self._grow(self.used + len(grams))
        items = np.fromiter(grams, object, len(grams))
        slots = self._slots_of(items, np.fromiter(map(self.hashed, grams), np.uint64, len(grams)))
        self.count += np.bincount(slots, minlength=len(self.count))
        return slots

    def _grow(self, held: int) -> None:
        full = np.flatnonzero(np.not_equal(self.grams, None))
        grams, keys, count = self.grams[full], self.keys[full], self.count[full]
        self._make(1 << (2 * held).bit_length())
        self.count[self._slots_of(grams, keys)] = count

    def by_bucket(self) -> np.ndarray:
        """Occurrences in each bucket."""
        out = np.zeros(self.buckets, np.int64)
        np.add.at(out, self.bucket, self.count)  # free slots count nothing
        return out


def bucket_counts(texts: DataFrame, max_gram: int, buckets: int) -> np.ndarray:
    """Features of all texts in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches):
            table = GramTable(buckets)
            for _, grams in Occurrences(batch.column("text").cast(pa.binary()).to_pylist(), max_gram):
                table.intern(grams)
            total += table.by_bucket()
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held, pa.int32()), pa.array(total[held])], ["bucket", "n"])

    counted = texts.select("text").mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[row["bucket"]] = row["n"]
    return out


def gains_of(raw: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 ln) of a bucket's share in the target over that in the documents, add-one."""
    buckets, s_all, t_all = len(raw), int(raw.sum()), int(target.sum())
    pairs = zip(raw.tolist(), target.tolist(), strict=True)
    return [math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)))) for s, t in pairs]


def weighed(docs: DataFrame, gains: list[int], max_gram: int) -> DataFrame:
    """doc_id, n_words, n_features, weight of each document."""
    gain = np.array(gains, np.int64)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = GramTable(len(gain))
        found = Occurrences(batch.column("text").cast(pa.binary()).to_pylist(), max_gram)
        weight = np.zeros(batch.num_rows, np.int64)
        for doc, grams in found:
            slots = table.intern(grams)
            np.add.at(weight, doc, gain[table.bucket[slots]])
        arrays = [batch.column("doc_id"), *map(pa.array, (found.n_words, found.n_grams, weight))]
        return pa.record_batch(arrays, ["doc_id", "n_words", "n_features", "weight"])

    return map_texts(docs, run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise of a document in thousandths, from the first 32 bits of a SHA-256; a null id is written 'null'."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def resample(
    docs: DataFrame, target: DataFrame, draw_percent: int = DRAW_PERCENT, min_words: int = MIN_WORDS, max_gram: int = MAX_GRAM,
    buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
) -> DataFrame:
    """doc_id, n_features, weight, score, rank: one row for each row of ``docs``.

    Of the documents with ``min_words`` words or more the ``draw_percent`` percent (rounded down) of
    highest score are drawn and ranked from 1; the others' rank is null.  Equal scores go by smaller
    doc_id, null ids first, then by smaller number of features.  Null and empty texts have no
    features, weight 0 and are never drawn.  Repeated rows have a row and a place each.
    """
    texts = id_and_text(docs, id_col, text_col)
    aims = target.select(F.coalesce(quoted(target_col).cast("string"), F.lit("")).alias("text"))
    gains = gains_of(bucket_counts(texts, max_gram, buckets), bucket_counts(aims, max_gram, buckets))
    scored = staged(weighed(texts, gains, max_gram).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "resample")
    fit = scored.filter(F.col("n_words") >= min_words)
    drawn = draw_percent * fit.count() // 100
    cut = lower_cut(fit, drawn)
    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("n_features")]
    ranked = global_row_number(fit.filter(F.col("score") >= cut), order, "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.filter((F.col("n_words") < min_words) | (F.col("score") < cut)).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


def lower_cut(fit: DataFrame, drawn: int) -> int:
    """A score that at least ``drawn`` rows reach, and few more: from a histogram, refined in its last bucket."""
    low, high = fit.agg(F.min("score"), F.max("score")).first()
    if low is None or not drawn:
        return 2**62
    above = 0
    while high > low:
        width = max(1, -(-(high - low + 1) // _STEPS))
        step = F.expr(f"(score - ({low}L)) div {width}L").alias("step")
        sizes = fit.filter(F.col("score").between(low, high)).groupBy(step).count().collect()  # at most _STEPS rows
        for at, n in sorted(sizes, reverse=True):
            if above + n >= drawn:
                low, high = low + at * width, min(high, low + (at + 1) * width - 1)
                break
            above += n
        if width == 1:
            break
    return low
