"""Language-model scores of documents.

The base is an add-one word model over all training tokens.  The model is log-bilinear: a
word's score after another is the product of a context and a target vector plus a bias.  It is
trained in numpy by noise-contrastive estimation on the pair counts of all training tokens, in
expectation over the noise, so no token and no noise is sampled.  Batched matrix products give
each context's normaliser; a token's log-probability is then one product of two vectors.

Symbols are the most frequent words and, for all others, classes by their last two bytes; a
word is drawn from its class by add-one counts, with one share for unseen words.  The number of
model words grows with the cube root of the number of distinct words: 32,000 of a thousand
million, with vectors of 6 MB for the tasks.  The pair counts are kept as the pairs that occur.
Words are counted over all training documents.  The most frequent ones (at most ``HEAD_WORDS``, of at most
``HEAD_BYTES`` bytes) are sent to the tasks, all others are looked up by a join.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketgrain.llm.common import id_and_text, map_texts, slices, staged

FOLDS, HELD_OUT = 7, 2
HEAD_WORDS = 1 << 17
HEAD_BYTES = 64
MODEL_SCALE = 32  # model words for each unit of the cube root of the distinct words
CLASSES = 64
DIMENSIONS = 24
NOISE = 5
ROUNDS = 150
RATE = 0.05
END = b""  # no word is empty
_COUNTED = 200_000  # distinct words that a task gathers before it passes their counts on
_STEPS = 16  # count buckets for each doubling
_SLOTS = 1024  # parts by hash of the bucket at which the words are cut
_PAIRS = 1 << 20  # distinct pairs that a task gathers before it passes their counts on
_CELLS = 1 << 22  # cells of (context, symbol) worked on at once


def with_fold(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    return id_and_text(docs, id_col, text_col).withColumn("held_out", F.coalesce(fold == HELD_OUT, F.lit(False)))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # bytes: A-Z and ASCII white space only


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % CLASSES


def word_counts(training: DataFrame) -> DataFrame:
    """word, c of all training tokens, ends included (as the empty word)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for part in slices(batches):
            for text in part.column("text").cast(pa.binary()).to_pylist():
                counts.update(words_of(text))
            counts[END] += part.num_rows
            if len(counts) > _COUNTED:
                yield as_batch(counts)
                counts.clear()
        if counts:
            yield as_batch(counts)

    def as_batch(counts: Counter[bytes]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["word", "c"])

    return training.select("text").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class _Places(dict):
    def __missing__(self, word: bytes) -> int:
        return len(self) + word_class(word)


@dataclass
class Lookup:
    """What a task knows of words; symbols are words of the model, then classes, then the end; contexts have a start too."""

    index: _Places  # frequent words; class c of all others is at len(index) + c
    symbol: np.ndarray
    log_count: np.ndarray  # log10(c + 1), 0 for others
    log_class: np.ndarray  # log10 of the counts of the word's class, 0 for words of the model
    known: np.ndarray
    tokens: int
    log_all: float  # log10(N + V + 1)
    symbols: int
    end_log_count: float
    end_known: bool

    def places(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    @property
    def end(self) -> int:
        return self.symbols - 1

    def contexts(self, symbols: np.ndarray) -> np.ndarray:
        return np.concatenate([[self.symbols], symbols])


def model_size(distinct: int) -> int:
    return math.ceil(MODEL_SCALE * distinct ** (1 / 3))


def build_lookup(words: DataFrame, head_words: int = HEAD_WORDS, model_words: int | None = None) -> Lookup:
    """``model_words`` None: as many as ``model_size`` gives for the distinct words."""
    bucket = F.floor(F.log2("c") * _STEPS).cast("int")
    slot = F.pmod(F.xxhash64("word"), F.lit(_SLOTS)).cast("int")
    own = (F.col("word") != END) & (F.octet_length("word") <= HEAD_BYTES)
    totals = words.agg(F.sum("c"), F.count(F.lit(1)), F.sum(F.when(F.col("word") == END, F.col("c")))).first()
    tokens, distinct, ends = (int(x or 0) for x in totals)
    model_words = min(model_size(distinct) if model_words is None else model_words, head_words)
    # at most 16 buckets for each doubling of a count: a bounded number of rows
    sizes = {r.b: r.n for r in words.filter(own).groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}

    def among(limit: int):
        """Whether a word is among the ``limit`` most frequent; words of equal buckets by their hash."""
        held = 0
        for number in sorted(sizes, reverse=True):
            if held + sizes[number] > limit:
                break
            held += sizes[number]
        else:
            return own
        part = words.filter(own & (bucket == number)).groupBy(slot.alias("s")).agg(F.count(F.lit(1)).alias("n"))
        first = 0
        for s, n in sorted((r.s, r.n) for r in part.collect()):
            if held + n > limit:
                break
            held, first = held + n, s + 1
        return own & ((bucket > number) | ((bucket == number) & (slot < first)))

    in_model = among(model_words)
    klass = F.pmod(F.crc32(F.expr("substring(word, -2, 2)")), F.lit(CLASSES)).cast("int")
    rest = words.filter((F.col("word") != END) & ~in_model).groupBy(klass.alias("k"))
    shares = {r.k: math.log10(r.n + r.v + 1) for r in rest.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    head = words.filter(among(head_words)).select("word", "c", in_model.alias("m")).toArrow()
    rows = sorted(zip(*(head.column(c).to_pylist() for c in ("word", "c", "m")), strict=True), key=lambda r: (not r[2], r[0]))
    models = sum(r[2] for r in rows)
    class_share = [shares.get(k, 0.0) for k in range(CLASSES)]
    classes = [word_class(w) for w, _, _ in rows[models:]]
    return Lookup(
        index=_Places((w, i) for i, (w, _, _) in enumerate(rows)),
        symbol=np.array([*range(models), *(models + k for k in classes), *range(models, models + CLASSES)], np.int64),
        log_count=np.array([*(math.log10(c + 1) for _, c, _ in rows), *[0.0] * CLASSES]),
        log_class=np.array([*[0.0] * models, *(class_share[k] for k in classes), *class_share]),
        known=np.array([*[1] * len(rows), *[0] * CLASSES], np.int64),
        tokens=tokens,
        log_all=math.log10(tokens + distinct + 1),
        symbols=models + CLASSES + 1,
        end_log_count=math.log10(ends + 1),
        end_known=ends > 0,
    )


@dataclass
class Pairs:
    """Counts of the (context, symbol) pairs that occur, by context."""

    contexts: int
    symbols: int
    at: np.ndarray  # context * symbols + symbol, ascending
    n: np.ndarray

    def blocks(self) -> Iterator[tuple[slice, np.ndarray]]:
        """Contexts and their counts of all symbols, some ``_CELLS`` at once."""
        rows = max(1, _CELLS // self.symbols)
        for start in range(0, self.contexts, rows):
            stop = min(self.contexts, start + rows)
            a, b = np.searchsorted(self.at, (start * self.symbols, stop * self.symbols))
            counts = np.zeros((stop - start) * self.symbols, np.float32)
            counts[self.at[a:b] - start * self.symbols] = self.n[a:b]
            yield slice(start, stop), counts.reshape(stop - start, self.symbols)


def pair_counts(training: DataFrame, lookup: Lookup) -> Pairs:
    """Counts of (context, symbol) over all training tokens; at most the square of the model's words."""
    symbols_of_all = lookup.symbols

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        at, place = np.unique(np.concatenate([a for a, _ in parts]), return_inverse=True)
        return at, np.bincount(place, np.concatenate([n for _, n in parts]), len(at)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for part in slices(batches):
            pairs = []
            for text in part.column("text").cast(pa.binary()).to_pylist():
                symbols = np.append(lookup.symbol[lookup.places(words_of(text))], lookup.end)
                pairs.append(lookup.contexts(symbols[:-1]) * symbols_of_all + symbols)
            held.append(np.unique(np.concatenate(pairs), return_counts=True))
            if sum(len(at) for at, _ in held) > _PAIRS:
                held = [merged(held)]
                if len(held[0][0]) > _PAIRS // 2:
                    yield as_batch(*held.pop())
        if held:
            yield as_batch(*merged(held))

    def as_batch(at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(at, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])

    found = training.select("text").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    at, n = (found.column(c).to_numpy() for c in ("pair", "n"))
    order = np.argsort(at)
    return Pairs(lookup.symbols + 1, lookup.symbols, at[order], n[order])


def train(pairs: Pairs, dimensions: int = DIMENSIONS, rounds: int = ROUNDS, noise: int = NOISE, seed: int = 0):
    """Context vectors, target vectors and biases by noise-contrastive estimation (Adam, all counts in each round).

    A pair from the data is told from ``noise`` symbols drawn by frequency; both sides enter with
    their expected counts, block by block of contexts.
    """
    rng = np.random.default_rng(seed)
    of_symbol = np.bincount(pairs.at % pairs.symbols, pairs.n, pairs.symbols)
    of_context = np.bincount(pairs.at // pairs.symbols, pairs.n, pairs.contexts).astype(np.float32)[:, None]
    total = max(1.0, float(of_symbol.sum()))
    frequency = ((of_symbol + 1) / (total + pairs.symbols)).astype(np.float32)
    offset = np.log(noise * frequency)
    values = [
        rng.normal(0, 0.1, (pairs.contexts, dimensions)).astype(np.float32),
        rng.normal(0, 0.1, (pairs.symbols, dimensions)).astype(np.float32),
        np.log(frequency),
    ]
    first = [np.zeros_like(v) for v in values]
    second = [np.zeros_like(v) for v in values]
    scale = np.sqrt((of_context + 1) * np.float32(total))  # frequent contexts do not drown the others
    for step in range(1, rounds + 1):
        context, target, bias = values
        slopes = [np.zeros_like(v) for v in values]
        for rows, counts in pairs.blocks():
            from_data = 1 / (1 + np.exp(np.clip(offset - bias - context[rows] @ target.T, -30, 30)))
            seen = noise * of_context[rows] * frequency  # expected noise pairs
            slope = (counts * (1 - from_data) - seen * from_data) / scale[rows]
            slopes[0][rows] = slope @ target
            slopes[1] += slope.T @ context[rows]
            slopes[2] += slope.sum(axis=0)
        for i, gradient in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * gradient
            second[i] = 0.99 * second[i] + 0.01 * gradient**2
            move = first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
            values[i] = values[i] + np.float32(RATE) * move
    return values


def normalisers(model, batch: int = 256) -> np.ndarray:
    """Natural logarithm of the sum of all symbols' exponentiated scores, by context."""
    context, target, bias = model
    sums = []
    for start in range(0, len(context), batch):
        scores = (context[start : start + batch] @ target.T + bias).astype(np.float64)
        high = scores.max(axis=1)
        sums.append(high + np.log(np.exp(scores - high[:, None]).sum(axis=1)))
    return np.concatenate(sums).astype(np.float32)


def log_probabilities(model, log_sums: np.ndarray, contexts: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """log10 probabilities of symbols after contexts; over all symbols they sum to one probability."""
    context, target, bias = model
    scores = np.einsum("ij,ij->i", context[contexts], target[symbols]) + bias[symbols]
    return (scores - log_sums[contexts]) / np.float32(math.log(10))


def score_documents(
    docs: DataFrame,
    head_words: int = HEAD_WORDS,
    model_words: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row for each row of ``docs``.

    A null or empty text is its end token alone.  Rows with a null id are training rows; repeated
    rows are counted and scored each.  Without any training row all words are unseen.
    """
    rows = with_fold(docs, id_col, text_col)
    training = rows.filter(~F.col("held_out"))
    words = staged(word_counts(training), "word-counts")
    lookup = build_lookup(words, head_words, model_words)
    vectors = train(pair_counts(training, lookup))
    log_sums = normalisers(vectors)
    head = len(lookup.index)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        scalars, rare_words, rare_counts = [], [], []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            found = words_of(text)
            at = lookup.places(found)
            symbols = np.append(lookup.symbol[at], lookup.end)
            counted = float(lookup.log_count[at].sum())
            model = float(log_probabilities(vectors, log_sums, lookup.contexts(symbols[:-1]), symbols).sum(dtype=np.float64))
            of_class = lookup.log_class[at] > 0
            inner = float(lookup.log_count[at][of_class].sum() - lookup.log_class[at].sum())
            base = counted + lookup.end_log_count - (len(found) + 1) * lookup.log_all
            known = int(lookup.known[at].sum()) + int(lookup.end_known)
            scalars.append((len(found) + 1, known, base, model + inner))
            rare = Counter([found[i] for i in np.flatnonzero(at >= head).tolist()])
            rare_words.append(list(rare))
            rare_counts.append(list(rare.values()))
        n, known, base, model = zip(*scalars, strict=True)
        columns = [
            batch.column("doc_id"), batch.column("held_out"), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
            pa.array(base, pa.float64()), pa.array(model, pa.float64()),
            pa.array(rare_words, pa.list_(pa.binary())), pa.array(rare_counts, pa.list_(pa.int64())),
        ]
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base", "model", "rare", "times"]
        return pa.record_batch(columns, names)

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, rare array<binary>, times array<long>"
    )
    # the row number is stored with the row, so it stays what it is
    scored = staged(map_texts(rows, score, schema).withColumn("row_id", F.monotonically_increasing_id()), "scored")
    pairs = scored.select("row_id", F.explode(F.arrays_zip("rare", "times")).alias("x"))
    rare = (
        pairs.select("row_id", F.col("x.rare").alias("word"), "x.times")
        .join(words, "word")
        .groupBy("row_id")
        .agg(F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more"), F.sum("times").alias("times"))
    )
    more = F.coalesce("more", F.lit(0.0))
    return scored.drop("rare", "times").join(rare, "row_id", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("times", F.lit(0))).alias("n_known"),
        F.lit(lookup.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("model") + more).alias("score"),
    )
