"""Label ids, vocabularies, padded id sequences and TF-IDF."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    Normalizer,
    SQLTransformer,
    StopWordsRemover,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketgrain.functions import fixed_values as V
from ticketgrain.functions import text as tx
from ticketgrain.functions.batches import unpacked
from ticketgrain.operators.scaling import global_row_number, lookup_join, stage, top_by_count


# --- labels -------------------------------------------------------------------
def label_index(df: DataFrame, label: str) -> DataFrame:
    """Distinct labels in ascending order with ids from 0 (fit on the training split)."""
    labels = df.select(F.col(label).alias("label")).filter(F.col("label").isNotNull()).distinct()
    return global_row_number(labels, [F.asc("label")], "id", start=0)


def encode_labels(df: DataFrame, label: str, index: DataFrame, name: str = "label_id") -> DataFrame:
    """Replace labels by ids; rows with a label outside the index are left out."""
    ids = index.select(F.col("label").alias(label), F.col("id").alias(name))
    return lookup_join(df, ids, [label], "inner")


# --- vocabulary ---------------------------------------------------------------
# Tasks pass their counts on when they hold more distinct tokens or terms than this.
_COUNTED = 200_000
# Rows that are encoded together.
_BLOCK = 1024


def _token_counts(df: DataFrame, row_id: str, tokens: Column) -> DataFrame:
    """token, n, first: the count and the place of the first occurrence.

    Tasks count their tokens before anything is exploded: a row for each distinct token of a task,
    or of ``_COUNTED`` of them.  The place is one fixed-width number (row id, then position).
    """
    rows = df.select(F.col(row_id).cast("decimal(19,0)").alias("_doc"), tokens.alias("_tokens"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        first: dict[str, tuple] = {}

        def taken() -> pa.RecordBatch:
            docs, places = zip(*(first.get(t, (None, 0)) for t in counts), strict=True)
            columns = [pa.array(counts, pa.string()), pa.array(counts.values(), pa.int64())]
            columns += [pa.array(docs, pa.decimal128(19, 0)), pa.array(places, pa.int32())]
            return pa.record_batch(columns, ["token", "n", "_doc", "_pos"])

        for batch in batches:
            for docs, listed in unpacked(batch.column("_doc"), batch.column("_tokens")):
                for doc, words in zip(docs, listed):
                    if words is None:
                        continue
                    counts.update(words)
                    if doc is None:
                        continue
                    # the first place of each word: later ones are overwritten
                    for word, place in dict(zip(words[::-1], range(len(words) - 1, -1, -1))).items():
                        if word not in first or doc < first[word][0]:
                            first[word] = (doc, place)
                if len(counts) > _COUNTED:
                    yield taken()
                    counts.clear()
                    first.clear()
        if counts:
            yield taken()

    place = F.col("_doc") * F.lit(2**31).cast("decimal(10,0)") + F.col("_pos")
    parts = rows.mapInArrow(count, "token string, n long, _doc decimal(19,0), _pos int")
    return parts.groupBy("token").agg(F.sum("n").alias("n"), F.min(place).alias("first"))


def vocabulary_top(
    df: DataFrame, row_id: str, text: str = "text", size: int = V.VOCABULARY_SIZE
) -> DataFrame:
    """The ``size`` most common tokens, ids from 2 by count; ties by first occurrence."""
    counts = _token_counts(df, row_id, tx.words(F.col(text)))
    top = top_by_count(counts, "n", size, [F.desc("n"), F.asc("first")], "id", start=V.FIRST_TOKEN_ID)
    return top.select("token", "n", "id")


def vocabulary_all(df: DataFrame, row_id: str, text: str = "text", min_freq: int = 1) -> DataFrame:
    """Every token seen ``min_freq`` times, ids from 2 in order of first occurrence."""
    counts = _token_counts(df, row_id, tx.words(F.col(text))).filter(F.col("n") >= min_freq)
    numbered = global_row_number(counts, [F.asc("first")], "id", start=V.FIRST_TOKEN_ID)
    return numbered.select("token", "n", "id")


def encode_padded(
    df: DataFrame,
    row_id: str,
    vocabulary: DataFrame,
    text: str = "text",
    max_len: int = V.SHORT_SEQUENCE,
) -> DataFrame:
    """First ``max_len`` tokens as ids, unknown tokens 1, padded with 0 on the right.

    A vocabulary of up to ``V.VOCABULARY_SIZE`` tokens is sent to the tasks, which look the words up
    inside the row: nothing is shuffled.  A larger one stays a table that the tokens are joined with
    (``encode_joined``); both give the same ids.
    """
    rows = vocabulary.select("token", "id").limit(V.VOCABULARY_SIZE + 1).toArrow()
    if rows.num_rows > V.VOCABULARY_SIZE:
        return encode_joined(df, row_id, vocabulary, text, max_len)
    ids = dict(zip(rows.column("token").to_pylist(), rows.column("id").to_pylist(), strict=True))
    kept = df.select(row_id, F.slice(tx.words(F.col(text)), 1, max_len).alias("_tokens"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), _padded(batch.column("_tokens"), ids, max_len)], [row_id, "ids"])

    return kept.mapInArrow(encode, f"`{row_id}` {df.schema[row_id].dataType.simpleString()}, ids array<int>")


def _padded(tokens: pa.Array, ids: dict[str, int], max_len: int) -> pa.Array:
    """The ids of each row's tokens, with zeros up to ``max_len``."""
    out = []
    for (rows,) in unpacked(tokens):
        for words in rows:
            found = [ids.get(t, V.UNKNOWN_ID) for t in (() if words is None else words)]
            out.append(np.array(found + [V.PAD_ID] * (max_len - len(found)), np.int32))
    return pa.array(out, pa.list_(pa.int32()))


def encode_joined(
    df: DataFrame, row_id: str, vocabulary: DataFrame, text: str = "text", max_len: int = V.SHORT_SEQUENCE
) -> DataFrame:
    """``encode_padded`` with a vocabulary of any size.

    Only each row's first ``max_len`` tokens leave it, numbered when they are written.  Blocks of
    ``_BLOCK`` rows ask the vocabulary for each of their distinct tokens once, so common words are as
    frequent as there are blocks, and the answers come back to the block, whose rows are encoded
    together.  Repeated and null row ids keep their rows.
    """
    tokens = stage(
        df.select(
            F.col(f"`{row_id}`").alias("_id"),
            F.slice(tx.words(F.col(text)), 1, max_len).alias("_tokens"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    # rows of one task are numbered from a multiple of 2**33
    blocks = tokens.select("_id", "_tokens", F.floor(F.col("_row") / _BLOCK).alias("_block"))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met: dict[int, set[str]] = {}
            for numbers, listed in unpacked(batch.column("_block"), batch.column("_tokens")):
                for number, words in zip(numbers, listed):
                    if words is not None:
                        met.setdefault(number, set()).update(words)
            at = np.repeat(np.array(list(met), np.int64), [len(words) for words in met.values()])
            found = [t for words in met.values() for t in words]
            yield pa.record_batch([pa.array(at), pa.array(found, pa.string())], ["_block", "token"])

    asked = blocks.select("_block", "_tokens").mapInArrow(distinct, "_block long, token string").distinct()
    known = lookup_join(asked, vocabulary.select("token", F.col("id").cast("int").alias("id")), ["token"], "inner")

    def encode(rows: pa.Table, answers: pa.Table) -> pa.Table:
        ids = dict(zip(answers.column("token").to_pylist(), answers.column("id").to_pylist(), strict=True))
        words = rows.column("_tokens").combine_chunks()
        return pa.table({row_id: rows.column("_id"), "ids": _padded(words, ids, max_len)})

    schema = f"`{row_id}` {df.schema[row_id].dataType.simpleString()}, ids array<int>"
    return blocks.groupBy("_block").cogroup(known.groupBy("_block")).applyInArrow(encode, schema)


def attention_mask(ids: Column) -> Column:
    """1 for a token, 0 for padding."""
    return F.transform(ids, lambda i: F.when(i != V.PAD_ID, 1).otherwise(0))


# --- TF-IDF -------------------------------------------------------------------
def _tokens(text: Column, min_token_chars: int) -> Column:
    r"""Lower-case runs of word characters of at least ``min_token_chars``."""
    pattern = rf"([\p{{L}}\p{{N}}_]{{{min_token_chars},}})"
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(pattern), F.lit(1))


def _without(tokens: Column, stop_words: Sequence[str]) -> Column:
    if not stop_words:
        return tokens
    # isin over literals becomes a hashed set lookup inside the generated code
    return F.filter(tokens, lambda t: ~t.isin(list(stop_words)))


def _kept_tokens(df: DataFrame, text: str, min_token_chars: int, stop_words: Sequence[str], *keep: str) -> DataFrame:
    """Columns ``keep`` and _t: the words in order; stop words go before pairs are built."""
    return df.select(*keep, _without(_tokens(F.col(text), min_token_chars), stop_words).alias("_t"))


def _terms(words) -> list[str]:
    """Words and word pairs in order."""
    words = list(words)
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def _term_counts(tokens: DataFrame) -> DataFrame:
    """term, df, tf: rows that hold the term and its occurrences, counted by tasks; terms repeat."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        all_: Counter = Counter()

        def taken() -> pa.RecordBatch:
            columns = [pa.array(all_, pa.string()), pa.array([held[t] for t in all_], pa.int64())]
            return pa.record_batch([*columns, pa.array(all_.values(), pa.int64())], ["term", "df", "tf"])

        for batch in batches:
            for (rows,) in unpacked(batch.column("_t")):
                for words in rows:
                    terms = _terms(words)
                    all_.update(terms)
                    held.update(set(terms))
                if len(all_) > _COUNTED:
                    yield taken()
                    held.clear()
                    all_.clear()
        if all_:
            yield taken()

    return tokens.select("_t").mapInArrow(count, "term string, df long, tf long")


@dataclass(frozen=True)
class TfidfModel:
    """A fitted vocabulary: ``terms`` has term, feature (alphabetical id) and idf."""

    terms: DataFrame
    min_token_chars: int
    stop_words: tuple[str, ...]

    def transform_long(self, df: DataFrame, row_id: str, text: str = "text") -> DataFrame:
        """row_id, term, feature, weight of the non-zero entries, rows L2-normalised.

        The vocabulary (``max_features`` rows at most) is sent to the tasks and looked up inside
        the row; terms outside it are left out.  Nothing is shuffled.
        """
        rows = self.terms.select("term", "feature", "idf").toArrow().to_pylist()
        known = {r["term"]: (r["feature"], r["idf"]) for r in rows}
        tokens = _kept_tokens(df, text, self.min_token_chars, self.stop_words, row_id)

        def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                done = 0
                for (rows,) in unpacked(batch.column("_t")):
                    at, found, features, weights = [], [], [], []
                    for i, words in enumerate(rows, done):
                        counts = Counter(t for t in _terms(words) if t in known)
                        raw = [n * known[t][1] for t, n in counts.items()]
                        norm = math.sqrt(sum(w * w for w in raw))
                        at += [i] * len(raw)
                        found += counts
                        features += [known[t][0] for t in counts]
                        weights += [w / norm for w in raw]
                    done += len(rows)
                    columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(found, pa.string())]
                    columns += [pa.array(features, pa.int64()), pa.array(weights, pa.float64())]
                    yield pa.record_batch(columns, [row_id, "term", "feature", "weight"])

        key = f"`{row_id}` {df.schema[row_id].dataType.simpleString()}"
        return tokens.mapInArrow(weigh, f"{key}, term string, feature long, weight double")

    def to_pipeline(self, text: str = "text", output: str = "features") -> PipelineModel:
        """The same weights as sparse ML vectors, without any shuffle.

        The vocabulary (``max_features`` rows at most) becomes model state.
        """
        rows = self.terms.orderBy("feature").select("term", "idf").toLocalIterator()
        vocabulary, idf = zip(*[(r["term"], r["idf"]) for r in rows])
        words = f"[\\\\p{{L}}\\\\p{{N}}_]{{{self.min_token_chars},}}"
        tokens = SQLTransformer(
            statement=(
                f"SELECT *, regexp_extract_all(lower(coalesce(`{text}`, '')), '({words})', 1) AS _tok "
                "FROM __THIS__"
            )
        )
        stop = StopWordsRemover(
            inputCol="_tok", outputCol="_kept", stopWords=list(self.stop_words) or [""], caseSensitive=True
        )
        pairs = NGram(n=2, inputCol="_kept", outputCol="_pairs")
        both = SQLTransformer(statement="SELECT *, concat(_kept, _pairs) AS _terms FROM __THIS__")
        counts = CountVectorizerModel.from_vocabulary(list(vocabulary), "_terms", "_tf")
        scale = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_tfidf")
        unit = Normalizer(p=2.0, inputCol="_tfidf", outputCol=output)
        tidy = SQLTransformer(
            statement="SELECT * EXCEPT (_tok, _kept, _pairs, _terms, _tf, _tfidf) FROM __THIS__"
        )
        return PipelineModel([tokens, stop, pairs, both, counts, scale, unit, tidy])


def english_stop_words() -> tuple[str, ...]:
    """Spark's English list."""
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def fit_tfidf(
    df: DataFrame,
    text: str = "text",
    max_features: int = V.TFIDF_FULL["max_features"],
    min_df: int = V.TFIDF_FULL["min_df"],
    min_token_chars: int = V.TFIDF_FULL["min_token_chars"],
    use_stop_words: bool = V.TFIDF_FULL["use_stop_words"],
    stop_words: Sequence[str] | None = None,
) -> TfidfModel:
    """Choose the top terms by total count and their smoothed idf.

    ``idf = ln((1 + rows) / (1 + df)) + 1``; equal counts at the cut are taken in term order.
    The result has at most ``max_features`` rows.  ``stop_words`` replaces Spark's English list.
    Only terms with their partial counts are shuffled.
    """
    if stop_words is None:
        stop_words = english_stop_words() if use_stop_words else ()
    n_rows = df.select(F.count(F.lit(1))).scalar()
    stats = (
        _term_counts(_kept_tokens(df, text, min_token_chars, stop_words))
        .groupBy("term")
        .agg(F.sum("df").alias("df"), F.sum("tf").alias("total"))
        .filter(F.col("df") >= min_df)
    )
    top = top_by_count(stats, "total", max_features, [F.desc("total"), F.asc("term")], "_place")
    idf = F.log((n_rows + 1.0) / (F.col("df") + 1.0)) + 1.0
    chosen = global_row_number(top.select("term", idf.alias("idf")), [F.asc("term")], "feature", start=0)
    return TfidfModel(stage(chosen.select("term", "feature", "idf")), min_token_chars, tuple(stop_words))
