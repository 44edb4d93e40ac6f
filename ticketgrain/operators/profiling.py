"""Data-quality and distribution profiles.

Numeric profiles first count each distinct value (partial aggregation on the map
side, so a hot value travels once per task) and then work on that small
value/frequency table: exact percentiles without holding the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketgrain.functions import text as tx
from ticketgrain.operators.scaling import lookup_join, stage


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows per split and a 'total' row."""
    return (
        df.rollup(split)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.grouping(split).alias("_all"))
        .select(
            F.when(F.col("_all") == 1, F.lit("total")).otherwise(F.col(split)).alias("split"),
            "n_rows",
        )
    )


def quality_profile(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows, blank texts, exact duplicates and character-length figures.

    The distinct count shuffles a 32-byte digest per text, never the text.
    """
    raw = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = df.select(
        tx.is_blank(F.col(text)).alias("blank"),
        F.length(raw).cast("long").alias("chars"),
        F.unhex(F.sha2(raw, 256)).alias("digest"),
    )
    return base.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("blank").alias("n_blank"),
        (F.count(F.lit(1)) - F.countDistinct("digest")).alias("n_duplicates"),
        F.min("chars").alias("min_chars"),
        F.max("chars").alias("max_chars"),
        F.avg("chars").alias("mean_chars"),
        F.stddev_pop("chars").alias("std_chars"),
    )


def with_lengths(df: DataFrame, text: str = "text") -> DataFrame:
    return df.select(
        tx.char_count(F.coalesce(F.col(text), F.lit(""))).alias("n_chars"),
        tx.word_count(F.col(text)).alias("n_words"),
    )


def labelled_lengths(
    docs: DataFrame, labels: DataFrame, row_id: str, label: str, text: str = "text"
) -> DataFrame:
    """(label, n_chars, n_words) of the cleaned text of every labelled row.

    Texts are reduced to two numbers before the join: no text is shuffled.
    """
    return _cleaned_lengths(docs.select(row_id, text), [row_id], text).join(labels.select(row_id, label), row_id).drop(row_id)


def _cleaned_lengths(df: DataFrame, keep: Sequence[str], text: str) -> DataFrame:
    cleaned = df.select(*keep, tx.basic_clean(F.col(text)).alias("_clean"))
    return cleaned.select(
        *keep,
        tx.char_count(F.col("_clean")).alias("n_chars"),
        tx.word_count(F.col("_clean")).alias("n_words"),
    )


def value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(measure, value, n) of integer columns, nulls left out."""
    pairs = [F.struct(F.lit(c).alias("measure"), F.col(c).cast("long").alias("value")) for c in columns]
    return (
        df.select(F.inline(F.array(*pairs)))
        .filter(F.col("value").isNotNull())
        .groupBy("measure", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _moments(freq: DataFrame) -> DataFrame:
    value = F.col("value").cast("decimal(19,0)")
    return freq.groupBy("measure").agg(
        F.sum("n").alias("n"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.sum((value * F.col("n")).cast("decimal(38,0)")).cast("double").alias("s1"),
        F.sum((value * value * F.col("n")).cast("decimal(38,0)")).cast("double").alias("s2"),
        F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).alias("q"),
    )


def length_stats(df: DataFrame, columns: Sequence[str] = ("n_chars", "n_words")) -> DataFrame:
    """Min, max, mean, median, population deviation and quartiles of integer columns."""
    m = _moments(value_frequencies(df, columns))
    mean = F.col("s1") / F.col("n")
    variance = F.greatest(F.col("s2") / F.col("n") - mean * mean, F.lit(0.0))
    return m.select(
        "measure",
        "min",
        "max",
        mean.alias("mean"),
        F.col("q")[1].alias("median"),
        F.sqrt(variance).alias("std"),
        F.col("q")[0].alias("p25"),
        F.col("q")[2].alias("p75"),
    )


def describe(df: DataFrame, columns: Sequence[str] = ("n_chars", "n_words")) -> DataFrame:
    """Count, mean, sample deviation, min, exact quartiles and max."""
    m = _moments(value_frequencies(df, columns))
    mean = F.col("s1") / F.col("n")
    squares = F.greatest(F.col("s2") - F.col("s1") * mean, F.lit(0.0))
    return m.select(
        "measure",
        F.col("n").alias("count"),
        mean.alias("mean"),
        F.sqrt(F.try_divide(squares, F.col("n") - 1)).alias("std"),
        "min",
        F.col("q")[0].alias("p25"),
        F.col("q")[1].alias("p50"),
        F.col("q")[2].alias("p75"),
        "max",
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins included."""
    freq = stage(value_frequencies(df, [column]))
    ends = freq.select(F.min("value").cast("double").alias("lo"), F.max("value").cast("double").alias("hi")).first()
    lo, hi = ends if ends.lo is not None else (0.0, 0.0)
    # a single value gets a unit-wide range around it
    first, span = (lo - 0.5, 1.0) if lo == hi else (lo, hi - lo)
    start, width = F.lit(first), F.lit(span)
    slot = F.floor((F.col("value") - start) / width * bins)
    counts = freq.groupBy(F.least(slot, F.lit(bins - 1)).alias("bin")).agg(F.sum("n").alias("n"))
    edges = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return edges.join(counts, "bin", "left").select(
        "bin",
        (start + F.col("bin") * width / bins).alias("bin_start"),
        (start + (F.col("bin") + 1) * width / bins).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each listed column that exists, nulls dropped, one scan."""
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in columns
        if c in df.columns
    ]
    return (
        df.select(F.inline(F.array(*pairs)))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("column", F.desc("n"), "value")
    )


def _class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """Count and percentage per label, ordered by label."""
    counts = _class_counts(df, label)
    total = counts.select(F.sum("n")).scalar()
    return counts.select(label, "n", (F.col("n") * 100.0 / total).alias("pct")).orderBy(label)


def class_profile(df: DataFrame, label: str, chars: str = "n_chars", words: str = "n_words") -> DataFrame:
    """Count, percentage and mean lengths per class."""
    per_class = df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(chars).alias("mean_chars"),
        F.avg(words).alias("mean_words"),
    )
    total = F.sum("n").over(Window.partitionBy())  # a row for each class
    return per_class.select(label, "n", (F.col("n") * 100.0 / total).alias("pct"), "mean_chars", "mean_words")


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Lower-case whitespace tokens and how often each occurs."""
    return (
        df.select(F.explode(tx.words(F.lower(F.col(text)))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_words(df: DataFrame, text: str = "text", k: int = 10) -> DataFrame:
    """The k most common words; equal counts in word order."""
    return word_counts(df, text).orderBy(F.desc("n"), "word").limit(k)


def vocabulary_size(df: DataFrame, text: str = "text") -> DataFrame:
    return word_counts(df, text).agg(
        F.count(F.lit(1)).alias("distinct_words"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_words")
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class)."""
    counts = _class_counts(df, label)
    total = counts.select(F.sum("n")).scalar()
    classes = counts.select(F.count(F.lit(1))).scalar()
    return counts.select(label, "n", (total / (classes * F.col("n"))).alias("weight"))


def oversample_weights(df: DataFrame, label: str) -> DataFrame:
    """Largest class count / class count."""
    counts = _class_counts(df, label)
    largest = counts.select(F.max("n")).scalar()
    return counts.select(label, "n", (largest / F.col("n")).alias("weight"))


def oversample(df: DataFrame, label: str) -> DataFrame:
    """Repeat each row round(weight) times."""
    weights = stage(oversample_weights(df, label).select(label, "weight"))
    copies = F.round("weight").cast("int")
    return (
        lookup_join(df, weights, [label], "inner")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
        .drop("weight")
    )


def epoch_metrics(steps: DataFrame, keys: Sequence[str] = ("exp", "epoch")) -> DataFrame:
    """Mean batch loss and correct/total per experiment and epoch (0 when total is 0)."""
    accuracy = F.try_divide(F.sum("correct"), F.sum("total"))
    return steps.groupBy(*keys).agg(
        F.avg("loss").alias("avg_loss"), F.coalesce(accuracy, F.lit(0.0)).alias("accuracy")
    )
